"""A harbour shop chain's feeds over two days, made from cases.

Each case names what it stands for; the texts are rendered from it, so that a defect is
stated once and nothing else differs from a plain record.
"""

from __future__ import annotations

import json

DAY_BEFORE, DAY_1, DAY_2 = "2025-03-10", "2025-03-11", "2025-03-12"


def sale(key, time, store="PIER", customer="M-1", amount=5.0, kind="sale"):
    """One till message; ``time`` is on the first day unless it names a day."""
    when = time if "T" in time else f"{DAY_1}T{time}Z"
    return json.dumps({
        "transaction_id": key, "store_id": store, "customer_id": customer, "event_type": kind,
        "amount": amount, "currency": "EUR", "timestamp": when,
    })


def order(key, time, customer, total, paid):
    return json.dumps({
        "order_id": key, "customer_id": customer, "store_id": "WEB", "total_amount": total,
        "payment_type": paid, "timestamp": f"{DAY_1}T{time}Z",
    })


REFUND = sale("K-103", "08:20:30", customer="M-3", amount=-1.75, kind="refund")
POS_DAY_1 = [
    sale("K-101", "06:05:00", store="DOCK", amount=12.5),
    sale("K-102", "07:41:09", customer="M-2", amount=3.25),
    REFUND,
    sale("K-104", "08:59:59", store="DOCK", amount=40.0),
]
POS_DAY_2 = [
    sale("K-105", f"{DAY_BEFORE}T22:10:00Z", store="GATE", amount=8.0),  # of the day before the first
    REFUND,                                                              # delivered again
    sale("K-106", "09:05:45", store="", customer=None, amount="n/a"),    # no store, no customer, no number
]
ECOM = [
    order("W-1", "05:30:15", "M-1", 64.5, "CARD"),
    order("W-2", "06:02:00", "M-4", 19.99, "INVOICE"),
    order("W-3", "06:45:00", "M-2", 7.01, "CARD"),
]

CRM_8_HEADER = "customer_id,first_name,last_name,email,loyalty_status,city,country,updated_at"
CRM_9_HEADER = "customer_id,first_name,last_name,email,loyalty_status,city,country,membership_tier,updated_at"
MEMBERS = {
    "M-1": "Ines,Roth,ines@harbour.example,Gold,Kiel,DE",
    "M-2": "Jo,Lund,jo@harbour.example,Silver,Aarhus,DK",
    "M-3": "Kai,Moe,kai@harbour.example,Bronze,Bergen,NO",
    "M-4": "Lea,Noor,lea@harbour.example,Bronze,Delft,NL",
    "M-5": "Max,Oak,max@harbour.example,Silver,Hull,GB",
}


def member(key, day, tier=None):
    """A customer line; the layout with a tier has one column more."""
    return ",".join([key, MEMBERS[key], *([tier] if tier else []), f"{day}T08:00:00Z"])


CRM_DAY_1 = [member(key, DAY_1) for key in ("M-1", "M-2", "M-3", "M-4")]
# two members got a tier, one is new, two were not exported
CRM_DAY_2 = [member("M-1", DAY_2, "Plus"), member("M-3", DAY_2, "Base"), member("M-5", DAY_2, "Base")]

INVENTORY_HEADER = "product_id,store_id,product_name,quantity,price,last_updated"
INVENTORY = [
    f"B-1,PIER,Rope 20 m,14,18.9,{DAY_1}T00:30:00Z",
    f'B-2,PIER,"Lamp, red",0,7.45,{DAY_1}T00:30:00Z',  # sold out, and a comma in the name
    f"B-3,DOCK,Oar,3,55.0,{DAY_1}T00:30:00Z",
]


def lines(spark, values, source="memory"):
    return spark.createDataFrame([(v, source) for v in values], "value string, source_file string")


def write_lines(path, values, header=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(([header] if header else []) + list(values)) + "\n", encoding="utf-8")
