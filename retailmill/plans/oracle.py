"""The registered queries as plain SQL over the source tables, for checking results.

Written from the meaning of each query, not from its DataFrame form. Dates and
times come out as text and decimals as doubles, as the registry prints them.
"""

from __future__ import annotations

import re

from retailmill.plans.queries import (
    ALL_DAYS, ARCHIVE_NOW, LATE_NOW, POS_NOW, RETENTION_NOW, RUN_1, RUN_2, YEAR,
)

ORACLE: dict[str, str] = {}


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _bool(x: str) -> str:
    return f"CASE WHEN {x} THEN 'true' WHEN NOT ({x}) THEN 'false' END"


def _at(literal: str) -> str:
    return f"TIMESTAMP '{literal}'"


def _micros(x: str) -> str:
    return f"(microsecond({x}) % 1000000)"


def _iso(x: str) -> str:
    return (
        f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN {_micros(x)} <> 0 THEN strftime({x}, '.%f') ELSE '' END || '+00:00'"
    )


def _warehouse_ts(x: str) -> str:
    return (
        f"strftime({x}, '%Y-%m-%d %H:%M:%S') || CASE WHEN {_micros(x)} = 0 THEN '' "
        f"WHEN {_micros(x)} % 1000 = 0 THEN strftime({x}, '.%g') ELSE strftime({x}, '.%f') END || '+00'"
    )


_TIER = (
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'Gold' WHEN 'AUTOMOBILE' THEN 'Silver' "
    "WHEN 'HOUSEHOLD' THEN 'Platinum' ELSE 'Bronze' END"
)

_PARTS: dict[str, str] = {
    "transactions": """
      SELECT l_orderkey || '-' || l_linenumber AS transaction_id, 'C' || o_custkey AS customer_id,
        'P' || l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
        CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS sale_amount,
        CAST(l_shipdate AS DATE) AS sale_date,
        CASE WHEN l_returnflag = 'R' THEN TRUE
             WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'O') THEN FALSE END AS is_return,
        l_shipdate AS ingestion_timestamp
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "profiles": f"""
      SELECT 'C' || c_custkey AS customer_id, {_TIER} AS loyalty_tier, c_acctbal > 0 AS is_active,
        n_name AS country, DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) AS registration_date
      FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "latest": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
        ingestion_timestamp DESC NULLS LAST, customer_id NULLS LAST, product_id NULLS LAST, quantity NULLS LAST,
        sale_amount NULLS LAST, sale_date NULLS LAST, is_return NULLS LAST) AS rn FROM transactions)
      WHERE rn = 1""",
    "pos_k": """
      SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, 1 AS delivery FROM events
      UNION ALL
      SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k, 2 AS delivery FROM events
      WHERE event_type = 'purchase'""",
    "pos_d": """
      SELECT *, event_type = 'error' AND k < 10 AS broken,
        CASE WHEN NOT (event_type = 'error' AND k >= 90) THEN 'T' || event_id END AS tid,
        CASE WHEN k = 7 THEN '' ELSE 'S' || (k % 20) END AS sid,
        CASE WHEN k <> 33 THEN 'C' || user_id END AS cid,
        CASE WHEN event_type = 'signup' THEN -value ELSE value END AS signed,
        k % 20 >= 10 AS western,
        ts + to_minutes(CASE delivery WHEN 1 THEN k * 2 ELSE k * 3 END) AS delivered_ts
      FROM pos_k""",
    "pos_rows": f"""
      SELECT *, md5(coalesce(transaction_id, '') || '|' || coalesce({_iso('event_ts')}, '')) AS record_hash FROM (
        SELECT CASE WHEN NOT broken THEN tid END AS transaction_id,
          CASE WHEN NOT broken THEN sid END AS store_id,
          CASE WHEN NOT broken THEN cid END AS customer_id,
          CASE WHEN NOT broken AND k <> 50 THEN signed END AS amount,
          CASE WHEN NOT broken THEN 'USD' END AS currency,
          CASE WHEN NOT broken THEN ts END AS event_ts,
          CASE WHEN NOT broken THEN
            CAST(CASE WHEN western THEN ts - INTERVAL 5 HOUR ELSE ts END AS DATE) END AS event_date,
          delivered_ts AS ingestion_ts, 'delivery_' || delivery AS source_file,
          CASE WHEN broken THEN 'INVALID' ELSE 'VALID' END AS dq_status,
          CASE WHEN broken THEN 'JSON_PARSE_ERROR' END AS dq_errors
        FROM pos_d)""",
    "raw_pos": "SELECT * FROM pos_rows WHERE transaction_id IS NOT NULL",
    "pos_lines": """
      SELECT CASE WHEN broken THEN left(line, length(line) - 5) ELSE line END AS line, broken, tid FROM (
        SELECT broken, tid, '{' || CASE WHEN tid IS NOT NULL THEN '"transaction_id":"' || tid || '",' ELSE '' END
          || '"store_id":"' || sid || '",'
          || CASE WHEN cid IS NOT NULL THEN '"customer_id":"' || cid || '",' ELSE '' END
          || '"event_type":"' || event_type || '",'
          || '"amount":' || CASE WHEN k = 50 THEN '"notanumber"' ELSE CAST(signed AS VARCHAR) END
          || ',"currency":"USD","timestamp":"'
          || CASE WHEN western THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'
                  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END
          || '"}' AS line
        FROM pos_d)""",
    "raw_ecom": """
      SELECT 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id, 'ONLINE' AS store_id,
        CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END
          AS total_amount,
        CASE o_orderstatus WHEN 'F' THEN 'CARD' WHEN 'O' THEN 'WALLET' END AS payment_type,
        CAST(o_orderdate AS TIMESTAMP) AS order_ts, CAST(o_orderdate AS DATE) AS order_date,
        CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(
          CASE delivery WHEN 1 THEN o_orderkey % 12 ELSE 12 + o_custkey % 24 END AS INT)) AS ingestion_ts,
        'delivery_' || delivery AS source_file, 'VALID' AS dq_status,
        md5('O' || o_orderkey) AS record_hash
      FROM (SELECT *, 1 AS delivery FROM orders
            UNION ALL SELECT *, 2 AS delivery FROM orders WHERE o_orderstatus = 'P')""",
    "raw_crm": f"""
      SELECT *, md5(customer_id || '|' || {_iso('updated_at')}) AS record_hash, 'VALID' AS dq_status,
        'delivery_' || delivery AS source_file, updated_at + to_hours(CAST(delay AS INT)) AS ingestion_ts
      FROM (
        SELECT 'C' || c_custkey AS customer_id, 'Customer' AS first_name,
          CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name || ', "Jr"' ELSE c_name END AS last_name,
          CASE WHEN c_acctbal < 0 THEN lower(c_name)
               ELSE replace(lower(c_name), '#', '.') || '@example.com' END AS email,
          CASE WHEN delivery > 1 AND c_mktsegment = 'MACHINERY' THEN 'Gold' ELSE {_TIER} END AS loyalty_status,
          'City ' || c_nationkey AS city, n_name AS country,
          CASE WHEN c_acctbal > 5000 THEN 'Plus' ELSE 'Basic' END AS membership_tier,
          CASE WHEN delivery = 1 THEN TIMESTAMP '2025-10-20 08:00:00'
               ELSE TIMESTAMP '2025-10-21 08:00:00' END AS updated_at,
          c_custkey % 5 + CASE WHEN delivery = 3 THEN 6 ELSE 0 END AS delay, delivery
        FROM (SELECT *, 1 AS delivery FROM customer UNION ALL SELECT *, 2 FROM customer
              UNION ALL SELECT *, 3 FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
        LEFT JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT 'B' || s_suppkey, 'Business', s_name, replace(lower(s_name), '#', '.') || '@example.com', 'Silver',
          'City ' || s_nationkey, n_name, NULL, TIMESTAMP '2025-10-21 08:00:00', 0, 2
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)""",
    "raw_inventory": f"""
      SELECT *, md5(product_id || '|' || store_id || '|' || {_iso('last_updated')}) AS record_hash FROM (
        SELECT 'P' || l_partkey AS product_id, 'S' || l_suppkey AS store_id, p_name AS product_name,
          CASE WHEN abs(l_quantity) <> 50 THEN CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
            THEN -l_quantity ELSE l_quantity END AS BIGINT) END AS quantity,
          p_retailprice AS price, CAST(l_shipdate AS TIMESTAMP) AS last_updated,
          CAST(l_shipdate AS TIMESTAMP) + to_hours(l_linenumber) AS ingestion_ts, 'VALID' AS dq_status
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)""",
    "runs": """
      SELECT event_type AS pipeline_name, CAST(ts AS DATE) AS run_date, ts AS run_timestamp,
        CASE WHEN k < 20 THEN 'FAILED' ELSE 'SUCCESS' END AS status, k * 10 AS records_processed,
        CASE WHEN k < 20 THEN k ELSE 0 END AS records_failed, user_id AS execution_time_seconds,
        CASE WHEN k < 20 THEN 'code ' || k END AS error_message
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    "inventory_latest": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id ORDER BY
        last_updated DESC NULLS LAST, product_name NULLS LAST, quantity NULLS LAST, price NULLS LAST,
        ingestion_ts NULLS LAST) AS rn FROM raw_inventory) WHERE rn = 1""",
    "pos_survivors": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id, event_ts
        ORDER BY ingestion_ts DESC NULLS LAST, source_file) AS rn FROM raw_pos) WHERE rn = 1""",
    "ecom_survivors": """
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY ingestion_ts DESC NULLS LAST, source_file) AS rn FROM raw_ecom) WHERE rn = 1""",
    "all_sales": """
      SELECT 'POS' AS channel, transaction_id AS sale_id, store_id, customer_id, event_ts AS sale_ts,
        event_date AS sale_date, CAST(amount AS DECIMAL(18,2)) AS amount FROM raw_pos
      UNION ALL
      SELECT 'ECOM', order_id, store_id, customer_id, order_ts, order_date,
        CAST(total_amount AS DECIMAL(18,2)) FROM raw_ecom""",
    "sales": """
      SELECT 'POS' AS channel, transaction_id AS sale_id, store_id, customer_id, event_ts AS sale_ts,
        event_date AS sale_date, CAST(amount AS DECIMAL(18,2)) AS amount FROM pos_survivors
      UNION ALL
      SELECT 'ECOM', order_id, store_id, customer_id, order_ts, order_date,
        CAST(total_amount AS DECIMAL(18,2)) FROM ecom_survivors""",
    "late": f"""
      SELECT 'raw_pos_transactions' AS table_name, transaction_id AS record_key, event_ts AS event_timestamp,
        ingestion_ts AS ingestion_timestamp, date_sub('second', event_ts, ingestion_ts) AS arrival_delay_seconds
      FROM raw_pos WHERE ingestion_ts BETWEEN {_at(LATE_NOW)} - INTERVAL {ALL_DAYS} DAY AND {_at(LATE_NOW)}
        AND event_ts IS NOT NULL AND date_sub('hour', event_ts, ingestion_ts) > 1
      UNION ALL
      SELECT 'raw_ecom_orders', order_id, order_ts, ingestion_ts, date_sub('second', order_ts, ingestion_ts)
      FROM raw_ecom WHERE ingestion_ts BETWEEN {_at(LATE_NOW)} - INTERVAL {ALL_DAYS} DAY AND {_at(LATE_NOW)}
        AND order_ts IS NOT NULL AND date_sub('hour', order_ts, ingestion_ts) > 1
      UNION ALL
      SELECT 'raw_crm_customers', customer_id, updated_at, ingestion_ts, date_sub('second', updated_at, ingestion_ts)
      FROM raw_crm WHERE ingestion_ts BETWEEN {_at(LATE_NOW)} - INTERVAL {ALL_DAYS} DAY AND {_at(LATE_NOW)}
        AND updated_at IS NOT NULL AND date_sub('hour', updated_at, ingestion_ts) > 1""",
    "tracking": """
      SELECT table_name, record_key, event_timestamp, ingestion_timestamp,
        max(arrival_delay_seconds) AS arrival_delay_seconds FROM late GROUP BY ALL""",
}

_SCD_ATTRIBUTES = "first_name, last_name, email, loyalty_status, membership_tier, city, country"
_SCD_HASH = (
    "md5(CAST(to_json(struct_pack("
    + ", ".join(f"{c} := {c}" for c in _SCD_ATTRIBUTES.split(", "))
    + ")) AS VARCHAR))"
)


def _snapshot(until: str) -> str:
    return f"""
      SELECT customer_id, {_SCD_ATTRIBUTES}, updated_at, {_SCD_HASH} AS row_hash FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, ingestion_ts DESC) AS rn
        FROM raw_crm WHERE ingestion_ts <= {_at(until)} AND updated_at >= {_at(until)} - INTERVAL 90 DAY
          AND (dq_status IS NULL OR dq_status = 'VALID'))
      WHERE rn = 1"""


def _sk(table: str, run: str) -> str:
    return f"md5({table}.customer_id || '|' || '{run.replace(' ', 'T')}+00:00')"


_PARTS["snap_1"] = _snapshot(RUN_1)
_PARTS["snap_2"] = _snapshot(RUN_2)
_DIM_COLUMNS = f"customer_id, {_SCD_ATTRIBUTES}"
_PARTS["dim_1"] = f"""
      SELECT {_sk('snap_1', RUN_1)} AS customer_sk, {_DIM_COLUMNS}, {_at(RUN_1)} AS effective_from,
        CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current, row_hash, updated_at AS last_updated_ts
      FROM snap_1"""
_PARTS["dim_2"] = f"""
      SELECT d.customer_sk, {', '.join('d.' + c for c in _DIM_COLUMNS.split(', '))}, d.effective_from,
        CASE WHEN n.row_hash <> d.row_hash THEN {_at(RUN_2)} END AS effective_to,
        NOT coalesce(n.row_hash <> d.row_hash, FALSE) AS is_current, d.row_hash, d.last_updated_ts
      FROM dim_1 d LEFT JOIN snap_2 n ON d.customer_id = n.customer_id
      UNION ALL
      SELECT {_sk('n', RUN_2)}, {', '.join('n.' + c for c in _DIM_COLUMNS.split(', '))}, {_at(RUN_2)}, NULL, TRUE,
        n.row_hash, n.updated_at
      FROM snap_2 n LEFT JOIN dim_1 d ON d.customer_id = n.customer_id
      WHERE d.customer_id IS NULL OR d.row_hash <> n.row_hash"""


def _with(needed: str, select: str) -> str:
    """Prefixes the parts a query needs, in definition order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            for other in _PARTS:
                if other != name and re.search(rf"\b{other}\b", _PARTS[name]):
                    add(other)
            wanted.add(name)

    for name in needed.split():
        add(name)
    order = [n for n in _PARTS if n in wanted]
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n]})" for n in order) + "\n" + select


def _oracle(name: str, needed: str, select: str) -> None:
    ORACLE[name] = _with(needed, select) if needed else select


# --- sales analytics ---------------------------------------------------------

_SOLD = f"sale_date BETWEEN DATE '{YEAR}-01-01' AND DATE '{YEAR}-12-31' AND is_return <> TRUE"

_oracle("top_products", "transactions", f"""
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
  CAST(sum(sale_amount) AS DOUBLE) AS total_sale_amount
FROM transactions WHERE {_SOLD} GROUP BY product_id
ORDER BY sum(sale_amount) DESC, product_id LIMIT 5""")

_oracle("mom_growth", "transactions", f"""
, monthly AS (SELECT date_trunc('month', sale_date) AS m, sum(sale_amount) AS total FROM transactions
  WHERE {_SOLD} GROUP BY 1),
lagged AS (SELECT m, total, CAST(total AS DOUBLE) AS t, lag(CAST(total AS DOUBLE)) OVER (ORDER BY m) AS p FROM monthly)
SELECT {_day('m')} AS month, CAST(total AS DOUBLE) AS total_sale_amount,
  round(CASE WHEN p IS NULL THEN 0.0 WHEN p = 0 THEN NULL ELSE 100.0 * (t - p) / p END, 6) AS mom_pct_growth
FROM lagged""")

_oracle("gold_customers", "transactions profiles", """
SELECT count(DISTINCT t.customer_id) AS active_gold_customers_over_100
FROM transactions t JOIN profiles c ON t.customer_id = c.customer_id
WHERE c.loyalty_tier = 'Gold' AND c.is_active = TRUE AND t.is_return <> TRUE AND t.sale_amount > 100""")

_oracle("latest_transactions", "transactions latest", f"""
SELECT transaction_id, customer_id, product_id, quantity, CAST(sale_amount AS DOUBLE) AS sale_amount,
  {_day('sale_date')} AS sale_date, {_bool('is_return')} AS is_return,
  {_ts('ingestion_timestamp')} AS ingestion_timestamp, rn FROM latest""")

_oracle("customer_lifetime_value", "transactions latest profiles", """
SELECT c.customer_id, c.country, CAST(coalesce(sum(CASE WHEN t.is_return THEN -t.sale_amount
  ELSE t.sale_amount END), 0) AS DOUBLE) AS clv_amount
FROM profiles c LEFT JOIN latest t ON t.customer_id = c.customer_id AND t.sale_date >= c.registration_date
GROUP BY c.customer_id, c.country""")

# --- feeds -------------------------------------------------------------------

_oracle("parse_pos_json", "raw_pos", f"""
SELECT transaction_id, store_id, customer_id, amount, currency, {_ts('event_ts')} AS event_ts,
  {_day('event_date')} AS event_date, {_ts(_at(POS_NOW))} AS ingestion_ts, record_hash, dq_status, dq_errors
FROM raw_pos""")

_oracle("parse_ecom_json", "raw_ecom", f"""
SELECT order_id, customer_id, store_id, total_amount, payment_type, {_ts('order_ts')} AS order_ts,
  {_day('order_date')} AS order_date, record_hash, dq_status FROM raw_ecom""")

_oracle("parse_crm_csv", "raw_crm", f"""
SELECT customer_id, first_name, last_name, email, loyalty_status, city, country, membership_tier,
  {_ts('updated_at')} AS updated_at, record_hash, dq_status FROM raw_crm""")

_oracle("parse_inventory_csv", "raw_inventory", f"""
SELECT product_id, store_id, product_name, CAST(quantity AS DOUBLE) AS quantity, price,
  {_ts('last_updated')} AS last_updated, record_hash, dq_status FROM raw_inventory""")

_oracle("dead_letter_pos", "pos_lines", """
SELECT 'Missing transaction_id' AS error, length(line) AS line_length, md5(line) AS line_md5, 'true' AS has_file
FROM pos_lines WHERE broken OR tid IS NULL""")

_oracle("dead_letter_summary", "pos_d", """
SELECT 'Missing transaction_id' AS error, 'delivery_' || delivery AS source_file, count(*) AS rejected
FROM pos_d WHERE broken OR tid IS NULL GROUP BY delivery""")

_oracle("ingest_hard_lines", "pos_d", """
SELECT CASE WHEN broken OR kind = 'none' THEN 'INVALID' ELSE 'VALID' END AS dq_status,
  CASE WHEN broken OR kind = 'none' OR tid IS NULL THEN 'true' ELSE 'false' END AS rejected,
  CASE WHEN broken OR signed IS NULL THEN 'none' ELSE kind END AS amount_kind, sum(times)::BIGINT AS line_count
FROM pos_d, (VALUES ('none', 4), ('nan', 1), ('infinite', 1), ('unfit', 1)) AS v(kind, times) GROUP BY ALL""")
_oracle("ingest_hard_csv", "raw_crm", """
SELECT reason, marked, has_text, count(*) AS line_count FROM raw_crm,
  (VALUES ('Missing customer_id', 'false', 'false'), ('none', 'true', 'true'), ('Repeated header', 'false', 'true'))
    AS k(reason, marked, has_text) GROUP BY ALL""")
_oracle("parse_crm_by_header", "raw_crm", f"""
SELECT customer_id, last_name, email, CASE WHEN delivery <> 2 THEN city END AS city, country, membership_tier,
  {_ts('updated_at')} AS updated_at, CASE delivery WHEN 2 THEN '{{"town":"' || city || '"}}' WHEN 3 THEN '{{"phone":"x"}}' END
    AS raw_extra_attributes
FROM raw_crm WHERE membership_tier IS NOT NULL""")
_oracle("csv_header_drift", "raw_crm", """
SELECT field, change, CASE change WHEN 'removed' THEN 'string' END AS declared_type,
  CASE change WHEN 'added' THEN 'string' END AS observed_type, 1::BIGINT AS file_count
FROM (VALUES (2, 'town', 'added'), (2, 'city', 'removed'), (3, 'phone', 'added')) AS v(d, field, change)
WHERE d IN (SELECT delivery FROM raw_crm WHERE membership_tier IS NOT NULL)""")
_oracle("contract_types", "pos_d", """
SELECT 'amount' AS field, 'type' AS rule, count(*) AS line_count FROM pos_d WHERE k = 50 AND NOT broken HAVING count(*) > 0""")
_oracle("contract_at_load", "pos_d", """
, d AS (SELECT broken OR tid IS NULL AS lost, k = 50 AND NOT broken AS odd FROM pos_d)
SELECT 'Missing transaction_id' AS what, count(*) AS line_count FROM d WHERE lost HAVING count(*) > 0
UNION ALL SELECT 'Wrong type of amount', count(*) FROM d WHERE odd AND NOT lost HAVING count(*) > 0
UNION ALL SELECT 'null_transaction_id', count(*) FROM d WHERE lost
UNION ALL SELECT 'type_amount', count(*) FROM d WHERE odd
UNION ALL SELECT 'type_event_ts', 0""")

_oracle("ingest_outcome", "pos_rows", """
SELECT dq_status, dq_errors, count(*) AS line_count, count(*) FILTER (transaction_id IS NULL) AS rejected
FROM pos_rows GROUP BY ALL""")

# --- dedup -------------------------------------------------------------------

_oracle("record_hashes", "raw_pos", "SELECT DISTINCT transaction_id, record_hash FROM raw_pos")

_POS_OUT = (
    f"transaction_id, store_id, customer_id, amount, {_ts('event_ts')} AS event_ts, "
    f"{_ts('ingestion_ts')} AS ingestion_ts, source_file"
)
_ECOM_OUT = (
    f"order_id, total_amount, {_ts('order_ts')} AS order_ts, {_ts('ingestion_ts')} AS ingestion_ts, source_file"
)


def _ranked(table: str, keys: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pick
FROM {table}) WHERE pick = 1"""


_oracle("dedup_pos_batch", "raw_pos",
        _ranked("raw_pos", "transaction_id", "ingestion_ts DESC, source_file", _POS_OUT))
_oracle("dedup_ecom_batch", "raw_ecom",
        _ranked("raw_ecom", "order_id", "ingestion_ts DESC, source_file", _ECOM_OUT))
_oracle("dedup_crm_batch", "raw_crm", _ranked(
    "raw_crm", "customer_id", "updated_at DESC, ingestion_ts",
    f"customer_id, loyalty_status, membership_tier, {_ts('updated_at')} AS updated_at, "
    f"{_ts('ingestion_ts')} AS ingestion_ts, source_file"))
_oracle("dedup_inventory_batch", "raw_inventory inventory_latest", f"""
SELECT product_id, store_id, CAST(quantity AS DOUBLE) AS quantity, price, {_ts('last_updated')} AS last_updated,
  {_ts('ingestion_ts')} AS ingestion_ts FROM inventory_latest""")
_oracle("dedup_keep_first", "raw_pos",
        _ranked("raw_pos", "record_hash", "ingestion_ts, source_file", _POS_OUT))
_oracle("dedup_pos_table", "pos_survivors", f"SELECT {_POS_OUT} FROM pos_survivors")
# loads arrive in order, so of two equally new copies the one stored first stays
ORACLE["dedup_pos_incremental"] = ORACLE["dedup_pos_table"]
ORACLE["dedup_incremental_rerun"] = ORACLE["dedup_pos_table"]
_oracle("hourly_ecom", "ecom_survivors", f"""
SELECT order_id, total_amount, {_day('order_date')} AS order_date, record_hash FROM ecom_survivors""")
_oracle("registered_keys", "raw_pos raw_ecom raw_crm raw_inventory", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count, count(DISTINCT struct_pack({', '.join(f'{k} := {k}' for k in keys)})) "
    f"AS key_count FROM {source}"
    for name, source, keys in (
        ("raw_pos_transactions", "raw_pos", ("transaction_id", "event_ts")), ("raw_ecom_orders", "raw_ecom", ("order_id",)),
        ("raw_crm_customers", "raw_crm", ("customer_id", "updated_at")),
        ("raw_inventory_snapshots", "raw_inventory", ("product_id", "store_id", "last_updated")))))
_oracle("unfit_amounts", "raw_pos raw_ecom", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count({value}) AS amounts, "
    f"count(*) FILTER ({value} IS NOT NULL AND TRY_CAST({value} * {factor} AS DECIMAL(18,2)) IS NULL) AS unfit FROM {source}"
    for name, source, value, factor in (
        ("raw_pos_transactions", "raw_pos", "amount", "1e13"), ("raw_ecom_orders", "raw_ecom", "total_amount", "1e11"))))
_oracle("dedup_ecom_table", "ecom_survivors", f"SELECT {_ECOM_OUT} FROM ecom_survivors")
ORACLE["dedup_ecom_incremental"] = ORACLE["dedup_ecom_table"]
_oracle("dedup_crm_table", "raw_crm", _ranked(
    "raw_crm", "customer_id, updated_at", "ingestion_ts DESC",
    f"customer_id, loyalty_status, {_ts('updated_at')} AS updated_at, "
    f"{_ts('ingestion_ts')} AS ingestion_ts, source_file"))


def _log(table: str, source: str, keys: str, record_key: str, order: str) -> str:
    return f"""
, ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS pick FROM {source})
SELECT '{table}' AS table_name, record_hash, {record_key} AS record_key, {_ts('min(ingestion_ts)')} AS first_seen,
  {_ts('max(ingestion_ts)')} AS last_seen, count(*) AS count
FROM ranked WHERE pick > 1 AND record_hash IS NOT NULL GROUP BY record_hash, {keys}"""


_oracle("dedup_pos_log", "raw_pos", _log(
    "raw_pos_transactions", "raw_pos", "transaction_id, event_ts",
    f"transaction_id || '|' || {_warehouse_ts('event_ts')}", "ingestion_ts DESC"))
_oracle("dedup_ecom_log", "raw_ecom", _log("raw_ecom_orders", "raw_ecom", "order_id", "order_id", "ingestion_ts DESC"))
_oracle("dedup_reference_delete", "raw_pos", f"""
, ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id, event_ts ORDER BY ingestion_ts DESC) AS pick
  FROM raw_pos)
SELECT {_POS_OUT} FROM raw_pos r WHERE NOT EXISTS (SELECT 1 FROM ranked x WHERE x.pick > 1
  AND x.transaction_id = r.transaction_id AND x.event_ts = r.event_ts AND x.ingestion_ts = r.ingestion_ts)""")

# --- customer history --------------------------------------------------------

_DIM_OUT = (
    f"customer_sk, {_DIM_COLUMNS}, {_ts('effective_from')} AS effective_from, {_ts('effective_to')} AS effective_to, "
    f"{_bool('is_current')} AS is_current, row_hash, {_ts('last_updated_ts')} AS last_updated_ts"
)
_oracle("scd2_source", "snap_2", f"SELECT {_DIM_COLUMNS}, {_ts('updated_at')} AS updated_at, row_hash FROM snap_2")
_oracle("scd2_initial", "dim_1", f"SELECT {_DIM_OUT} FROM dim_1")
_oracle("scd2_after_change", "dim_2", f"SELECT {_DIM_OUT} FROM dim_2")


def _run_row(pipeline: str, as_of: str, processed: str, metadata: str | None) -> str:
    """Columns of a monitoring row."""
    detail = f", {metadata} AS metadata" if metadata else ""
    return f"""'{pipeline}' AS pipeline_name, '{as_of[:10]}' AS run_date, {_ts(_at(as_of))} AS run_timestamp,
  'SUCCESS' AS status, CAST({processed} AS BIGINT) AS records_processed, CAST(0 AS BIGINT) AS records_failed,
  CAST(0 AS BIGINT) AS execution_time_seconds{detail}"""


def _json(**values: str) -> str:
    return f"CAST(json_object({', '.join(f'{k!r}, {v}' for k, v in values.items())}) AS VARCHAR)"


_oracle("scd2_metrics", "snap_2 dim_2", "SELECT " + _run_row(
    "sp_upsert_customer_dim_scd2", RUN_2, "(SELECT count(*) FROM snap_2)",
    _json(records_inserted=f"(SELECT count(*) FROM dim_2 WHERE effective_from = {_at(RUN_2)})",
          records_updated=f"(SELECT count(*) FROM dim_2 WHERE effective_to = {_at(RUN_2)})")))

# --- late data ---------------------------------------------------------------

_LATE_OUT = (
    f"table_name, record_key, {_ts('event_timestamp')} AS event_timestamp, "
    f"{_ts('ingestion_timestamp')} AS ingestion_timestamp, arrival_delay_seconds"
)
_oracle("late_records", "late", f"SELECT {_LATE_OUT} FROM late")
_oracle("late_records_one_table", "late", f"""
SELECT {_LATE_OUT} FROM late WHERE table_name = 'raw_pos_transactions'
  AND ingestion_timestamp BETWEEN {_at(POS_NOW)} - INTERVAL 7 DAY AND {_at(POS_NOW)}""")
_oracle("late_merge", "tracking", f"""
SELECT {_LATE_OUT}, {_bool("table_name = 'raw_ecom_orders'")} AS processed,
  CASE WHEN table_name = 'raw_ecom_orders' THEN {_ts(_at(LATE_NOW))} END AS processed_timestamp
FROM tracking""")
_oracle("late_metrics", "late", f"""
, m AS (SELECT count(*) AS n, CAST(round(avg(arrival_delay_seconds)) AS BIGINT) AS a,
  max(arrival_delay_seconds) AS x FROM late)
SELECT {_run_row('sp_process_late_arriving_data', LATE_NOW, 'n',
                 _json(table_name_param="'all'", avg_delay_seconds='a', max_delay_seconds='x'))} FROM m""")

_DAILY = """SELECT store_id, sale_date, count(*) AS transaction_count, sum(amount) AS total_amount,
    sum(amount) FILTER (amount < 0) AS refund_amount, max(amount) AS largest_amount
  FROM {source} GROUP BY store_id, sale_date"""
_DAILY_OUT = (
    f"store_id, {_day('sale_date')} AS sale_date, transaction_count, CAST(total_amount AS DOUBLE) AS total_amount, "
    "CAST(refund_amount AS DOUBLE) AS refund_amount, CAST(largest_amount AS DOUBLE) AS largest_amount"
)
_oracle("late_backfill_sales", "tracking all_sales", f"""
, affected AS (SELECT * FROM all_sales WHERE sale_date IN (SELECT CAST(event_timestamp AS DATE) FROM tracking
  WHERE table_name = 'raw_ecom_orders')),
daily AS ({_DAILY.format(source='affected')})
SELECT {_DAILY_OUT} FROM daily""")

# --- schema drift ------------------------------------------------------------

_oracle("schema_drift", "pos_d", """
SELECT 'event_type' AS field, 'added' AS change, CAST(NULL AS VARCHAR) AS declared_type, 'string' AS observed_type
WHERE EXISTS (SELECT 1 FROM pos_d WHERE NOT broken)
UNION ALL SELECT 'terminal_id', 'removed', 'string', NULL
UNION ALL SELECT 'amount', 'type_changed', 'double', 'string'
WHERE EXISTS (SELECT 1 FROM pos_d WHERE NOT broken AND k = 50)""")

_oracle("feed_profile", "pos_d", """
SELECT field, type, count(*) AS row_count FROM (
  SELECT unnest([CASE WHEN tid IS NOT NULL THEN 'transaction_id' END, 'store_id',
    CASE WHEN cid IS NOT NULL THEN 'customer_id' END, 'event_type', 'amount', 'currency', 'timestamp']) AS field,
    unnest(['string', 'string', 'string', 'string', CASE WHEN k = 50 THEN 'string' ELSE 'double' END, 'string', 'string']) AS type
  FROM pos_d WHERE NOT broken)
WHERE field IS NOT NULL GROUP BY ALL""")

_oracle("schema_merge", "raw_crm", f"""
SELECT customer_id, {_ts('updated_at')} AS updated_at, source_file,
  CASE WHEN source_file <> 'delivery_1' THEN membership_tier END AS membership_tier, 'true' AS schema_updated
FROM raw_crm""")

_oracle("crm_extra_attributes", "", """
SELECT 'C' || c_custkey AS customer_id, c_name AS last_name, CAST(NULL AS VARCHAR) AS email,
  '{"segment":"' || c_mktsegment || '","region_code":' || c_nationkey || ',"referrer":null}' AS raw_extra_attributes
FROM customer""")

_oracle("contract_violations", "pos_rows", """
SELECT 'transaction_id' AS column_name, count(*) FILTER (transaction_id IS NULL) AS violations FROM pos_rows
UNION ALL SELECT 'ingestion_ts', count(*) FILTER (ingestion_ts IS NULL) FROM pos_rows""")

# --- quality and monitoring --------------------------------------------------

_SCORE_NOW = _at("2001-06-30 00:00:00")
_SCORE = {
    "pos_null_transaction_id_count": "pos_rows WHERE transaction_id IS NULL",
    "ecom_null_order_id_count": "raw_ecom WHERE order_id IS NULL",
    "crm_null_customer_id_count": "raw_crm WHERE customer_id IS NULL",
    "inv_null_product_id_count": "raw_inventory WHERE product_id IS NULL",
    "inv_null_store_id_count": "raw_inventory WHERE store_id IS NULL",
    "pos_negative_amount_count": "pos_rows WHERE amount < 0",
    "ecom_negative_amount_count": "raw_ecom WHERE total_amount < 0",
    "pos_future_date_count": f"pos_rows WHERE event_ts > {_SCORE_NOW}",
    "ecom_future_date_count": f"raw_ecom WHERE order_ts > {_SCORE_NOW}",
    "crm_invalid_email_count": "raw_crm WHERE email IS NOT NULL AND email NOT LIKE '%@%.%'",
    "inv_negative_quantity_count": "raw_inventory WHERE quantity < 0",
    "pos_invalid_dq_row_count": "pos_rows WHERE dq_status = 'INVALID'",
    "ecom_invalid_dq_row_count": "raw_ecom WHERE dq_status = 'INVALID'",
    "crm_invalid_dq_row_count": "raw_crm WHERE dq_status = 'INVALID'",
    "inv_invalid_dq_row_count": "raw_inventory WHERE dq_status = 'INVALID'",
}
_oracle("dq_scorecard", "pos_rows raw_ecom raw_crm raw_inventory", "SELECT " + ",\n  ".join(
    [f"(SELECT count(*) FROM {source}) AS {name}" for name, source in _SCORE.items()]
    + ["(SELECT count(*) - count(DISTINCT transaction_id) FROM pos_rows WHERE transaction_id IS NOT NULL)"
       " AS pos_duplicate_transaction_count",
       "(SELECT count(*) - count(DISTINCT order_id) FROM raw_ecom WHERE order_id IS NOT NULL)"
       " AS ecom_duplicate_order_count"]))


def _metrics(table: str, source: str, entity: str, missing: str, negative: str, event: str) -> str:
    return f"""SELECT '{table}' AS table_name, count(*) AS total_records, count(DISTINCT {entity}) AS unique_entities,
  count(*) - count(DISTINCT {entity}) AS duplicate_entity_count, count(*) FILTER ({missing}) AS null_entity_ids,
  {negative} AS negative_amounts, count(*) FILTER (dq_status = 'INVALID') AS dq_invalid_rows,
  count(*) FILTER (dq_status IS NULL) AS dq_status_null_rows,
  round(avg(date_sub('hour', {event}, ingestion_ts)), 6) AS avg_arrival_delay_hours
FROM {source} WHERE ingestion_ts BETWEEN {_at(LATE_NOW)} - INTERVAL {ALL_DAYS} DAY AND {_at(LATE_NOW)}"""


_oracle("dq_metrics", "pos_rows raw_ecom raw_crm raw_inventory", "\nUNION ALL\n".join([
    _metrics("raw_pos_transactions", "pos_rows", "transaction_id", "transaction_id IS NULL",
             "count(*) FILTER (amount < 0)", "event_ts"),
    _metrics("raw_ecom_orders", "raw_ecom", "order_id", "order_id IS NULL",
             "count(*) FILTER (total_amount < 0)", "order_ts"),
    _metrics("raw_crm_customers", "raw_crm", "customer_id", "customer_id IS NULL", "CAST(0 AS BIGINT)", "updated_at"),
    _metrics("raw_inventory_snapshots", "raw_inventory", "product_id || '|' || store_id",
             "product_id IS NULL OR store_id IS NULL", "count(*) FILTER (quantity < 0)", "last_updated"),
]))

_oracle("execution_summary", "runs", f"""
SELECT pipeline_name, {_day('run_date')} AS run_date, count(*) AS total_runs,
  CAST(sum(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS successful_runs,
  CAST(sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_runs,
  round(avg(records_processed), 6) AS avg_records_processed,
  round(avg(execution_time_seconds), 6) AS avg_execution_time_seconds,
  max(execution_time_seconds) AS max_execution_time_seconds
FROM runs WHERE run_date BETWEEN DATE '{POS_NOW[:10]}' - 30 AND DATE '{POS_NOW[:10]}' GROUP BY pipeline_name, run_date""")

_oracle("late_summary", "tracking", f"""
SELECT table_name, {_day('ingestion_timestamp')} AS ingestion_date, count(*) AS total_late_records,
  round(avg(arrival_delay_seconds), 6) AS avg_delay_seconds, max(arrival_delay_seconds) AS max_delay_seconds,
  count(*) FILTER (table_name = 'raw_ecom_orders') AS processed_count,
  count(*) FILTER (table_name <> 'raw_ecom_orders') AS pending_count
FROM tracking GROUP BY 1, 2""")

_oracle("failed_runs_7d", "runs", f"""
SELECT pipeline_name, count(*) AS failed_runs, {_ts('max(run_timestamp)')} AS last_failure FROM runs
WHERE status = 'FAILED' AND run_date BETWEEN DATE '{POS_NOW[:10]}' - 7 AND DATE '{POS_NOW[:10]}' GROUP BY pipeline_name HAVING count(*) > 0""")

_oracle("failed_runs_1h", "runs", f"""
SELECT pipeline_name, count(*) AS failed_runs, {_ts('max(run_timestamp)')} AS last_failure,
  max(error_message) AS latest_error FROM runs
WHERE status = 'FAILED' AND run_timestamp BETWEEN {_at(POS_NOW)} - INTERVAL 1 HOUR AND {_at(POS_NOW)} GROUP BY pipeline_name""")

_oracle("freshness", "raw_pos raw_ecom", f"""
, latest_by_table AS (
  SELECT 'raw_pos_transactions' AS table_name, max(ingestion_ts) AS m FROM raw_pos WHERE ingestion_ts <= {_at(POS_NOW)}
  UNION ALL SELECT 'raw_ecom_orders', max(ingestion_ts) FROM raw_ecom WHERE ingestion_ts <= {_at(POS_NOW)})
SELECT table_name, {_ts('m')} AS latest_ingestion, date_sub('minute', m, {_at(POS_NOW)}) AS minutes_since_last_ingestion,
  {_bool(f"coalesce(date_sub('minute', m, {_at(POS_NOW)}) > 120, FALSE)")} AS is_stale FROM latest_by_table""")

_oracle("duplicate_check", "raw_pos", f"""
, d AS (SELECT count(*) - count(DISTINCT transaction_id) AS duplicate_count FROM raw_pos
  WHERE ingestion_ts BETWEEN {_at(POS_NOW)} - INTERVAL 1 HOUR AND {_at(POS_NOW)})
SELECT duplicate_count, {_bool('duplicate_count BETWEEN 90 AND 110')} AS passed FROM d""")
_oracle("duplicate_check_upper", "raw_pos", f"""
, d AS (SELECT count(*) - count(DISTINCT transaction_id) AS duplicate_count FROM raw_pos
  WHERE ingestion_ts BETWEEN {_at(POS_NOW)} - INTERVAL 24 HOUR AND {_at(POS_NOW)})
SELECT duplicate_count, {_bool('duplicate_count <= 110')} AS passed FROM d""")
_oracle("duplicate_sketches", "raw_pos raw_ecom", """
SELECT 'raw_pos_transactions' AS table_name, count(*) AS row_count, count(DISTINCT transaction_id) AS ids, 'true' AS close FROM raw_pos
UNION ALL SELECT 'raw_ecom_orders', count(*), count(DISTINCT order_id), 'true' FROM raw_ecom""")
_oracle("error_check", "runs", f"""
, d AS (SELECT CAST(sum(records_failed) AS BIGINT) AS total_failures FROM runs
  WHERE run_timestamp BETWEEN {_at(POS_NOW)} - INTERVAL 24 HOUR AND {_at(POS_NOW)})
SELECT total_failures, {_bool('coalesce(total_failures BETWEEN 900 AND 1100, FALSE)')} AS passed FROM d""")

_REPORT = _json(
    pipeline_failures=f"(SELECT count(*) FROM runs WHERE status = 'FAILED' "
                      f"AND run_timestamp BETWEEN {_at(POS_NOW)} - INTERVAL 1 HOUR AND {_at(POS_NOW)})",
    stale_tables=f"(SELECT count(*) FROM (SELECT max(ingestion_ts) AS m FROM raw_pos WHERE ingestion_ts <= {_at(POS_NOW)}) "
                 f"WHERE date_sub('minute', m, {_at(POS_NOW)}) > 120)")
_oracle("monitoring_report", "runs raw_pos", "SELECT " + _run_row("monitoring_report", POS_NOW, "0", _REPORT))
_LAST_HOUR = f"BETWEEN {_at(POS_NOW)} - INTERVAL 1 HOUR AND {_at(POS_NOW)}"
_oracle("monitoring_run", "runs raw_pos raw_ecom pos_survivors", f"""
, m AS (SELECT 'raw_pos_transactions' AS t, max(ingestion_ts) AS m FROM raw_pos WHERE ingestion_ts <= {_at(POS_NOW)}
  UNION ALL SELECT 'raw_ecom_orders', max(ingestion_ts) FROM raw_ecom WHERE ingestion_ts <= {_at(POS_NOW)}),
d AS (SELECT count(*) - count(DISTINCT transaction_id) AS n FROM pos_survivors WHERE ingestion_ts {_LAST_HOUR}),
e AS (SELECT CAST(sum(records_failed) AS BIGINT) AS n FROM runs WHERE run_timestamp {_LAST_HOUR})
SELECT 'freshness' AS output, t AS subject, date_sub('minute', m, {_at(POS_NOW)}) AS number,
  {_bool(f"coalesce(date_sub('minute', m, {_at(POS_NOW)}) > 120, FALSE)")} AS flag, {_ts('m')} AS detail FROM m
UNION ALL SELECT 'duplicate_check', 'raw_pos_transactions', n, {_bool('n BETWEEN 90 AND 110')}, NULL FROM d
UNION ALL SELECT 'error_check', 'pipeline_monitoring', n, {_bool('coalesce(n BETWEEN 900 AND 1100, FALSE)')}, NULL FROM e
UNION ALL SELECT 'report', 'monitoring_report', 0, 'SUCCESS', {_REPORT}""")
_oracle("recent_rows", "raw_pos",
        f"SELECT count(*) AS recent_rows FROM raw_pos WHERE ingestion_ts BETWEEN {_at(POS_NOW)} - INTERVAL 1 HOUR AND {_at(POS_NOW)}")
_oracle("stream_liveness", "raw_pos", f"""
SELECT count(*) AS recent_transactions, {_ts('max(ingestion_ts)')} AS latest_ingestion FROM raw_pos
WHERE ingestion_ts BETWEEN {_at(POS_NOW)} - INTERVAL 5 MINUTE AND {_at(POS_NOW)}""")
_oracle("hourly_metric", "raw_ecom", f"""
SELECT {_run_row('hourly_ecommerce', '1998-08-02 13:00:00',
                 "(SELECT count(*) FROM raw_ecom WHERE ingestion_ts BETWEEN TIMESTAMP '1998-08-02 12:00:00' "
                 "AND TIMESTAMP '1998-08-02 13:00:00')", None)}""")

# --- marts -------------------------------------------------------------------

_oracle("sales_fact", "sales", f"""
SELECT channel, sale_id, store_id, customer_id, {_ts('sale_ts')} AS sale_ts, {_day('sale_date')} AS sale_date,
  CAST(amount AS DOUBLE) AS amount FROM sales""")
_oracle("inventory_fact", "inventory_latest", f"""
SELECT {_day('last_updated')} AS snapshot_date, product_id, store_id, CAST(quantity AS DOUBLE) AS quantity,
  CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS price, {_ts('last_updated')} AS last_updated FROM inventory_latest""")
_oracle("store_dim", "all_sales raw_inventory", f"""
, seen AS (SELECT store_id, channel = 'POS' AS p, channel = 'ECOM' AS e, FALSE AS i FROM all_sales
  UNION ALL SELECT store_id, FALSE, FALSE, TRUE FROM raw_inventory)
SELECT store_id, {_bool('bool_or(p)')} AS sells_pos, {_bool('bool_or(e)')} AS sells_online,
  {_bool('bool_or(i)')} AS holds_inventory
FROM seen WHERE store_id IS NOT NULL AND store_id <> '' GROUP BY store_id""")
_oracle("product_dim", "raw_inventory", """
SELECT product_id, product_name, CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY last_updated DESC, product_name, price) AS pick
  FROM raw_inventory) WHERE pick = 1""")
_oracle("date_dim", "all_sales", f"""
, days AS (SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE) AS d
  FROM all_sales)
SELECT {_day('d')} AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day_of_month,
  isodow(d) AS iso_day_of_week, {_bool('isodow(d) >= 6')} AS is_weekend FROM days""")
_oracle("daily_store_sales", "sales", f", daily AS ({_DAILY.format(source='sales')}) SELECT {_DAILY_OUT} FROM daily")
ORACLE["materialized_daily_sales"] = ORACLE["daily_store_sales"]
_oracle("customer_360", "dim_2 sales", f"""
, per_customer AS (SELECT customer_id, count(*) AS n, count(*) FILTER (channel = 'ECOM') AS o, sum(amount) AS t,
  min(sale_date) AS f, max(sale_date) AS l FROM sales GROUP BY customer_id)
SELECT d.customer_id, first_name, last_name, loyalty_status, membership_tier, country,
  coalesce(n, 0) AS sales_count, coalesce(o, 0) AS online_count, CAST(coalesce(t, 0) AS DOUBLE) AS total_amount,
  {_day('f')} AS first_sale_date, {_day('l')} AS last_sale_date
FROM dim_2 d LEFT JOIN per_customer p ON d.customer_id = p.customer_id WHERE d.is_current""")
_oracle("inventory_kpi", "inventory_latest", """
SELECT store_id, count(*) AS positions, CAST(sum(quantity) AS DOUBLE) AS stock_on_hand,
  count(*) FILTER (quantity <= 0) AS out_of_stock,
  CAST(sum(quantity * CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS stock_value
FROM inventory_latest GROUP BY store_id""")
_oracle("kpi_reconciliation", "all_sales sales", f"""
, s AS (SELECT sale_date, sum(amount) AS a FROM all_sales GROUP BY 1),
t AS (SELECT sale_date, sum(amount) AS b FROM sales GROUP BY 1)
SELECT {_day('coalesce(s.sale_date, t.sale_date)')} AS sale_date, CAST(coalesce(a, 0) AS DOUBLE) AS source_amount,
  CAST(coalesce(b, 0) AS DOUBLE) AS target_amount,
  CAST(coalesce(a, 0) - coalesce(b, 0) AS DOUBLE) AS amount_difference
FROM s FULL OUTER JOIN t ON s.sale_date = t.sale_date""")

# --- streaming: the batch equivalents ----------------------------------------

_oracle("stream_pos_bronze", "raw_pos", f"""
SELECT transaction_id, store_id, customer_id, amount, {_ts('event_ts')} AS event_ts,
  {_day('event_date')} AS event_date, record_hash FROM raw_pos""")
_oracle("stream_pos_dead_letter", "pos_d", """
SELECT 'Missing transaction_id' AS error, count(*) AS rejected FROM pos_d
WHERE broken OR tid IS NULL HAVING count(*) > 0""")
_oracle("stream_windowed_sales", "raw_pos", f"""
SELECT {_ts("date_trunc('minute', event_ts)")} AS window_start,
  {_ts("date_trunc('minute', event_ts) + INTERVAL 1 MINUTE")} AS window_end, store_id, count(*) AS sales_count,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  count(*) FILTER (amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(18,2)) IS NULL) AS unfit_amounts
FROM raw_pos GROUP BY date_trunc('minute', event_ts), store_id""")
_oracle("stream_dedup", "raw_pos", f"""
SELECT transaction_id, {_ts('event_ts')} AS event_ts, any_value(amount) AS amount
FROM raw_pos GROUP BY transaction_id, event_ts""")
_oracle("stream_then_dedup", "pos_survivors", f"""
SELECT transaction_id, {_ts('event_ts')} AS event_ts, amount, record_hash FROM pos_survivors""")
ORACLE["dedup_stream_and_batch"] = ORACLE["stream_then_dedup"]
_oracle("incremental_files", "pos_d", "SELECT CAST(delivery AS BIGINT) AS run, count(*) AS line_count FROM pos_d GROUP BY delivery")

# --- storage -----------------------------------------------------------------

_oracle("partitioned_layout", "raw_pos", f"""
SELECT {_day('event_date')} AS event_date, count(*) AS row_count,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount FROM raw_pos GROUP BY event_date""")
_CUT = f"DATE '{RETENTION_NOW[:10]}'"
_oracle("retention_filter", "raw_ecom", f"""
SELECT {_day('order_date')} AS order_date, count(*) AS row_count FROM raw_ecom
WHERE order_date >= {_CUT} - 730 GROUP BY order_date""")
_oracle("expired_partitions", "raw_ecom", f"""
SELECT 'raw_ecom_orders' AS table_name, {_day('order_date')} AS partition_date, count(*) AS row_count FROM raw_ecom
WHERE order_date < {_CUT} - 730 GROUP BY order_date""")
_POS_CUT = f"DATE '{ARCHIVE_NOW[:10]}'"
_oracle("maintenance_run", "pos_survivors raw_pos", f"""
SELECT CASE WHEN event_date < {_POS_CUT} - 365 THEN 'archived' ELSE 'kept' END AS part, {_day('event_date')} AS day,
  count(*) AS row_count FROM pos_survivors GROUP BY ALL
UNION ALL SELECT 'raw', {_day('event_date')}, count(*) FROM raw_pos
  WHERE event_date IS NULL OR event_date >= {_POS_CUT} - 365 GROUP BY ALL""")
_oracle("archive_split", "raw_pos", f"""
SELECT 'archived' AS part, count(*) AS row_count FROM raw_pos WHERE event_date < {_POS_CUT} - 365
UNION ALL SELECT 'retained', count(*) FROM raw_pos WHERE event_date IS NULL OR event_date >= {_POS_CUT} - 365""")
_oracle("compaction_roundtrip", "raw_pos", f"""
SELECT transaction_id, amount, {_day('event_date')} AS event_date, {_ts('ingestion_ts')} AS ingestion_ts, source_file
FROM raw_pos""")
_oracle("compaction_run", "raw_pos", f"""
SELECT {_day('event_date')} AS day, count(*) AS row_count, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
  1::BIGINT AS file_count FROM raw_pos GROUP BY event_date""")
