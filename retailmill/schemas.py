"""Declared table schemas, keys and physical layout.

Schemas are never inferred: these definitions are the contract every reader
and writer uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_S, _D, _L, _B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
_TS, _DT = T.TimestampType(), T.DateType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], "required" not in f) for f in fields])


_LINEAGE = (
    ("ingestion_ts", _TS, "required"),
    ("source_file", _S),
    ("raw_payload", _S),
    ("record_hash", _S),
    ("dq_status", _S),
    ("dq_errors", _S),
)

RAW_POS = _struct(
    ("transaction_id", _S, "required"),
    ("store_id", _S),
    ("customer_id", _S),
    ("amount", _D),
    ("currency", _S),
    ("event_ts", _TS),
    ("event_date", _DT),
    *_LINEAGE,
)

RAW_ECOM = _struct(
    ("order_id", _S, "required"),
    ("customer_id", _S),
    ("store_id", _S),
    ("total_amount", _D),
    ("payment_type", _S),
    ("order_ts", _TS),
    ("order_date", _DT),
    *_LINEAGE,
)

RAW_CRM = _struct(
    ("customer_id", _S, "required"),
    ("first_name", _S),
    ("last_name", _S),
    ("email", _S),
    ("loyalty_status", _S),
    ("city", _S),
    ("country", _S),
    ("membership_tier", _S),
    ("updated_at", _TS),
    ("raw_extra_attributes", _S),
    *_LINEAGE,
)

RAW_INVENTORY = _struct(
    ("product_id", _S, "required"),
    ("store_id", _S, "required"),
    ("product_name", _S),
    ("quantity", _L),
    ("price", _D),
    ("last_updated", _TS),
    *_LINEAGE,
)

DEDUPLICATION_LOG = _struct(
    ("table_name", _S, "required"),
    ("record_hash", _S, "required"),
    ("record_key", _S),
    ("first_seen", _TS, "required"),
    ("last_seen", _TS, "required"),
    ("count", _L, "required"),
)

CUSTOMER_DIM = _struct(
    ("customer_sk", _S, "required"),
    ("customer_id", _S, "required"),
    ("first_name", _S),
    ("last_name", _S),
    ("email", _S),
    ("loyalty_status", _S),
    ("membership_tier", _S),
    ("city", _S),
    ("country", _S),
    ("effective_from", _TS, "required"),
    ("effective_to", _TS),
    ("is_current", _B, "required"),
    ("row_hash", _S, "required"),
    ("last_updated_ts", _TS, "required"),
)

PIPELINE_MONITORING = _struct(
    ("pipeline_name", _S, "required"),
    ("run_date", _DT, "required"),
    ("run_timestamp", _TS, "required"),
    ("status", _S, "required"),
    ("records_processed", _L),
    ("records_failed", _L),
    ("execution_time_seconds", _L),
    ("error_message", _S),
    ("metadata", _S),
)

LATE_ARRIVING = _struct(
    ("table_name", _S, "required"),
    ("record_key", _S, "required"),
    ("event_timestamp", _TS, "required"),
    ("ingestion_timestamp", _TS, "required"),
    ("arrival_delay_seconds", _L),
    ("processed", _B, "required"),
    ("processed_timestamp", _TS),
)

DAILY_STORE_SALES = _struct(
    ("store_id", _S),
    ("sale_date", _DT),
    ("transaction_count", _L),
    ("total_amount", T.DecimalType(28, 2)),
    ("refund_amount", T.DecimalType(28, 2)),
    ("largest_amount", T.DecimalType(18, 2)),
)

#: Header lines of the CSV feeds, without blanks: customers with and without a tier, stock.
CSV_HEADERS = (
    "customer_id,first_name,last_name,email,loyalty_status,city,country,updated_at",
    "customer_id,first_name,last_name,email,loyalty_status,city,country,membership_tier,updated_at",
    "product_id,store_id,product_name,quantity,price,last_updated",
)


@dataclass(frozen=True)
class TableSpec:
    """What the operators need to know about one bronze table."""

    name: str
    schema: T.StructType
    required: tuple[str, ...]          # a NULL here sends the line to the dead letters
    hash_keys: tuple[str, ...]         # deduplication-key registry, also the record hash
    batch_keys: tuple[str, ...]        # batch ingestion: one row per key ...
    batch_order: str                   # ... the one with the latest value of this column
    event_ts: str
    partition_column: str
    cluster_columns: tuple[str, ...]
    retention_days: int
    warehouse_keys: tuple[str, ...] = field(default=())  # table-level dedup; empty: none defined


POS = TableSpec(
    name="raw_pos_transactions", schema=RAW_POS, required=("transaction_id",),
    hash_keys=("transaction_id", "event_ts"),
    batch_keys=("transaction_id",), batch_order="ingestion_ts",
    warehouse_keys=("transaction_id", "event_ts"),
    event_ts="event_ts", partition_column="event_date",
    cluster_columns=("store_id", "customer_id", "transaction_id"),
    retention_days=365,
)
ECOM = TableSpec(
    name="raw_ecom_orders", schema=RAW_ECOM, required=("order_id",),
    hash_keys=("order_id",),
    batch_keys=("order_id",), batch_order="ingestion_ts",
    warehouse_keys=("order_id",),
    event_ts="order_ts", partition_column="order_date",
    cluster_columns=("customer_id", "store_id", "order_id"),
    retention_days=730,
)
CRM = TableSpec(
    name="raw_crm_customers", schema=RAW_CRM, required=("customer_id",),
    hash_keys=("customer_id", "updated_at"),
    batch_keys=("customer_id",), batch_order="updated_at",
    warehouse_keys=("customer_id", "updated_at"),
    event_ts="updated_at", partition_column="updated_date",
    cluster_columns=("customer_id", "email"),
    retention_days=1095,
)
INVENTORY = TableSpec(
    name="raw_inventory_snapshots", schema=RAW_INVENTORY, required=("product_id", "store_id"),
    hash_keys=("product_id", "store_id", "last_updated"),
    batch_keys=("product_id", "store_id"), batch_order="last_updated",
    event_ts="last_updated", partition_column="snapshot_date",
    cluster_columns=("product_id", "store_id"),
    retention_days=365,
)

# not a feed: only the layout of the tracking table, kept by ingestion day (no expiry is asked of it)
LATE_TRACKING = TableSpec(
    name="late_arriving_data", schema=LATE_ARRIVING, required=("table_name", "record_key"),
    hash_keys=(), batch_keys=(), batch_order="ingestion_timestamp",
    event_ts="ingestion_timestamp", partition_column="ingestion_date",
    cluster_columns=("table_name", "processed"),
    retention_days=1095,
)

# the daily mart, kept by sale day
DAILY_SALES = TableSpec(
    name="daily_store_sales", schema=DAILY_STORE_SALES, required=("store_id",),
    hash_keys=(), batch_keys=(), batch_order="sale_date",
    event_ts="sale_date", partition_column="sale_date", cluster_columns=("store_id",), retention_days=1095,
)

TABLES = {spec.name: spec for spec in (POS, ECOM, CRM, INVENTORY)}


def deduplication_keys(table_name: str) -> list[str]:
    """Key columns of a table, with or without a namespace prefix; none if unknown."""
    spec = TABLES.get(table_name.rsplit(".", 1)[-1])
    return list(spec.hash_keys) if spec else []
