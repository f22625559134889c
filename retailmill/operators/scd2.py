"""Customer history (slowly changing dimension, type 2).

Plain Parquet has no MERGE, so an upsert computes the new state of the table:
closed history passes through untouched and one join of the open rows with the
new snapshot yields kept, expired and inserted rows together.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.clock import date_lit, instant, iso_text, ts_lit, within
from retailmill.functions.hashing import attributes_hash
from retailmill.operators.latest import first_per_key, total_order
from retailmill.operators.monitoring import run_record
from retailmill.sources.feeds import VALID

ATTRIBUTES = (
    "first_name", "last_name", "email", "loyalty_status", "membership_tier", "city", "country",
)
LOOKBACK_DAYS = 90
PIPELINE = "sp_upsert_customer_dim_scd2"


def source_snapshot(raw_crm: DataFrame, as_of: datetime | str, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """The newest valid version of each recently updated customer, with its hash.

    Keeping the newest ingestion per (customer, update time) and then the newest
    update per customer is one ranking by both times.
    """
    columns = ["customer_id", *ATTRIBUTES, "updated_at"]
    if schemas.CRM.partition_column in raw_crm.columns:
        # implied by the lookback below; lets a stored table skip its older partitions
        raw_crm = raw_crm.where(F.col(schemas.CRM.partition_column) >= date_lit(as_of, lookback_days))
    recent = raw_crm.where(
        F.col("updated_at").isNotNull()
        & (F.col("updated_at") >= ts_lit(as_of, days=lookback_days))
        & within(F.col("ingestion_ts"), as_of)
        & (F.col("dq_status").isNull() | (F.col("dq_status") == VALID))
    ).select(*columns, "ingestion_ts")
    newest, *ties = total_order(recent, "updated_at", keys=["customer_id", "ingestion_ts"])
    order = [newest, F.col("ingestion_ts").desc_nulls_last(), *ties]
    return (
        first_per_key(recent, ["customer_id"], order)
        .select(*columns)
        .withColumn("row_hash", attributes_hash(ATTRIBUTES))
    )


@dataclass(frozen=True)
class Scd2Result:
    """``changes`` holds the open rows after the run and those it expired, with ``change``
    in kept / expired / inserted; ``closed`` is earlier history."""

    closed: DataFrame
    changes: DataFrame

    @property
    def table(self) -> DataFrame:
        return self.closed.unionByName(self.changes.drop("change"))


def upsert(dim: DataFrame, snapshot: DataFrame, as_of: datetime | str) -> Scd2Result:
    """Expires changed customers and inserts their new version and new customers.

    Customers absent from the snapshot stay as they are; equal hashes change
    nothing, so a rerun on the same data is a no-op.
    """
    columns = [f.name for f in schemas.CUSTOMER_DIM.fields]
    dim = dim.select(*columns)
    now = ts_lit(as_of)
    old = dim.where(F.col("is_current")).select(F.struct(*columns).alias("o"))
    fresh = snapshot.select(F.struct(*snapshot.columns).alias("n"))
    paired = old.join(fresh, F.col("o.customer_id") == F.col("n.customer_id"), "full_outer")

    changed = F.col("o.row_hash") != F.col("n.row_hash")
    key_text = F.coalesce(F.col("n.customer_id"), F.lit(""))
    replaced = {
        "customer_sk": F.md5(F.concat_ws("|", key_text, iso_text(now))),
        "effective_from": now,
        "effective_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "last_updated_ts": F.col("n.updated_at"),
    }

    def row(values: dict, source: str, change: str):
        return F.struct(
            *[values.get(c, F.col(f"{source}.{c}")).alias(c) for c in columns],
            F.lit(change).alias("change"),
        )

    kept = row({}, "o", "kept")
    expired = row({"effective_to": now, "is_current": F.lit(False)}, "o", "expired")
    inserted = row(replaced, "n", "inserted")
    outcome = (
        F.when(F.col("o").isNull(), F.array(inserted))
        .when(changed, F.array(expired, inserted))
        .otherwise(F.array(kept))
    )
    changes = paired.select(F.explode(outcome).alias("r")).select("r.*")
    return Scd2Result(dim.where(~F.col("is_current")), changes)


def run_metrics(
    snapshot: DataFrame, result: Scd2Result, as_of: datetime | str, execution_seconds: int = 0
) -> DataFrame:
    """The run's monitoring row: processed, and inserted / updated in the metadata."""
    parts = snapshot.agg(F.count("*").alias("processed")).unionByName(
        result.changes.agg(
            F.count_if(F.col("change") == "inserted").alias("inserted"),
            F.count_if(F.col("change") == "expired").alias("updated"),
        ),
        allowMissingColumns=True,
    )
    counts = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    return run_record(
        counts,
        PIPELINE,
        as_of,
        records_processed=F.col("processed"),
        execution_seconds=execution_seconds,
        metadata={"records_inserted": F.col("inserted"), "records_updated": F.col("updated")},
    )


def scd2_upsert(
    dim: DataFrame, raw_crm: DataFrame, as_of: datetime | str
) -> tuple[DataFrame, DataFrame]:
    """(new state of the dimension, monitoring row)."""
    as_of = instant(as_of)
    snapshot = source_snapshot(raw_crm, as_of)
    result = upsert(dim, snapshot, as_of)
    return result.table, run_metrics(snapshot, result, as_of)


def empty_dim(spark) -> DataFrame:
    return spark.createDataFrame([], schemas.CUSTOMER_DIM)
