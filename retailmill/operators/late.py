"""Records that reached the platform long after they happened."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.clock import seconds_between, ts_lit, whole_hours_between, within
from retailmill.operators.monitoring import run_record

TRACKED = (schemas.POS, schemas.ECOM, schemas.CRM)
KEY = ("table_name", "record_key", "event_timestamp", "ingestion_timestamp")
LATE_HOURS = 1
PIPELINE = "sp_process_late_arriving_data"


def late_records(
    tables: Mapping[str, DataFrame],
    as_of: datetime | str,
    lookback_days: int,
    table_name: str | None = "all",
) -> DataFrame:
    """Rows ingested within the lookback whose delay is over one whole hour, i.e. at least two.

    ``table_name`` of None or ``'all'`` covers every tracked table; otherwise
    only the named table is read.
    """
    wanted = [s for s in TRACKED if table_name in (None, "all", s.name) and s.name in tables]
    if not wanted:
        raise ValueError(f"no tracked table named {table_name!r}")

    def branch(spec: schemas.TableSpec) -> DataFrame:
        event, ingested = F.col(spec.event_ts), F.col("ingestion_ts")
        late = tables[spec.name].where(
            within(ingested, as_of, days=lookback_days)
            & event.isNotNull()
            & (whole_hours_between(event, ingested) > LATE_HOURS)
        )
        return late.select(
            F.lit(spec.name).alias("table_name"),
            F.col(spec.required[0]).alias("record_key"),
            event.alias("event_timestamp"),
            ingested.alias("ingestion_timestamp"),
            seconds_between(event, ingested).alias("arrival_delay_seconds"),
        )

    return reduce(DataFrame.unionByName, [branch(s) for s in wanted])


def late_upsert(tracking: DataFrame, late: DataFrame) -> DataFrame:
    """The tracking table after the upsert: known records keep their largest delay and
    their processed state, new ones start unprocessed. One aggregation over both
    sides, combined before the shuffle; running it again changes nothing."""
    incoming = late.select(
        *KEY,
        "arrival_delay_seconds",
        F.lit(False).alias("processed"),
        F.lit(None).cast("timestamp").alias("processed_timestamp"),
    )
    return (
        tracking.select(*incoming.columns)
        .unionByName(incoming)
        .groupBy(*KEY)
        .agg(
            F.max("arrival_delay_seconds").alias("arrival_delay_seconds"),
            F.bool_or("processed").alias("processed"),
            F.max("processed_timestamp").alias("processed_timestamp"),
        )
    )


def late_metrics(
    late: DataFrame, as_of: datetime | str, table_name: str | None = "all", execution_seconds: int = 0
) -> DataFrame:
    """The run's monitoring row: count, rounded average and largest delay."""
    counts = late.agg(
        F.count("*").alias("n"),
        F.round(F.avg("arrival_delay_seconds")).cast("bigint").alias("avg_delay"),
        F.max("arrival_delay_seconds").alias("max_delay"),
    )
    return run_record(
        counts,
        PIPELINE,
        as_of,
        records_processed=F.col("n"),
        execution_seconds=execution_seconds,
        metadata={
            "table_name_param": F.lit(table_name).cast("string"),
            "avg_delay_seconds": F.col("avg_delay"),
            "max_delay_seconds": F.col("max_delay"),
        },
    )


def pending_dates(tracking: DataFrame, table_name: str) -> DataFrame:
    """Event dates that hold late records not yet worked in."""
    return (
        tracking.where((F.col("table_name") == table_name) & ~F.col("processed"))
        .select(F.to_date("event_timestamp").alias("affected_date"))
        .distinct()
    )


def rows_to_reaggregate(facts: DataFrame, date_column: str, pending: DataFrame) -> DataFrame:
    """The facts of the affected dates only.

    The dates are distinct calendar days, so at most a few million four-byte
    values ever: small enough to broadcast, which also prunes the partitions of
    facts stored by that date.
    """
    dates = F.broadcast(pending.withColumnRenamed("affected_date", date_column))
    return facts.join(dates, date_column, "left_semi")


def mark_processed(tracking: DataFrame, as_of: datetime | str, table_name: str | None = None) -> DataFrame:
    """The tracking table after a backfill: pending rows get ``processed`` and its time."""
    pending = ~F.col("processed")
    if table_name is not None:
        pending = pending & (F.col("table_name") == table_name)
    return tracking.withColumn(
        "processed_timestamp",
        F.when(pending, ts_lit(as_of)).otherwise(F.col("processed_timestamp")),
    ).withColumn("processed", F.col("processed") | pending)
