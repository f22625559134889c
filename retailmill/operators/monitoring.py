"""Run records, health views, freshness and value checks."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.clock import date_lit, days_within, minutes_between, ts_lit, whole_hours_between, within

FRESHNESS_LIMIT_MINUTES = 120
SUCCESS, FAILED = "SUCCESS", "FAILED"


def run_record(
    counts: DataFrame,
    pipeline: str,
    as_of: datetime | str,
    records_processed: Column,
    records_failed: Column | None = None,
    execution_seconds: int = 0,
    metadata: Mapping[str, Column] | None = None,
    status: str = SUCCESS,
) -> DataFrame:
    """A one-row frame of counts as a row for the monitoring table."""
    detail = (
        F.to_json(F.struct(*[v.alias(k) for k, v in metadata.items()]), {"ignoreNullFields": "false"})
        if metadata
        else F.lit(None).cast("string")
    )
    return counts.select(
        F.lit(pipeline).alias("pipeline_name"),
        date_lit(as_of).alias("run_date"),
        ts_lit(as_of).alias("run_timestamp"),
        F.lit(status).alias("status"),
        records_processed.cast("bigint").alias("records_processed"),
        (F.lit(0) if records_failed is None else records_failed).cast("bigint").alias("records_failed"),
        F.lit(execution_seconds).cast("bigint").alias("execution_time_seconds"),
        F.lit(None).cast("string").alias("error_message"),
        detail.alias("metadata"),
    )


def execution_summary(runs: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    """Runs per pipeline and day: outcomes, average volume, average and longest time."""
    return (
        runs.where(days_within(F.col("run_date"), as_of, days))
        .groupBy("pipeline_name", "run_date")
        .agg(
            F.count("*").alias("total_runs"),
            F.sum(F.when(F.col("status") == SUCCESS, 1).otherwise(0)).alias("successful_runs"),
            F.sum(F.when(F.col("status") == FAILED, 1).otherwise(0)).alias("failed_runs"),
            F.avg("records_processed").alias("avg_records_processed"),
            F.avg("execution_time_seconds").alias("avg_execution_time_seconds"),
            F.max("execution_time_seconds").alias("max_execution_time_seconds"),
        )
        .orderBy(F.col("run_date").desc(), "pipeline_name")
    )


def failed_runs_by_day(runs: DataFrame, as_of: datetime | str, days: int = 7) -> DataFrame:
    """Pipelines that failed in the last days."""
    return (
        runs.where((F.col("status") == FAILED) & days_within(F.col("run_date"), as_of, days))
        .groupBy("pipeline_name")
        .agg(F.count("*").alias("failed_runs"), F.max("run_timestamp").alias("last_failure"))
        .where(F.col("failed_runs") > 0)
    )


def failed_runs_recent(runs: DataFrame, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """Pipelines that failed in the last hours, with the lexically largest error text."""
    return (
        runs.where((F.col("status") == FAILED) & within(F.col("run_timestamp"), as_of, hours=hours))
        .groupBy("pipeline_name")
        .agg(
            F.count("*").alias("failed_runs"),
            F.max("run_timestamp").alias("last_failure"),
            F.max("error_message").alias("latest_error"),
        )
    )


def late_summary(tracking: DataFrame, as_of: datetime | str, days: int = 30) -> DataFrame:
    """Late records per table and ingestion day."""
    done = F.col("processed")
    return (
        tracking.where(within(F.col("ingestion_timestamp"), as_of, days=days))
        .groupBy("table_name", F.to_date("ingestion_timestamp").alias("ingestion_date"))
        .agg(
            F.count("*").alias("total_late_records"),
            F.avg("arrival_delay_seconds").alias("avg_delay_seconds"),
            F.max("arrival_delay_seconds").alias("max_delay_seconds"),
            F.sum(F.when(done, 1).otherwise(0)).alias("processed_count"),
            F.sum(F.when(~done, 1).otherwise(0)).alias("pending_count"),
        )
        .orderBy(F.col("ingestion_date").desc(), "table_name")
    )


def _null_if_any_null(columns: tuple[str, ...]) -> Column:
    # one key part missing: no identity, so not counted as distinct
    if len(columns) == 1:
        return F.col(columns[0])
    joined: list[Column] = []
    for c in columns:
        joined += [F.lit("|"), F.col(c)] if joined else [F.col(c)]
    return F.concat(*joined)


_NEGATIVE = {
    schemas.POS.name: "amount",
    schemas.ECOM.name: "total_amount",
    schemas.INVENTORY.name: "quantity",
}


def data_quality_metrics(
    tables: Mapping[str, DataFrame], as_of: datetime | str, days: int = 7
) -> DataFrame:
    """One row of volume, identity, sign, tag and delay metrics per bronze table."""

    def branch(name: str) -> DataFrame:
        spec = schemas.TABLES[name]
        entity = F.count_distinct(_null_if_any_null(spec.required))
        missing = reduce(or_, [F.col(c).isNull() for c in spec.required])
        negative = (
            F.count_if(F.col(_NEGATIVE[name]) < 0) if name in _NEGATIVE else F.lit(0).cast("bigint")
        )
        return (
            tables[name]
            .where(within(F.col("ingestion_ts"), as_of, days=days))
            .agg(
                F.count("*").alias("total_records"),
                entity.alias("unique_entities"),
                F.count_if(missing).alias("null_entity_ids"),
                negative.alias("negative_amounts"),
                F.count_if(F.col("dq_status") == "INVALID").alias("dq_invalid_rows"),
                F.count_if(F.col("dq_status").isNull()).alias("dq_status_null_rows"),
                F.avg(whole_hours_between(F.col(spec.event_ts), F.col("ingestion_ts"))).alias(
                    "avg_arrival_delay_hours"
                ),
            )
            .select(
                F.lit(name).alias("table_name"),
                "total_records",
                "unique_entities",
                (F.col("total_records") - F.col("unique_entities")).alias("duplicate_entity_count"),
                "null_entity_ids",
                "negative_amounts",
                "dq_invalid_rows",
                "dq_status_null_rows",
                "avg_arrival_delay_hours",
            )
        )

    return reduce(DataFrame.unionByName, [branch(n) for n in schemas.TABLES if n in tables])


def freshness(
    tables: Mapping[str, DataFrame],
    as_of: datetime | str,
    limit_minutes: int = FRESHNESS_LIMIT_MINUTES,
) -> DataFrame:
    """Minutes from the last ingestion up to ``as_of`` per table; an empty table is not stale."""

    def branch(name: str, df: DataFrame) -> DataFrame:
        seen = df.where(within(F.col("ingestion_ts"), as_of))
        return seen.agg(F.max("ingestion_ts").alias("latest_ingestion")).select(
            F.lit(name).alias("table_name"), "latest_ingestion"
        )

    latest = reduce(DataFrame.unionByName, [branch(n, df) for n, df in tables.items()])
    minutes = minutes_between(F.col("latest_ingestion"), ts_lit(as_of))
    return latest.withColumn("minutes_since_last_ingestion", minutes).withColumn(
        "is_stale", F.coalesce(F.col("minutes_since_last_ingestion") > limit_minutes, F.lit(False))
    )


def value_check(
    observed: DataFrame, column: str, pass_value: float, tolerance: float, upper_bound_only: bool = False
) -> DataFrame:
    """Whether a one-row result lies within ``pass_value`` plus or minus the tolerance share.

    ``upper_bound_only`` accepts everything up to the upper end: few duplicates
    are then fine, while the two-sided check fails on them.
    """
    value = F.col(column)
    low, high = sorted((pass_value * (1 - tolerance), pass_value * (1 + tolerance)))
    passed = value <= high if upper_bound_only else value.between(low, high)
    return observed.withColumn("passed", F.coalesce(passed, F.lit(False)))


def recent_duplicates(pos: DataFrame, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """Rows minus distinct transaction ids among recently ingested rows."""
    return (
        pos.where(within(F.col("ingestion_ts"), as_of, hours=hours))
        .agg(F.count("*").alias("n"), F.count_distinct("transaction_id").alias("ids"))
        .select((F.col("n") - F.col("ids")).alias("duplicate_count"))
    )


#: Log of the number of registers of a distinct-count sketch; the estimate is off by about 1.04 / 2^(k/2), 0.8 %.
SKETCH_SIZE = 14


def key_sketches(df: DataFrame, key: str) -> DataFrame:
    """Per hour of ingestion the number of rows with a key and a sketch of its distinct values.

    Sketches of different loads, hours or tables can be merged, so checks over any stretch of
    time read a few kilobytes an hour instead of the rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.date_trunc("hour", "ingestion_ts").alias("hour"))
        .agg(F.count("*").alias("row_count"), F.hll_sketch_agg(key, F.lit(SKETCH_SIZE)).alias("sketch"))
    )


def estimated_duplicates(sketches: DataFrame, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """Rows minus estimated distinct keys among the rows of the hours begun in the lookback."""
    merged = sketches.where(within(F.col("hour"), as_of, hours=hours)).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("ids"),
    )
    ids = F.least(F.coalesce("ids", F.lit(0)), F.col("row_count"))
    return merged.select("row_count", (F.col("row_count") - ids).alias("duplicate_count"))


def recent_failures(runs: DataFrame, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """Failed records summed over recent runs; NULL if there was none."""
    return runs.where(within(F.col("run_timestamp"), as_of, hours=hours)).agg(
        F.sum("records_failed").alias("total_failures")
    )


def recent_rows(df: DataFrame, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """Rows ingested in the last hours."""
    return df.where(within(F.col("ingestion_ts"), as_of, hours=hours)).agg(
        F.count("*").alias("recent_rows")
    )


def stream_liveness(pos: DataFrame, as_of: datetime | str, minutes: int = 5) -> DataFrame:
    """Whether the stream still delivers: recent rows and the newest ingestion among them."""
    return pos.where(within(F.col("ingestion_ts"), as_of, minutes=minutes)).agg(
        F.count("*").alias("recent_transactions"), F.max("ingestion_ts").alias("latest_ingestion")
    )


def hourly_run_record(df: DataFrame, pipeline: str, as_of: datetime | str, hours: int = 1) -> DataFrame:
    """The monitoring row of an hourly load: rows ingested in that hour."""
    return run_record(
        recent_rows(df, as_of, hours), pipeline, as_of, records_processed=F.col("recent_rows")
    )


def monitoring_report(
    runs: DataFrame,
    pos: DataFrame,
    as_of: datetime | str,
    pipeline: str = "monitoring_report",
    limit_minutes: int = FRESHNESS_LIMIT_MINUTES,
) -> DataFrame:
    """The monitoring row of the monitoring run itself: failures and stale tables."""
    failures = runs.where(
        (F.col("status") == FAILED) & within(F.col("run_timestamp"), as_of, hours=1)
    ).agg(F.count("*").alias("pipeline_failures"))
    stale = freshness({schemas.POS.name: pos}, as_of, limit_minutes).agg(
        F.count_if("is_stale").alias("stale_tables")
    )
    parts = failures.unionByName(stale, allowMissingColumns=True)
    counts = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    return run_record(
        counts,
        pipeline,
        as_of,
        records_processed=F.lit(0),
        metadata={c: F.col(c) for c in ("pipeline_failures", "stale_tables")},
    )
