"""Point-of-sale stream: messages to bronze and dead letters, windowed sales, dedup.

Rows go to Spark's file sink, whose commit log takes every micro-batch once, so a
restarted query leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailmill import schemas
from retailmill.functions.clock import ts_lit
from retailmill.functions.parsing import money, unfit
from retailmill.operators.latest import latest_per_key
from retailmill.sources.feeds import dead_letters, good_rows, parse_pos
from retailmill.sources.storage import exists, read_table, remove

WINDOW_SECONDS = 60
LATENESS_SECONDS = 3600


def parse_messages(messages: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Bronze rows plus ``_error``. ``ingestion_ts`` is the micro-batch's time unless given."""
    return parse_pos(messages, as_of)


def with_event_time(rows: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """``event_time``: when it happened, else when it came in, else now."""
    now = F.current_timestamp() if as_of is None else ts_lit(as_of)
    return rows.withColumn("event_time", F.coalesce("event_ts", "ingestion_ts", now))


def start_append(
    rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), **trigger
) -> StreamingQuery:
    """Appends rows with Spark's file sink, whose commit log takes each batch once and tells
    readers which files count."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy(*partition_by)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def finish(queries: Sequence[StreamingQuery]) -> None:
    """Waits until all have ended."""
    for query in queries:
        query.awaitTermination()


def start_bronze(
    messages: DataFrame,
    bronze_path: str,
    dead_letter_path: str,
    checkpoint: str,
    as_of: datetime | str | None = None,
    **trigger,
) -> list[StreamingQuery]:
    """Appends every parsed event to the day partitions of bronze and every rejected message to
    the dead letters: two queries over the same messages, each with its own checkpoint.
    Without ``as_of``, ``ingestion_ts`` is the batch's time, which a replay keeps."""
    parsed = parse_messages(messages, as_of)
    return [
        start_append(good_rows(parsed), bronze_path, f"{checkpoint}/rows", [schemas.POS.partition_column], **trigger),
        start_append(dead_letters(parsed), dead_letter_path, f"{checkpoint}/dead", **trigger),
    ]


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Streamed rows in the bronze table's columns; a filter on the day prunes files."""
    return read_table(spark, bronze_path, schemas.POS)


def windowed_sales(
    rows: DataFrame,
    window_seconds: int = WINDOW_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
) -> DataFrame:
    """Count and amount per store and tumbling window of event time, with the number of
    amounts that cannot be money and so are in no total.

    Rows later than the allowed lateness behind the watermark are dropped, which
    bounds the state to the windows still open.
    """
    return (
        with_event_time(rows)
        .withWatermark("event_time", f"{lateness_seconds} seconds")
        .groupBy(F.window("event_time", f"{window_seconds} seconds").alias("w"), "store_id")
        .agg(
            F.count("*").alias("sales_count"),
            F.sum(money(F.col("amount"))).alias("total_amount"),
            F.count_if(unfit(F.col("amount"))).alias("unfit_amounts"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "store_id",
            "sales_count",
            "total_amount",
            "unfit_amounts",
        )
    )


KEY = ("window_start", "store_id")


def start_windowed_sales(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    window_seconds: int = WINDOW_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    **trigger,
) -> list[StreamingQuery]:
    """Stores windows in two places. A window the watermark has passed is final: append mode
    emits it once, into day partitions. The windows still open are kept apart as one small
    state, which each batch writes anew with what it refined; it leaves out windows that
    ended more than twice the lateness before the newest one, which are final by then."""
    closed = start_append(
        windows.withColumn("window_date", F.to_date("window_start")), f"{path}/closed", f"{checkpoint}/closed",
        ["window_date"], **trigger,
    )
    state = f"{path}/open"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = batch.withColumn("generation", F.lit(1))
        before = f"{state}/batch={batch_id - 1}"
        if exists(spark, before):
            now = now.unionByName(spark.read.schema(batch.schema).parquet(before).withColumn("generation", F.lit(0)))
        merged = latest_per_key(now, KEY, "generation").drop("generation")
        newest = now.agg(F.max("window_end")).first()[0]
        if newest is not None:
            merged = merged.where(F.col("window_end") > newest - timedelta(seconds=window_seconds + 2 * lateness_seconds))
        merged.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        remove(spark, f"{state}/batch={batch_id - 2}")  # a replay needs the state before its own

    still_open = (
        windows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/open")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return [closed, still_open]


def read_windowed_sales(spark: SparkSession, path: str) -> DataFrame:
    """The final windows and, of those still open, the latest state. No window that was
    emitted earlier is read again: final ones were stored once."""
    state = spark.read.parquet(f"{path}/open")
    columns = [c for c in state.columns if c != "batch"]
    latest = state.where(F.col("batch") == state.agg(F.max("batch")).first()[0]).select(*columns)
    stored = T.StructType([*latest.schema.fields, T.StructField("window_date", T.DateType())])
    closed = spark.read.schema(stored).parquet(f"{path}/closed")
    first = latest.agg(F.min("window_start")).first()[0]
    near = closed if first is None else closed.where(F.col("window_date") >= F.lit(first).cast("date"))
    ended = near.select(*[F.col(k).alias(f"_{k}") for k in KEY])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY])
    return closed.select(*columns).unionByName(latest.join(ended, same, "left_anti"))


#: Into how many parts the copies of a key are split before they meet.
SALTS = 16


def dedup_stream(rows: DataFrame, lateness_seconds: int = LATENESS_SECONDS) -> DataFrame:
    """One row per transaction and event time within the watermark, the first to arrive.

    Copies are first thinned out by the input task that read them, in up to ``SALTS`` state
    partitions, and what is left by key: a key that holds most of the stream reaches its
    partition as a few rows. The table-level dedup, which keeps the latest, still runs
    afterwards for copies further apart than the allowed lateness.
    """
    key = ["transaction_id", "event_ts"]
    return (
        with_event_time(rows)
        .withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .withWatermark("event_time", f"{lateness_seconds} seconds")
        .dropDuplicatesWithinWatermark(["_salt", *key])
        .dropDuplicatesWithinWatermark(key)
        .drop("event_time", "_salt")
    )


def ingest_new_files(
    parsed_stream: DataFrame, path: str, checkpoint: str
) -> None:
    """Reads only files no earlier run has read; the checkpoint is the ledger."""
    start_append(parsed_stream, path, checkpoint).awaitTermination()
