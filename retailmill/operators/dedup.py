"""Removing repeated deliveries, and logging what was removed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailmill.functions.clock import warehouse_text
from retailmill.functions.hashing import record_hash
from retailmill.operators.latest import first_per_key, latest_per_key, total_order
from retailmill.schemas import TableSpec

INGESTED = "ingestion_ts"


def dedup_batch(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rule of batch ingestion: one row per business key within the load."""
    return latest_per_key(df, spec.batch_keys, spec.batch_order)


def dedup_by_hash(
    df: DataFrame, keys: Sequence[str], keep: str = "latest", order_column: str = INGESTED
) -> DataFrame:
    """One row per key fingerprint; NULL and empty text are the same key."""
    if keep not in ("latest", "first"):
        raise ValueError("keep is 'latest' or 'first'")
    keyed = df.withColumn("_fingerprint", record_hash(df, keys))
    return latest_per_key(keyed, ["_fingerprint"], order_column, newest=keep == "latest").drop("_fingerprint")


def _survivor_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    newest, *others = total_order(df, INGESTED, keys=[*keys, "record_hash"])
    # among equally new copies one with a hash survives, as the log assumes
    hashed = [F.col("record_hash").asc_nulls_last()] if "record_hash" in df.columns else []
    return [newest, *hashed, *others]


def dedup_table(df: DataFrame, spec: TableSpec, mode: str = "keep_one") -> DataFrame:
    """The rule of the stored table: latest ingestion per warehouse key.

    ``keep_one`` leaves one row per key. ``reference_delete`` reproduces a delete
    by (key, ingestion time): copies that share the newest time all go, and rows
    with a NULL in that tuple match nothing and all stay.
    """
    keys = list(spec.warehouse_keys)
    if not keys:
        raise ValueError(f"{spec.name} has no table-level dedup rule")
    order = _survivor_order(df, keys)
    if mode == "keep_one":
        return first_per_key(df, keys, order).drop("rn")
    if mode != "reference_delete":
        raise ValueError("mode is 'keep_one' or 'reference_delete'")
    comparable = reduce(and_, [F.col(c).isNotNull() for c in [*keys, INGESTED]])
    top_two = first_per_key(df.where(comparable), keys, order, n=2)
    runner_up = F.lead(INGESTED).over(Window.partitionBy(*keys).orderBy(*order))
    alone_on_top = (
        top_two.withColumn("_next", runner_up)
        .where((F.col("rn") == 1) & (F.col("_next").isNull() | (F.col("_next") < F.col(INGESTED))))
        .drop("rn", "_next")
    )
    return alone_on_top.unionByName(df.where(~comparable))


def _record_key(spec: TableSpec) -> Column:
    parts = [
        warehouse_text(F.col(k)) if k == spec.event_ts else F.col(k) for k in spec.warehouse_keys
    ]
    joined: list[Column] = []
    for part in parts:
        joined += [F.lit("|"), part] if joined else [part]
    return F.concat(*joined)


def duplicate_log(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per key and hash: how many extra copies there were and when they came in.

    The surviving copy is not counted. Ranking whole groups would put a key with
    millions of copies into one task, so the log is put together from parts that
    shrink before the shuffle: group totals and the group's second-newest time.
    The hash is computed from the key, so a key has one group, or two where some
    copies came without a hash.
    """
    keys = list(spec.warehouse_keys)
    group = [*keys, "record_hash"]
    narrow = df.select(*group, INGESTED)
    newest_first = [F.col(INGESTED).desc_nulls_last()]

    totals = narrow.groupBy(*group).agg(
        F.count("*").alias("copies"), F.min(INGESTED).alias("oldest"), F.max(INGESTED).alias("newest")
    )
    second = (
        first_per_key(narrow.where(F.col("record_hash").isNotNull()), group, newest_first, n=2)
        .where(F.col("rn") == 2)
        .select(*group, F.col(INGESTED).alias("second"))
    )
    # a union regroups NULL key parts correctly, which an equi-join would not;
    # placed by key, the groups of a key meet for the survivor without a further shuffle
    merged = (
        totals.unionByName(second, allowMissingColumns=True)
        .repartition(*keys)
        .groupBy(*group)
        .agg(*[F.max(c).alias(c) for c in ("copies", "oldest", "newest", "second")])
    )
    by_survivor = Window.partitionBy(*keys).orderBy(
        F.col("newest").desc_nulls_last(), F.col("record_hash").asc_nulls_last()
    )
    survives = F.when(F.row_number().over(by_survivor) == 1, 1).otherwise(0)
    merged = merged.withColumn("survives", survives).where(F.col("record_hash").isNotNull())
    extra = F.col("copies") - F.col("survives")
    return merged.where(extra > 0).select(
        F.lit(spec.name).alias("table_name"),
        "record_hash",
        _record_key(spec).alias("record_key"),
        F.col("oldest").alias("first_seen"),
        F.when(F.col("survives") == 1, F.col("second")).otherwise(F.col("newest")).alias("last_seen"),
        extra.cast("bigint").alias("count"),
    )


def deduplicate(df: DataFrame, spec: TableSpec, mode: str = "keep_one") -> tuple[DataFrame, DataFrame]:
    """(surviving rows, log rows) of one table."""
    return dedup_table(df, spec, mode), duplicate_log(df, spec)
