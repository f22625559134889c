"""Landing-zone scans. Each returns ``value`` (the untouched line) and ``source_file``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.clock import instant
from retailmill.schemas import CSV_HEADERS


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("value", F.col("_metadata.file_path").alias("source_file"))


def read_json_lines(spark: SparkSession, pattern: str | list[str]) -> DataFrame:
    """JSON-lines files matching a path or glob."""
    return _with_file(spark.read.text(pattern))


#: What a first line has to name to be a header: the key columns of a CSV feed.
CSV_KEYS = tuple(spec.required for spec in (schemas.CRM, schemas.INVENTORY))


def _header_names(line: Column) -> Column:
    """A header line's names in plain spelling: no byte-order mark, quotes, blanks or capitals."""
    return F.transform(F.split(F.regexp_replace(F.lower(line), r"[\x{FEFF}\"]", ""), ","), lambda name: F.trim(name))


def read_csv(
    spark: SparkSession, pattern: str | list[str], keys: Sequence[Sequence[str]] = CSV_KEYS, headers_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(lines, headers) of CSV files.

    ``headers`` has a row per file: source_file, line (its first line), header (its names;
    NULL if the line does not name the keys of any feed), declared (whether it is one of the
    declared headers). ``lines`` has every other line, whatever it holds: value, source_file,
    header (the names where they are not a declared header's, else NULL) and unheaded, true for
    a first line that is no header, which stays as a line to be rejected.

    A file's first line is the one with the least position in the block at offset 0.
    Positions are numbered by the scan in reading order; both uses of them share one file
    listing, hence the same splits, and it makes no difference where files are split. With
    ``headers_path`` the headers are written there first and read back.
    """
    text = spark.read.text(pattern).select(
        "value", F.col("_metadata.file_path").alias("source_file"), "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("_at"),
    )
    names = _header_names(F.col("value"))
    is_header = reduce(or_, [reduce(and_, [F.array_contains(names, k) for k in key]) for key in keys])
    # a name is part of the line once marks and quotes are gone; few lines need be taken apart
    low = F.lower("value")
    marked = low.contains('"') | low.contains("\ufeff")
    plain = F.when(marked, F.translate(low, "\ufeff\"", "")).otherwise(low)
    is_header = reduce(or_, [reduce(and_, [plain.contains(k) for k in key]) for key in keys]) & is_header
    # lines that could be headers are few, so only they are collected, a handful a file
    first = (
        text.where(F.col("file_block_start") == 0)
        .groupBy("source_file")
        .agg(F.min("_at").alias("_first"), F.collect_list(F.when(is_header, F.struct("_at", "value"))).alias("h"))
        .select("source_file", "_first", F.get(F.filter("h", lambda x: x["_at"] == F.col("_first")), 0)["value"].alias("line"))
    )
    named = F.when(F.col("line").isNotNull(), _header_names(F.col("line")))
    headers = first.withColumn("header", named).withColumn(
        "declared", F.coalesce(F.concat_ws(",", "header").isin(*CSV_HEADERS), F.lit(False))
    )
    if headers_path is not None:
        headers.write.mode("overwrite").parquet(headers_path)
        headers = spark.read.schema(headers.schema).parquet(headers_path)
    of_file = headers.select(
        "source_file", "_first", F.col("line").isNotNull().alias("_headed"), F.when(~F.col("declared"), F.col("header")).alias("header")
    )
    # a row a file, which the driver lists anyhow: dealt by file, a large file's lines would be one task's
    lines = text.join(F.broadcast(of_file), "source_file", "left").withColumn(
        "unheaded", F.coalesce(F.col("_at") == F.col("_first"), F.lit(False))
    )
    lines = lines.where(~(F.col("unheaded") & F.col("_headed"))).select("value", "source_file", "header", "unheaded")
    return lines, headers.drop("_first")


def read_csv_lines(spark: SparkSession, pattern: str | list[str]) -> DataFrame:
    """All lines of CSV files without each file's header; see :func:`read_csv`."""
    return read_csv(spark, pattern)[0]


def hourly_pattern(prefix: str, as_of: datetime | str) -> str:
    """The files of one hour: ``<prefix>/hourly/<date>/<hour>/*.json``, the hour not padded."""
    moment = instant(as_of)
    return f"{prefix.rstrip('/')}/hourly/{moment.date()}/{moment.hour}/*.json"


def stream_text_lines(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded messages: every new file of a directory, one message per line."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_file(reader.text(directory))
