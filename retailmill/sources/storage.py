"""Table layout, append, retention, archive and compaction on Parquet.

Tables are partitioned by day and sorted by their cluster columns inside each
file, so scans prune partitions and skip row groups. ``rebalance`` leaves the
file sizes to adaptive execution: a day that holds most of the rows is split
over many tasks, small days share one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill.functions.clock import date_lit
from retailmill.schemas import TableSpec


#: A third smaller than Parquet's usual codec on these tables.
CODEC = "zstd"


def with_partition_date(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds the partition column where the table derives it from its event time."""
    if spec.partition_column in df.columns:
        return df
    return df.withColumn(spec.partition_column, F.to_date(spec.event_ts))


def clustered(df: DataFrame, partition_column: str, cluster_columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", partition_column).sortWithinPartitions(
        partition_column, *cluster_columns
    )


def write_table(df: DataFrame, path: str, spec: TableSpec, mode: str = "append") -> None:
    """Writes rows into the day partitions. ``overwrite`` replaces the days present in
    ``df``, ``replace`` the whole directory."""
    laid_out = clustered(with_partition_date(df, spec), spec.partition_column, spec.cluster_columns)
    with uncoalesced(df.sparkSession):
        (
            laid_out.write.mode("overwrite" if mode == "replace" else mode)
            .option("partitionOverwriteMode", "static" if mode == "replace" else "dynamic")
            .partitionBy(spec.partition_column)
            .parquet(path, compression=CODEC)
        )


@contextmanager
def uncoalesced(spark: SparkSession) -> Iterator[None]:
    """Small shuffle partitions stay apart meanwhile. Rows are dealt by day, so a day is in one
    partition (or, if large, split) anyhow: merging them would not save a file, but have one
    task write the files of all small days one after the other."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored_schema(spec: TableSpec) -> T.StructType:
    """The table's columns and, where it derives it, the partition column."""
    if spec.partition_column in spec.schema.names:
        return spec.schema
    return T.StructType([*spec.schema.fields, T.StructField(spec.partition_column, T.DateType())])


def read_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The table with its declared column order; the partition column is kept for pruning.
    A table without any file is empty; files that retention has deleted since a stream's commit
    log listed them are passed over."""
    stored = stored_schema(spec)
    return spark.read.schema(stored).option("ignoreMissingFiles", "true").parquet(path).select(*stored.names)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder; whether there was one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def retained(df: DataFrame, spec: TableSpec, as_of: datetime | str) -> DataFrame:
    """Rows within the table's retention; rows without a date have no age and stay."""
    day = F.col(spec.partition_column)
    return df.where(day.isNull() | (day >= date_lit(as_of, spec.retention_days)))


def expired(df: DataFrame, spec: TableSpec, as_of: datetime | str) -> DataFrame:
    """The complement of :func:`retained`: what to archive, then drop."""
    return df.where(F.col(spec.partition_column) < date_lit(as_of, spec.retention_days))


def expired_partitions(df: DataFrame, spec: TableSpec, as_of: datetime | str) -> DataFrame:
    """The partitions to drop, with their row counts."""
    return (
        expired(df, spec, as_of)
        .groupBy(F.lit(spec.name).alias("table_name"), F.col(spec.partition_column).alias("partition_date"))
        .agg(F.count("*").alias("row_count"))
    )


def archive(df: DataFrame, archive_path: str, spec: TableSpec, as_of: datetime | str) -> None:
    """Copies expired days to the archive, keeping the day layout. A rerun replaces them."""
    write_table(expired(df, spec, as_of), archive_path, spec, mode="overwrite")


def compact(spark: SparkSession, path: str, target_path: str, spec: TableSpec) -> None:
    """Rewrites a table of many small files into a new directory."""
    if path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("compaction needs a target other than the table it reads")
    write_table(spark.read.parquet(path), target_path, spec, mode="overwrite")


# --- day partitions kept up to date ------------------------------------------


def day_of(df: DataFrame, spec: TableSpec) -> Column:
    """The partition day of a row: the table's column or, for rows without it, derived."""
    return F.col(spec.partition_column) if spec.partition_column in df.columns else F.to_date(spec.event_ts)


def days_of(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The days that rows fall on: ``day``, a date; NULL stands for rows without one."""
    return df.select(day_of(df, spec).alias("day")).distinct()


def day_list(days: DataFrame) -> list[date | None]:
    """Days as a list for pruning partitions: calendar days, a few thousand at most."""
    return [r.day for r in days.select("day").distinct().collect()]


def on_days(df: DataFrame, spec: TableSpec, days: Sequence[date | None]) -> DataFrame:
    """The rows of some days; of a stored table, only their partitions are listed and read."""
    day, dated = day_of(df, spec), [d for d in days if d is not None]
    wanted = day.isin(*dated) if dated else F.lit(False)
    return df.where(wanted | day.isNull() if None in days else wanted)


def replace_days(df: DataFrame, days: Sequence[date | None], path: str, spec: TableSpec, staged: str | None) -> None:
    """Makes the rows the whole contents of ``days``.

    The rows are written to ``staged`` first, so that they are kept if putting them in place
    breaks off; from there Spark's dynamic partition overwrite puts them in place, and listed days
    that got no row are dropped. Doing it again changes nothing. Without ``staged`` they go in
    place at once, for rows that can be made again from elsewhere; they may have been
    read from the table, whose files stay until the overwrite commits.
    """
    spark = df.sparkSession
    if staged is None:
        before = _files(spark, path, spec)
        write_table(df, path, spec, mode="overwrite")
        kept = {file.rsplit("/", 2)[-2] for file in before & _files(spark, path, spec)}
        emptied = [(spec.partition_column, d) for d in days]
        drop_partitions(spark, path, [p for p in emptied if _folder(*p) in kept])
        return
    with_partition_date(df, spec).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged, compression=CODEC)
    rows = read_table(spark, staged, spec)
    write_table(rows, path, spec, mode="overwrite")
    filled = set(day_list(days_of(rows, spec)))
    drop_partitions(spark, path, [(spec.partition_column, d) for d in days if d not in filled])


def _files(spark: SparkSession, path: str, spec: TableSpec) -> set[str]:
    """The table's files, as listed for any read of it."""
    return set(read_table(spark, path, spec).inputFiles()) if exists(spark, path) else set()


def _folder(column: str, day: date | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if day is None else day.isoformat()}"


def drop_partitions(spark: SparkSession, path: str, partitions: Sequence[tuple[str, date | None]], inside: str = "") -> int:
    """Deletes partition folders of a table, and returns how many there were."""
    n = 0
    for column, day in partitions:
        n += remove(spark, "/".join(p for p in (path, inside, _folder(column, day)) if p))
    return n


# --- file sizes ----------------------------------------------------------------


def file_sizes(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Per day the number of files and their bytes: day, file_count, total_bytes. No column is read."""
    files = spark.read.schema(stored_schema(spec)).parquet(path).select(
        F.col(spec.partition_column).alias("day"), "_metadata.file_path", "_metadata.file_size"
    )
    return files.distinct().groupBy("day").agg(F.count("*").alias("file_count"), F.sum("file_size").alias("total_bytes"))


def days_to_compact(
    spark: SparkSession, path: str, spec: TableSpec, target_bytes: int = 256 << 20, spare_files: int = 4
) -> DataFrame:
    """The days that hold at least ``spare_files`` more files than their bytes need."""
    needed = F.ceil(F.col("total_bytes") / target_bytes)
    return file_sizes(spark, path, spec).where(F.col("file_count") - needed >= spare_files)


def compact_days(
    spark: SparkSession, path: str, spec: TableSpec, staged: str, target_bytes: int = 256 << 20, spare_files: int = 4
) -> DataFrame:
    """Rewrites, in place, only the days of many small files; returns these with their counts
    before. Adaptive execution cuts each into files of its advisory size."""
    found = days_to_compact(spark, path, spec, target_bytes, spare_files).collect()  # a row a day
    planned = spark.createDataFrame(found, "day date, file_count long, total_bytes long")
    if found:
        days = [r.day for r in found]
        replace_days(on_days(read_table(spark, path, spec), spec, days), days, path, spec, staged)
    return planned
