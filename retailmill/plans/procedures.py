"""Batch loads and the daily chain, as functions a scheduler can call.

Every run writes its load under a directory named after the run and replaces it when the
run is repeated. The deduplicated tables are plain day partitions; a run puts the days it
touches in place as a whole, and a repeated one first puts back what its earlier attempt
changed, from the raw loads.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill import schemas
from retailmill.functions.clock import instant, ts_lit
from retailmill.operators import dedup, late, monitoring, quality, scd2
from retailmill.plans import marts
from retailmill.schemas import TableSpec
from retailmill.session import scratch_dir
from retailmill.sources import feeds, landing, storage


#: Before any row was streamed.
FIRST = "1970-01-01T00:00:00Z"


def run_name(as_of: datetime | str) -> str:
    return instant(as_of).strftime("%Y%m%dT%H%M%S")


@dataclass(frozen=True)
class Warehouse:
    """Directory layout: bronze loads, silver and gold tables, archive, logs, work files;
    each run has its own directories."""

    root: str

    def load(self, table: str, as_of: datetime | str) -> str:
        return f"{self.root}/bronze/{table}/load={run_name(as_of)}"

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def dead_letters(self, table: str, as_of: datetime | str) -> str:
        return f"{self.root}/dead_letter/{table}/load={run_name(as_of)}"

    def silver(self, table: str, as_of: datetime | str) -> str:
        return f"{self.root}/silver/{table}/run={run_name(as_of)}"

    def table(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def key_days(self, table: str) -> str:
        return f"{self.root}/silver/{table}_key_days"

    def sketches(self, table: str) -> str:
        return f"{self.root}/log/key_sketches/{table}"

    def mart(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def stream(self, table: str) -> str:
        return f"{self.root}/stream/{table}"

    def archive(self, table: str) -> str:
        return f"{self.root}/archive/{table}"

    def work(self, name: str, as_of: datetime | str) -> str:
        return f"{self.root}/work/{name}/run={run_name(as_of)}"

    def log(self, table: str, as_of: datetime | str, part: str) -> str:
        return f"{self.root}/log/{table}/run={run_name(as_of)}/part={part}"


def read_feed(spark: SparkSession, spec: TableSpec, pattern: str) -> DataFrame:
    if spec in (schemas.POS, schemas.ECOM):
        return landing.read_json_lines(spark, pattern)
    return landing.read_csv_lines(spark, pattern)


STAGED = "accepted"


def run_batch(
    spark: SparkSession,
    spec: TableSpec,
    input_pattern: str,
    output_path: str,
    dead_letter_path: str,
    as_of: datetime | str,
    work_path: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """One feed load: parse, check, split, dedup, write. Returns the run's monitoring row.

    The text is read and parsed once, into a work table split by outcome; dead
    letters and good rows are then two reads of the one part each. Counted while writing:
    lines, required fields without a value, typed fields with text that does not fit, and for
    CSV the files whose header is not a declared one. ``strict`` sends lines with a wrong
    type to the dead letters; else the value is NULL, as the feeds have always been read.
    """
    started = time.monotonic()
    work_path = work_path or scratch_dir(spark, f"{spec.name}-parsed")
    drifted = 0
    if spec in (schemas.POS, schemas.ECOM):
        lines = landing.read_json_lines(spark, input_pattern)
    else:
        lines, headers = landing.read_csv(spark, input_pattern, headers_path=f"{work_path}-headers")
        drifted = headers.where("header IS NOT NULL AND NOT declared").count()
    parsed = feeds.PARSERS[spec.name](lines, as_of)
    seen = Observation()
    broken = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in spec.required}
    broken |= {f"type_{c}": F.count_if(F.array_contains(feeds.MISFITS, c)) for c in feeds.TYPED[spec.name]}
    reason = feeds.rejection(parsed, strict)
    counts = {"n": F.count("*"), "rejected": F.count(reason), **broken}
    staged = parsed.observe(seen, *[value.alias(name) for name, value in counts.items()])
    (
        staged.withColumn(STAGED, reason.isNull())
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(STAGED)
        .parquet(work_path, compression=storage.CODEC)
    )
    stored = spark.read.schema(
        T.StructType([*parsed.schema.fields, T.StructField(STAGED, T.BooleanType())])
    ).parquet(work_path)
    accepted, rejected = (stored.where(F.col(STAGED) == ok).drop(STAGED) for ok in (True, False))
    feeds.dead_letters(rejected, strict).write.mode("overwrite").parquet(dead_letter_path)
    storage.write_table(dedup.dedup_batch(feeds.good_rows(accepted, strict), spec), output_path, spec, mode="replace")

    n = seen.get
    return monitoring.run_record(
        spark.range(1),
        f"{spec.name}_batch",
        as_of,
        records_processed=F.lit(n["n"] - n["rejected"]),
        records_failed=F.lit(n["rejected"]),
        execution_seconds=round(time.monotonic() - started),
        metadata={**{name: F.lit(n[name]) for name in broken}, "drifted_files": F.lit(drifted)},
    )


def read_bronze(spark: SparkSession, warehouse: Warehouse, spec: TableSpec, streamed: bool = False) -> DataFrame:
    """All raw rows of a table: its loads and, on demand, what was streamed."""
    loads = storage.read_table(spark, warehouse.bronze(spec.name), spec)
    if not streamed:
        return loads
    return loads.unionByName(storage.read_table(spark, warehouse.stream(spec.name), spec))


#: A day as written in local time is at most this far from any other local day of the same instant.
LOCAL_DAYS = 2
#: Parts of the table that says on which days a key was seen.
KEY_BUCKETS = 64


def _days_nearby(days: Sequence[date | None]) -> list[date | None]:
    """Days on which copies of rows of these days can lie when the event time is part of the key."""
    near = {d + timedelta(days=k) for d in days if d is not None for k in range(-LOCAL_DAYS, LOCAL_DAYS + 1)}
    return [None, *sorted(near)]


def _key_hash(spec: TableSpec) -> Column:
    return F.xxhash64(*spec.warehouse_keys)


def note_key_days(rows: DataFrame, path: str, spec: TableSpec) -> None:
    """Notes on which days the rows' keys lie: 64-bit key hashes with a day, by bucket of the hash."""
    noted = rows.select(_key_hash(spec).alias("key_hash"), storage.day_of(rows, spec).alias("day")).distinct()
    _write_key_days(noted.withColumn("bucket", _bucket()), path, "append")


def _bucket() -> Column:
    return F.pmod("key_hash", F.lit(KEY_BUCKETS)).cast("int")


def _write_key_days(noted: DataFrame, path: str, mode: str) -> None:
    noted.repartition("bucket").sortWithinPartitions("bucket", "key_hash").write.mode(mode).option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("bucket").parquet(path)


def read_key_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key_hash long, day date, bucket int").parquet(path)


def days_of_keys(spark: SparkSession, keys: DataFrame, path: str, spec: TableSpec) -> DataFrame:
    """The days on which copies of the keys may lie. Only the buckets of these keys are read, and
    no stored row is looked at. Equal hashes of different keys add a day in vain, nothing else."""
    wanted = keys.select(_key_hash(spec).alias("key_hash")).distinct().withColumn("bucket", _bucket())
    buckets = [r.bucket for r in wanted.select("bucket").distinct().collect()]  # KEY_BUCKETS at most
    noted = read_key_days(spark, path).where(F.col("bucket").isin(*buckets) if buckets else F.lit(False))
    return noted.join(wanted, ["bucket", "key_hash"], "left_semi").select("day").distinct()


def compact_key_days(spark: SparkSession, path: str, staged: str, spare_files: int = 8) -> int:
    """Rewrites the buckets of many small files without repeated entries; returns how many."""
    files = read_key_days(spark, path).select("bucket", "_metadata.file_path").distinct()
    full = files.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > spare_files)
    buckets = [r.bucket for r in full.collect()]  # KEY_BUCKETS at most
    if buckets:
        read_key_days(spark, path).where(F.col("bucket").isin(*buckets)).distinct().write.mode("overwrite").parquet(staged)
        _write_key_days(read_key_days(spark, staged), path, "overwrite")
    return len(buckets)


def _copies(stored: DataFrame, incoming: DataFrame, spec: TableSpec) -> DataFrame:
    """The key columns and day of stored rows that incoming rows duplicate."""
    keys = list(spec.warehouse_keys)
    own = stored.select(*keys, F.col(spec.partition_column).alias("day")).alias("s")
    new = incoming.select(*keys).distinct().alias("n")
    same = reduce(and_, [F.col(f"s.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    return own.join(new, same, "left_semi")


def _days_to_redo(
    spark: SparkSession, warehouse: Warehouse, stored: DataFrame, incoming: DataFrame, spec: TableSpec
) -> list[date | None]:
    """Days that incoming rows fall on, and days of stored rows they duplicate.

    Where the event time is part of the key, a copy lies on a day nearby; else the key table
    says on which days keys were seen. Of the stored table only the key columns of those days are read.
    """
    own = storage.day_list(storage.days_of(incoming, spec))
    if spec.event_ts in spec.warehouse_keys:
        candidates = _days_nearby(own)
    else:
        path = warehouse.key_days(spec.name)
        candidates = storage.day_list(days_of_keys(spark, incoming, path, spec)) if storage.exists(spark, path) else []
    copies = _copies(storage.on_days(stored, spec, candidates), incoming, spec)
    return list({*own, *storage.day_list(copies)})


def _put_back(
    spark: SparkSession, warehouse: Warehouse, spec: TableSpec, days: list[date | None], others: DataFrame, mode: str
) -> None:
    """Makes the days that an earlier attempt of a run redid what the other loads say."""
    own = storage.on_days(others, spec, days)
    if spec.event_ts in spec.warehouse_keys:
        candidates = _days_nearby(days)
    else:
        candidates = storage.day_list(days_of_keys(spark, own, warehouse.key_days(spec.name), spec))
    copies = storage.on_days(others, spec, list({*days, *candidates}))
    survivors = dedup.dedup_table(copies, spec, mode)
    storage.replace_days(storage.on_days(survivors, spec, days), days, warehouse.table(spec.name), spec, None)


def run_dedup(
    spark: SparkSession,
    warehouse: Warehouse,
    spec: TableSpec,
    as_of: datetime | str,
    mode: str = "keep_one",
    streamed_since: datetime | str | None = None,
) -> DataFrame:
    """Adds this run's load to the deduplicated table, redoing only the days it touches.

    With ``streamed_since``, rows that the stream has stored after that time, up to ``as_of``,
    take part, too. The removed copies go to the duplicate log of the run, where the table
    has one. A run that is repeated, perhaps with other input, gives what it would have given
    the first time.
    """
    path, run = warehouse.table(spec.name), run_name(as_of)
    with_stream = streamed_since is not None and storage.exists(spark, warehouse.stream(spec.name))
    incoming = storage.read_table(spark, warehouse.load(spec.name, as_of), spec)
    if with_stream:
        rows = storage.read_table(spark, warehouse.stream(spec.name), spec)
        new = (F.col(dedup.INGESTED) > ts_lit(streamed_since)) & (F.col(dedup.INGESTED) <= ts_lit(as_of))
        incoming = incoming.unionByName(rows.where(new))

    listed = warehouse.work(f"{spec.name}_days", as_of)
    if storage.exists(spark, listed):
        others = spark.read.schema(
            T.StructType([*storage.stored_schema(spec).fields, T.StructField("load", T.StringType())])
        ).parquet(warehouse.bronze(spec.name)).where(F.col("load") != run).drop("load")
        if with_stream:
            others = others.unionByName(rows.where(F.col(dedup.INGESTED) <= ts_lit(streamed_since)))
        redone = storage.day_list(spark.read.schema("day date").parquet(listed))
        _put_back(spark, warehouse, spec, redone, others, mode)

    stored = storage.read_table(spark, path, spec) if storage.exists(spark, path) else None
    if stored is None:
        days, candidates = storage.day_list(storage.days_of(incoming, spec)), incoming
    else:
        days = _days_to_redo(spark, warehouse, stored, incoming, spec)
        candidates = storage.on_days(stored, spec, days).unionByName(incoming)
    spark.createDataFrame([(d,) for d in days], "day date").write.mode("overwrite").parquet(listed)
    survivors, log = dedup.deduplicate(candidates, spec, mode)
    if spec is not schemas.CRM:
        log.write.mode("overwrite").parquet(warehouse.log("deduplication_log", as_of, spec.name))
    sketched = f"{warehouse.sketches(spec.name)}/run={run}"
    monitoring.key_sketches(incoming, spec.required[0]).coalesce(1).write.mode("overwrite").parquet(sketched)
    if spec.event_ts not in spec.warehouse_keys:
        note_key_days(incoming, warehouse.key_days(spec.name), spec)
    # a run that breaks off here is repeated from the raw loads
    storage.replace_days(survivors, days, path, spec, None)
    return storage.read_table(spark, path, spec)


def run_scd2(
    spark: SparkSession,
    warehouse: Warehouse,
    raw_crm: DataFrame,
    as_of: datetime | str,
    previous: datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Customer history after this run, and the run's monitoring row.

    Closed versions never change, so each run only adds the ones it closed; the
    open versions are written anew. ``previous`` is the run to build on.
    """
    open_name, closed_name = "customer_dim_open", "customer_dim_closed"
    dim = scd2.empty_dim(spark) if previous is None else spark.read.schema(schemas.CUSTOMER_DIM).parquet(
        warehouse.silver(open_name, previous)
    )
    sourced = warehouse.work("customer_dim_source", as_of)
    scd2.source_snapshot(raw_crm, as_of).write.mode("overwrite").parquet(sourced)
    snapshot = spark.read.parquet(sourced)
    result = scd2.upsert(dim, snapshot, as_of)
    # written once, then split and counted from the file
    staged = warehouse.work("customer_dim_changes", as_of)
    result.changes.write.mode("overwrite").partitionBy("change").parquet(staged)
    staged_schema = T.StructType([*schemas.CUSTOMER_DIM.fields, T.StructField("change", T.StringType())])
    changes = spark.read.schema(staged_schema).parquet(staged)
    changes.where(F.col("change") != "expired").drop("change").write.mode("overwrite").parquet(
        warehouse.silver(open_name, as_of)
    )
    changes.where(F.col("change") == "expired").drop("change").write.mode("overwrite").parquet(
        warehouse.silver(closed_name, as_of)
    )
    metrics = scd2.run_metrics(snapshot, scd2.Scd2Result(dim, changes), as_of)
    return read_customer_dim(spark, warehouse, as_of), metrics


def read_customer_dim(spark: SparkSession, warehouse: Warehouse, as_of: datetime | str) -> DataFrame:
    """The dimension as of a run: its open versions and all versions closed until then."""
    columns = [f.name for f in schemas.CUSTOMER_DIM.fields]
    current = spark.read.schema(schemas.CUSTOMER_DIM).parquet(warehouse.silver("customer_dim_open", as_of))
    closed = (
        spark.read.option("basePath", f"{warehouse.root}/silver/customer_dim_closed")
        .parquet(f"{warehouse.root}/silver/customer_dim_closed")
        .where(F.col("run").cast("string") <= run_name(as_of))
    )
    return current.select(*columns).unionByName(closed.select(*columns))


def run_late(
    spark: SparkSession,
    warehouse: Warehouse,
    tables: Mapping[str, DataFrame],
    as_of: datetime | str,
    table_name: str | None = "all",
    lookback_days: int = 7,
    refresh: Callable[[DataFrame], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The late-arrival tracking table after this run, and the run's monitoring row.

    The ingestion time is part of the key, so only the ingestion days of what was
    found are merged and rewritten. ``refresh`` is given what was found, works it into
    whatever depends on it, and lets the rows be stored as processed.
    """
    spec, path = schemas.LATE_TRACKING, warehouse.table(schemas.LATE_TRACKING.name)
    staged = warehouse.work("late_records", as_of)
    late.late_records(tables, as_of, lookback_days, table_name).write.mode("overwrite").parquet(staged)
    found = spark.read.parquet(staged)
    days = storage.day_list(storage.days_of(found, spec))
    tracking = (
        storage.on_days(storage.read_table(spark, path, spec), spec, days)
        if storage.exists(spark, path)
        else spark.createDataFrame([], spec.schema)
    )
    merged = late.late_upsert(tracking, found)
    if refresh is not None:
        refresh(found)
        merged = late.mark_processed(merged, as_of)
    storage.replace_days(merged, days, path, spec, warehouse.work("late_merged", as_of))
    return storage.read_table(spark, path, spec), late.late_metrics(found, as_of, table_name)


def run_gold(
    spark: SparkSession, warehouse: Warehouse, tables: Mapping[str, DataFrame], days: Sequence[date | None], as_of: datetime | str
) -> DataFrame:
    """The daily mart after recomputing the given sale days from the deduplicated tables; all
    other days stay as they are."""
    spec, path = schemas.DAILY_SALES, warehouse.mart(schemas.DAILY_SALES.name)
    facts = storage.on_days(marts.sales_fact(tables[schemas.POS.name], tables[schemas.ECOM.name]), spec, days)
    storage.replace_days(marts.daily_store_sales(facts), days, path, spec, warehouse.work("daily_sales", as_of))
    return storage.read_table(spark, path, spec)


def run_hourly_ecom(spark: SparkSession, warehouse: Warehouse, prefix: str, as_of: datetime | str) -> DataFrame:
    """One hour's orders: the hour's files are loaded and deduplicated into the table, and
    the hour is recorded. An hour without files is recorded as empty."""
    spec, pattern = schemas.ECOM, landing.hourly_pattern(prefix, as_of)
    try:
        read_feed(spark, spec, pattern)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        record = monitoring.run_record(spark.range(1), "hourly_ecommerce", as_of, records_processed=F.lit(0))
        write_run_record(warehouse, record, as_of, "hourly_ecommerce")
        return record
    load = warehouse.load(spec.name, as_of)
    run_batch(spark, spec, pattern, load, warehouse.dead_letters(spec.name, as_of), as_of, warehouse.work("hourly", as_of))
    run_dedup(spark, warehouse, spec, as_of)
    loaded = storage.read_table(spark, load, spec)
    record = monitoring.hourly_run_record(loaded, "hourly_ecommerce", as_of)
    write_run_record(warehouse, record, as_of, "hourly_ecommerce")
    return record


def run_monitoring(
    spark: SparkSession,
    warehouse: Warehouse,
    as_of: datetime | str,
    hours: int = 1,
    specs: Sequence[TableSpec] = (schemas.POS, schemas.ECOM),
) -> dict[str, DataFrame]:
    """The monitoring run over stored tables (sales among them): freshness, duplicate and error
    checks, and its own report row, which is added to the log. What came in twice before dedup, in
    the last hours and the last week, is estimated from the loads' key sketches alone.

    The checks look back over ingestion times, which reach the scan as a filter that leaves
    out row groups by their statistics. Freshness reads that column alone, a few bytes a load
    as all rows of a load share its time.
    """
    tables = {spec.name: storage.read_table(spark, warehouse.table(spec.name), spec) for spec in specs}
    pos = tables[schemas.POS.name]
    runs = read_runs(spark, warehouse)
    report = monitoring.monitoring_report(runs, pos, as_of)
    out = {
        "freshness": monitoring.freshness(tables, as_of),
        "duplicate_check": monitoring.value_check(
            monitoring.recent_duplicates(pos, as_of, hours), "duplicate_count", 100, 0.1
        ),
        "error_check": monitoring.value_check(monitoring.recent_failures(runs, as_of, hours), "total_failures", 1000, 0.1),
        "report": report,
    }
    sketched = warehouse.sketches(schemas.POS.name)
    if storage.exists(spark, sketched):
        sketches = spark.read.parquet(sketched)
        for name, back in (("delivered_twice", hours), ("delivered_twice_in_a_week", 7 * 24)):
            out[name] = monitoring.estimated_duplicates(sketches, as_of, back)
    write_run_record(warehouse, report, as_of, "monitoring_report")
    return out


def run_maintenance(
    spark: SparkSession, warehouse: Warehouse, spec: TableSpec, as_of: datetime | str, target_bytes: int = 256 << 20
) -> DataFrame:
    """Ages and compacts a table. Days past its retention leave the deduplicated table (of stock,
    which has none, the raw loads) for the archive; the raw loads and the streamed rows of
    such days are dropped; days of many small files are rewritten. Returns what was done:
    table_name, action, partition_date, amount (rows, or files before). A repeat finds nothing."""
    raw, table, streamed = warehouse.bronze(spec.name), warehouse.table(spec.name), warehouse.stream(spec.name)
    kept_in = table if spec.warehouse_keys else raw
    staged = warehouse.work(f"{spec.name}_expired", as_of)
    parts = {"archived": kept_in}
    parts |= {"raw_dropped": raw} if spec.warehouse_keys else {}
    parts |= {"stream_dropped": streamed}
    parts = {action: path for action, path in parts.items() if storage.exists(spark, path)}
    if not parts:
        return spark.createDataFrame([], "table_name string, action string, partition_date date, amount long")
    counted = [
        storage.expired_partitions(storage.read_table(spark, path, spec), spec, as_of)
        .select("table_name", F.lit(action).alias("action"), "partition_date", F.col("row_count").alias("amount"))
        for action, path in parts.items()
    ]
    reduce(DataFrame.unionByName, counted).write.mode("overwrite").parquet(staged)
    if "archived" in parts:
        storage.archive(storage.read_table(spark, kept_in, spec), warehouse.archive(spec.name), spec, as_of)
    for action, path in parts.items():
        old = storage.expired(storage.read_table(spark, path, spec), spec, as_of)
        days = [(spec.partition_column, d) for d in storage.day_list(storage.days_of(old, spec))]
        for load in _loads(spark, path) if path == raw else [""]:
            storage.drop_partitions(spark, path, days, load)
    done = spark.read.parquet(staged)
    if spec.warehouse_keys and "archived" in parts:
        rewritten = storage.compact_days(spark, table, spec, warehouse.work(f"{spec.name}_compact", as_of), target_bytes)
        done = done.unionByName(
            rewritten.select(
                F.lit(spec.name).alias("table_name"), F.lit("compacted").alias("action"), F.col("day").alias("partition_date"),
                F.col("file_count").alias("amount"),
            )
        )
    if storage.exists(spark, warehouse.key_days(spec.name)):
        compact_key_days(spark, warehouse.key_days(spec.name), warehouse.work(f"{spec.name}_keys", as_of))
    return done


def _loads(spark: SparkSession, raw: str) -> list[str]:
    """The load folders of a raw table, one a run."""
    root = spark._jvm.org.apache.hadoop.fs.Path(raw)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    return [f.getPath().getName() for f in listed if f.isDirectory()]


def write_run_record(warehouse: Warehouse, record: DataFrame, as_of: datetime | str, step: str) -> None:
    """Adds a row to the monitoring table; a repeated step replaces its own row."""
    record.write.mode("overwrite").parquet(warehouse.log("pipeline_monitoring", as_of, step))


def read_runs(spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    return spark.read.parquet(f"{warehouse.root}/log/pipeline_monitoring").select(
        *[f.name for f in schemas.PIPELINE_MONITORING.fields]
    )


def run_daily(
    spark: SparkSession,
    root: str,
    inputs: Mapping[str, str],
    as_of: datetime | str,
    previous: datetime | str | None = None,
    lookback_days: int = 7,
) -> dict[str, DataFrame]:
    """The daily chain: loads, dedup, customer history, late data with the sales mart,
    quality, health.

    ``inputs`` maps table names to input patterns; ``previous`` is the last run. Sales that
    were streamed into the warehouse since then take part like the file load.
    """
    warehouse = Warehouse(root.rstrip("/"))
    for name, pattern in inputs.items():
        record = run_batch(
            spark, schemas.TABLES[name], pattern, warehouse.load(name, as_of),
            warehouse.dead_letters(name, as_of), as_of, warehouse.work(f"{name}_parsed", as_of),
        )
        write_run_record(warehouse, record, as_of, f"{name}_batch")

    # what was streamed since the last run joins the file load
    since = previous or FIRST
    tables = {
        spec.name: run_dedup(spark, warehouse, spec, as_of, streamed_since=since if spec is schemas.POS else None)
        for spec in (schemas.POS, schemas.ECOM, schemas.CRM)
    }
    tables[schemas.INVENTORY.name] = read_bronze(spark, warehouse, schemas.INVENTORY)

    oldest = F.lit((instant(as_of) - timedelta(days=scd2.LOOKBACK_DAYS)).date())
    recent_crm = tables[schemas.CRM.name].where(F.col(schemas.CRM.partition_column) >= oldest)
    dim, record = run_scd2(spark, warehouse, recent_crm, as_of, previous)
    write_run_record(warehouse, record, as_of, scd2.PIPELINE)

    def refresh(found: DataFrame) -> None:
        """The sale days of late records, and all days that dedup has redone."""
        sales = found.where(F.col("table_name").isin(schemas.POS.name, schemas.ECOM.name))
        touched = sales.select(F.to_date("event_timestamp").alias("day"))
        for spec in (schemas.POS, schemas.ECOM):
            redone = spark.read.schema("day date").parquet(warehouse.work(f"{spec.name}_days", as_of))
            touched = touched.unionByName(redone)
        run_gold(spark, warehouse, tables, storage.day_list(touched), as_of)

    looked_at = {spec.name: tables[spec.name] for spec in late.TRACKED}
    tracking, record = run_late(spark, warehouse, looked_at, as_of, lookback_days=lookback_days, refresh=refresh)
    write_run_record(warehouse, record, as_of, late.PIPELINE)

    runs = read_runs(spark, warehouse)
    return {
        **tables,
        "customer_dim_scd2": dim,
        "late_arriving_data": tracking,
        schemas.DAILY_SALES.name: storage.read_table(
            spark, warehouse.mart(schemas.DAILY_SALES.name), schemas.DAILY_SALES
        ),
        "dq_scorecard": quality.dq_scorecard(tables, as_of),
        "pipeline_monitoring": runs,
        "failed_runs": monitoring.failed_runs_by_day(runs, as_of),
    }
