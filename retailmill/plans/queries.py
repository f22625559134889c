"""The query registry: every operator run over whole tables of the star schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill import schemas
from retailmill.functions.hashing import record_hash
from retailmill.functions.parsing import unfit
from retailmill.operators import dedup, drift, late, monitoring, quality, scd2
from retailmill.plans import analytics, marts, procedures
from retailmill.session import pin_utc, scratch_dir
from retailmill.sources import feeds, landing, star, storage
from retailmill.streaming import pos as stream

YEAR = 1997
POS_NOW = "2024-01-31 00:00:00"
RUN_1 = "2025-10-20 20:00:00"
RUN_2 = "2025-10-21 20:00:00"
LATE_NOW = "2025-11-01 00:00:00"
ALL_DAYS = 20_000
RETENTION_NOW = "2000-01-01 00:00:00"
ARCHIVE_NOW = "2025-01-15 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: ISO text for dates and times, double for decimals."""

    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.BooleanType)):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            return c.cast("bigint").alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(pin_utc(spark), sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- sales analytics ---------------------------------------------------------


@query
def top_products(spark, sf_dir):
    return analytics.top_products(star.transactions(spark, sf_dir, with_customer=False), YEAR)


@query
def mom_growth(spark, sf_dir):
    growth = analytics.monthly_growth(star.transactions(spark, sf_dir, with_customer=False), YEAR)
    return growth.withColumn("mom_pct_growth", F.round("mom_pct_growth", 6))


@query
def gold_customers(spark, sf_dir):
    return analytics.active_tier_customers(
        star.transactions(spark, sf_dir), star.customer_profiles(spark, sf_dir)
    )


@query
def latest_transactions(spark, sf_dir):
    return analytics.latest_transactions(star.transactions(spark, sf_dir))


@query
def customer_lifetime_value(spark, sf_dir):
    latest = analytics.latest_transactions(star.transactions(spark, sf_dir))
    return analytics.customer_lifetime_value(star.customer_profiles(spark, sf_dir), latest)


# --- feeds -------------------------------------------------------------------


def _land_json(spark, lines: DataFrame, purpose: str) -> str:
    path = scratch_dir(spark, purpose)
    lines.select("value").write.text(path)
    return path


def _land_csv(spark, lines: DataFrame, header: str, purpose: str) -> str:
    path = scratch_dir(spark, purpose)
    raw = {"header": "true", "sep": "\u0001", "quote": "", "emptyValue": ""}
    lines.select(F.col("value").alias(header)).write.options(**raw).csv(path)
    return path


def _parsed_pos(spark, sf_dir):
    path = _land_json(spark, star.pos_lines(spark, sf_dir), "pos")
    return feeds.parse_pos(landing.read_json_lines(spark, path), POS_NOW)


def _parsed_crm(spark, sf_dir):
    path = _land_csv(spark, star.crm_lines(spark, sf_dir), star.CRM_HEADER, "crm")
    return feeds.parse_crm(landing.read_csv_lines(spark, path), RUN_2)


@query
def parse_pos_json(spark, sf_dir):
    return feeds.good_rows(_parsed_pos(spark, sf_dir)).select(
        "transaction_id", "store_id", "customer_id", "amount", "currency", "event_ts", "event_date",
        "ingestion_ts", "record_hash", "dq_status", "dq_errors",
    )


@query
def parse_ecom_json(spark, sf_dir):
    path = _land_json(spark, star.ecom_lines(spark, sf_dir), "ecom")
    return feeds.good_rows(feeds.parse_ecom(landing.read_json_lines(spark, path), RUN_1)).select(
        "order_id", "customer_id", "store_id", "total_amount", "payment_type", "order_ts", "order_date",
        "record_hash", "dq_status",
    )


@query
def parse_crm_csv(spark, sf_dir):
    return feeds.good_rows(_parsed_crm(spark, sf_dir)).select(
        "customer_id", "first_name", "last_name", "email", "loyalty_status", "city", "country",
        "membership_tier", "updated_at", "record_hash", "dq_status",
    )


@query
def parse_inventory_csv(spark, sf_dir):
    path = _land_csv(spark, star.inventory_lines(spark, sf_dir), star.INVENTORY_HEADER, "inventory")
    rows = feeds.good_rows(feeds.parse_inventory(landing.read_csv_lines(spark, path), RUN_1))
    return rows.select(
        "product_id", "store_id", "product_name", F.col("quantity").cast("double").alias("quantity"),
        "price", "last_updated", "record_hash", "dq_status",
    )


@query
def dead_letter_pos(spark, sf_dir):
    dead = feeds.dead_letters(_parsed_pos(spark, sf_dir))
    return dead.select(
        "error", F.length("line").cast("bigint").alias("line_length"), F.md5("line").alias("line_md5"),
        F.col("source_file").isNotNull().alias("has_file"),
    )


@query
def dead_letter_summary(spark, sf_dir):
    """Rejected lines by file: each delivery lands in a folder of its own."""
    path, lines = scratch_dir(spark, "pos-files"), star.pos_lines(spark, sf_dir)
    for delivery in (1, 2):
        lines.where(F.col("delivery") == delivery).select("value").write.text(f"{path}/delivery_{delivery}")
    parsed = feeds.parse_pos(landing.read_json_lines(spark, f"{path}/*"), POS_NOW)
    folder = F.element_at(F.split("source_file", "/"), -2)
    return quality.dead_letter_summary(feeds.dead_letters(parsed).withColumn("source_file", folder))


@query
def ingest_hard_lines(spark, sf_dir):
    """Lines that are easily lost: text after the first object, blank lines, numbers that
    JSON does not have, amounts too large for money."""
    lines = star.pos_lines(spark, sf_dir).select("value")

    def amount(token: str):
        return F.regexp_replace("value", '"amount":("[^"]*"|[^,]*)', f'"amount":{token}')

    hard = F.array(
        F.concat_ws(" ", "value", "value"), F.concat_ws(",", "value", "value"), F.concat("value", F.lit("]{}")),
        F.lit(""), amount("NaN"), amount("Infinity"), amount("1e17"),
    )
    path = _land_json(spark, lines.select(F.explode(hard).alias("value")), "hard-lines")
    parsed = feeds.parse_pos(landing.read_json_lines(spark, path), POS_NOW)
    value = F.col("amount")
    kind = (
        F.when(value.isNull(), "none").when(F.isnan(value), "nan").when(value == float("inf"), "infinite")
        .when(unfit(value), "unfit").otherwise("money")
    )
    rejected = F.col(feeds.ERROR).isNotNull()
    return parsed.groupBy("dq_status", rejected.alias("rejected"), kind.alias("amount_kind")).agg(
        F.count("*").alias("line_count")
    )


@query
def ingest_hard_csv(spark, sf_dir):
    """A blank line, a control character and a repeated header for each customer line, in files
    that begin with a header."""
    lines = star.crm_lines(spark, sf_dir)
    marked = F.regexp_replace("value", "^([^,]*),", "$1,\u0001")
    hard = lines.select(F.pmod(F.xxhash64("value"), F.lit(4)).alias("part"), F.explode(F.array(marked, F.lit(""), F.lit(star.CRM_HEADER))).alias("value"))
    header = hard.select("part").distinct().select("part", F.lit(0).alias("place"), F.lit(star.CRM_HEADER).alias("value"))
    path = scratch_dir(spark, "hard-csv")
    (
        header.unionByName(hard.withColumn("place", F.lit(1))).repartition("part").sortWithinPartitions("part", "place")
        .select("part", "value").write.partitionBy("part").text(path)
    )
    parsed = feeds.parse_crm(landing.read_csv_lines(spark, path), RUN_2)
    return parsed.groupBy(
        F.coalesce(feeds.ERROR, F.lit("none")).alias("reason"),
        F.coalesce(F.col("first_name").startswith("\u0001"), F.lit(False)).alias("marked"),
        (F.length("raw_payload") > 0).alias("has_text"),
    ).agg(F.count("*").alias("line_count"))


def _crm_by_name(spark, sf_dir):
    """The exports in three folders: as declared, with another name for the city, and with the
    columns turned round and one more."""
    path, lines = scratch_dir(spark, "crm-by-name"), star.crm_lines(spark, sf_dir)
    nine = lines.where("delivery != 2 OR value NOT LIKE 'B%'")
    names = star.CRM_HEADER.split(",")
    turned = F.concat_ws(",", F.element_at(F.split("value", ","), -1), F.lit("x,y"), "value")
    headers = {1: star.CRM_HEADER, 2: star.CRM_HEADER.replace("city", "town"), 3: ",".join(["updated_at", "phone", "updated_at", *names])}
    for delivery, header in headers.items():
        value = turned if delivery == 3 else F.col("value")
        part = nine.where(F.col("delivery") == delivery).select(value.alias(header))
        part.write.options(header="true", sep="\u0001", quote="", emptyValue="").csv(f"{path}/delivery_{delivery}")
    return landing.read_csv(spark, f"{path}/*")


@query
def parse_crm_by_header(spark, sf_dir):
    """Customers from files whose headers are not the declared ones: columns go by name, and
    what is not declared goes into the extra attributes."""
    rows = feeds.good_rows(feeds.parse_crm(_crm_by_name(spark, sf_dir)[0], RUN_2))
    return rows.select(
        "customer_id", "last_name", "email", "city", "country", "membership_tier", "updated_at", "raw_extra_attributes"
    )


@query
def csv_header_drift(spark, sf_dir):
    """What the headers of these files add and lack; a file counts once, so counts are made plain."""
    found = drift.header_drift(_crm_by_name(spark, sf_dir)[1], schemas.CSV_HEADERS[:2])
    return found.withColumn("file_count", (F.col("file_count") > 0).cast("int"))


@query
def contract_types(spark, sf_dir):
    """Typed fields of the sales feed whose text does not fit."""
    return feeds.misfits(_parsed_pos(spark, sf_dir))


@query
def contract_at_load(spark, sf_dir):
    """A strict load: lines of a wrong type are set aside with the reason, and the run reports
    counts by field and rule."""
    warehouse, spec = procedures.Warehouse(scratch_dir(spark, "strict-load")), schemas.POS
    path = _land_json(spark, star.pos_lines(spark, sf_dir), "strict-in")
    dead = warehouse.dead_letters(spec.name, POS_NOW)
    record = procedures.run_batch(spark, spec, path, warehouse.load(spec.name, POS_NOW), dead, POS_NOW, strict=True)
    reasons = spark.read.parquet(dead).groupBy(F.col("error").alias("what")).agg(F.count("*").alias("line_count"))
    counted = F.from_json("metadata", "null_transaction_id long, type_amount long, type_event_ts long")
    report = record.select(counted.alias("m")).select("m.*")
    return reasons.unionByName(report.unpivot([], report.columns, "what", "line_count"))


@query
def ingest_outcome(spark, sf_dir):
    return _parsed_pos(spark, sf_dir).groupBy("dq_status", "dq_errors").agg(
        F.count("*").alias("line_count"), F.count(feeds.ERROR).alias("rejected")
    )


# --- dedup -------------------------------------------------------------------


@query
def record_hashes(spark, sf_dir):
    rows = star.raw_pos(spark, sf_dir).drop("record_hash")
    return rows.select("transaction_id", record_hash(rows, schemas.POS.hash_keys).alias("record_hash")).distinct()


_POS_COLUMNS = ("transaction_id", "store_id", "customer_id", "amount", "event_ts", "ingestion_ts", "source_file")


@query
def dedup_pos_batch(spark, sf_dir):
    return dedup.dedup_batch(star.raw_pos(spark, sf_dir), schemas.POS).select(*_POS_COLUMNS)


@query
def dedup_ecom_batch(spark, sf_dir):
    return dedup.dedup_batch(star.raw_ecom(spark, sf_dir), schemas.ECOM).select(
        "order_id", "total_amount", "order_ts", "ingestion_ts", "source_file"
    )


@query
def dedup_crm_batch(spark, sf_dir):
    return dedup.dedup_batch(star.raw_crm(spark, sf_dir), schemas.CRM).select(
        "customer_id", "loyalty_status", "membership_tier", "updated_at", "ingestion_ts", "source_file"
    )


@query
def dedup_inventory_batch(spark, sf_dir):
    return dedup.dedup_batch(star.raw_inventory(spark, sf_dir), schemas.INVENTORY).select(
        "product_id", "store_id", F.col("quantity").cast("double").alias("quantity"), "price",
        "last_updated", "ingestion_ts",
    )


@query
def dedup_keep_first(spark, sf_dir):
    rows = dedup.dedup_by_hash(star.raw_pos(spark, sf_dir), schemas.POS.hash_keys, keep="first")
    return rows.select(*_POS_COLUMNS)


@query
def dedup_pos_table(spark, sf_dir):
    return dedup.dedup_table(star.raw_pos(spark, sf_dir), schemas.POS).select(*_POS_COLUMNS)


@query
def dedup_pos_log(spark, sf_dir):
    return dedup.duplicate_log(star.raw_pos(spark, sf_dir), schemas.POS)


@query
def dedup_ecom_table(spark, sf_dir):
    return dedup.dedup_table(star.raw_ecom(spark, sf_dir), schemas.ECOM).select(
        "order_id", "total_amount", "order_ts", "ingestion_ts", "source_file"
    )


@query
def dedup_ecom_log(spark, sf_dir):
    return dedup.duplicate_log(star.raw_ecom(spark, sf_dir), schemas.ECOM)


@query
def dedup_crm_table(spark, sf_dir):
    return dedup.dedup_table(star.raw_crm(spark, sf_dir), schemas.CRM).select(
        "customer_id", "loyalty_status", "updated_at", "ingestion_ts", "source_file"
    )


@query
def dedup_pos_incremental(spark, sf_dir):
    """Two loads one after the other; the second redoes only the days it touches."""
    return _two_loads(spark, star.raw_pos(spark, sf_dir), schemas.POS, "incremental-dedup").select(*_POS_COLUMNS)


def _two_loads(spark, rows, spec, purpose):
    warehouse = procedures.Warehouse(scratch_dir(spark, purpose))
    for as_of, delivery in ((RUN_1, "delivery_1"), (RUN_2, "delivery_2")):
        load = rows.where(F.col("source_file") == delivery)
        storage.write_table(load, warehouse.load(spec.name, as_of), spec, mode="replace")
        table = procedures.run_dedup(spark, warehouse, spec, as_of)
    return table


@query
def dedup_ecom_incremental(spark, sf_dir):
    """The same for orders, whose ids hold no time: the key table names the days to look at."""
    table = _two_loads(spark, star.raw_ecom(spark, sf_dir), schemas.ECOM, "incremental-orders")
    return table.select("order_id", "total_amount", "order_ts", "ingestion_ts", "source_file")


@query
def dedup_incremental_rerun(spark, sf_dir):
    """The second load first arrives with wrong times, on other days, and is run again when put right."""
    warehouse, spec = procedures.Warehouse(scratch_dir(spark, "rerun-dedup")), schemas.POS
    pos, table = star.raw_pos(spark, sf_dir), None
    second = pos.where(F.col("source_file") == "delivery_2")
    moved = second.withColumns(
        {"event_ts": F.col("event_ts") + F.expr("INTERVAL 3 DAYS"), "event_date": F.date_add("event_date", 3)}
    )
    loads = ((RUN_1, pos.where(F.col("source_file") == "delivery_1")), (RUN_2, moved), (RUN_2, second))
    for as_of, load in loads:
        storage.write_table(load, warehouse.load(spec.name, as_of), spec, mode="replace")
        table = procedures.run_dedup(spark, warehouse, spec, as_of)
    return table.select(*_POS_COLUMNS)


@query
def registered_keys(spark, sf_dir):
    """Rows and distinct registered keys of every raw table."""
    parts = []
    for name, table in star.raw_tables(spark, sf_dir).items():
        keys = schemas.deduplication_keys(name)
        parts.append(table.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.count_distinct(F.struct(*keys)).alias("key_count")
        ))
    return reduce(DataFrame.unionByName, parts)


@query
def dedup_reference_delete(spark, sf_dir):
    rows = dedup.dedup_table(star.raw_pos(spark, sf_dir), schemas.POS, mode="reference_delete")
    return rows.select(*_POS_COLUMNS)


# --- customer history --------------------------------------------------------


def _crm_until(spark, sf_dir, as_of):
    return star.raw_crm(spark, sf_dir).where(F.col("ingestion_ts") <= F.lit(as_of).cast("timestamp"))


def _dim_after_run_1(spark, sf_dir):
    snapshot = scd2.source_snapshot(_crm_until(spark, sf_dir, RUN_1), RUN_1)
    return scd2.upsert(scd2.empty_dim(spark), snapshot, RUN_1).table


def _run_2(spark, sf_dir):
    """Two runs against stored tables: (dimension, monitoring row)."""
    warehouse = procedures.Warehouse(scratch_dir(spark, "customer-dim"))
    procedures.run_scd2(spark, warehouse, _crm_until(spark, sf_dir, RUN_1), RUN_1)
    return procedures.run_scd2(spark, warehouse, _crm_until(spark, sf_dir, RUN_2), RUN_2, previous=RUN_1)


@query
def scd2_source(spark, sf_dir):
    return scd2.source_snapshot(star.raw_crm(spark, sf_dir), RUN_2)


@query
def scd2_initial(spark, sf_dir):
    return _dim_after_run_1(spark, sf_dir)


@query
def scd2_after_change(spark, sf_dir):
    return _run_2(spark, sf_dir)[0]


@query
def scd2_metrics(spark, sf_dir):
    return _run_2(spark, sf_dir)[1].drop("error_message")


# --- late data ---------------------------------------------------------------


def _late(spark, sf_dir):
    return late.late_records(star.raw_tables(spark, sf_dir, *late.TRACKED), LATE_NOW, ALL_DAYS)


def _tracking(spark, sf_dir):
    empty = spark.createDataFrame([], schemas.LATE_ARRIVING)
    return late.late_upsert(empty, _late(spark, sf_dir))


@query
def late_records(spark, sf_dir):
    return _late(spark, sf_dir)


@query
def late_records_one_table(spark, sf_dir):
    pos = {schemas.POS.name: star.raw_pos(spark, sf_dir)}
    return late.late_records(pos, POS_NOW, 7, schemas.POS.name)


@query
def late_merge(spark, sf_dir):
    worked_in = late.mark_processed(_tracking(spark, sf_dir), LATE_NOW, schemas.ECOM.name)
    return late.late_upsert(worked_in, _late(spark, sf_dir))


@query
def late_metrics(spark, sf_dir):
    return late.late_metrics(_late(spark, sf_dir), LATE_NOW).drop("error_message")


@query
def late_backfill_sales(spark, sf_dir):
    sales = marts.sales_fact(star.raw_pos(spark, sf_dir), star.raw_ecom(spark, sf_dir))
    dates = late.pending_dates(_tracking(spark, sf_dir), schemas.ECOM.name)
    return marts.affected_daily_store_sales(sales, dates)


# --- schema drift ------------------------------------------------------------

_POS_CONTRACT = T.StructType(
    [
        T.StructField(name, T.DoubleType() if name == "amount" else T.StringType())
        for name in (
            "transaction_id", "store_id", "customer_id", "amount", "currency", "timestamp", "terminal_id",
        )
    ]
)


@query
def schema_drift(spark, sf_dir):
    return drift.feed_drift(star.pos_lines(spark, sf_dir), _POS_CONTRACT, payload="value")


@query
def feed_profile(spark, sf_dir):
    return drift.json_profile(star.pos_lines(spark, sf_dir), payload="value")


@query
def schema_merge(spark, sf_dir):
    crm = star.raw_crm(spark, sf_dir)
    first = crm.where(F.col("source_file") == "delivery_1").drop("membership_tier")
    later = crm.where(F.col("source_file") != "delivery_1")
    merged, updated = drift.handle_drift(first, later, auto_update=True)
    return merged.select("customer_id", "updated_at", "source_file", "membership_tier").withColumn(
        "schema_updated", F.lit(updated)
    )


@query
def crm_extra_attributes(spark, sf_dir):
    extended = star.load(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("region_code"),
        F.lit(None).cast("string").alias("referrer"),
    )
    return drift.normalize_crm(extended).select("customer_id", "last_name", "email", "raw_extra_attributes")


@query
def unfit_amounts(spark, sf_dir):
    """Amounts that cannot be money, here in units that make many too large."""
    pos = {"amount": F.col("amount") * 1e13, "total_amount": F.col("total_amount") * 1e11}
    tables = star.raw_tables(spark, sf_dir, schemas.POS, schemas.ECOM)
    return quality.unfit_amounts(
        {schemas.POS.name: pos["amount"], schemas.ECOM.name: pos["total_amount"]}, tables
    )


@query
def contract_violations(spark, sf_dir):
    return quality.contract_violations(star.pos_rows(spark, sf_dir), schemas.RAW_POS)


# --- quality and monitoring --------------------------------------------------


def _unfiltered(spark, sf_dir):
    others = star.raw_tables(spark, sf_dir, schemas.ECOM, schemas.CRM, schemas.INVENTORY)
    return {schemas.POS.name: star.pos_rows(spark, sf_dir), **others}


@query
def dq_scorecard(spark, sf_dir):
    return quality.dq_scorecard(_unfiltered(spark, sf_dir), "2001-06-30 00:00:00")


@query
def dq_metrics(spark, sf_dir):
    rows = monitoring.data_quality_metrics(_unfiltered(spark, sf_dir), LATE_NOW, days=ALL_DAYS)
    return rows.withColumn("avg_arrival_delay_hours", F.round("avg_arrival_delay_hours", 6))


@query
def execution_summary(spark, sf_dir):
    rows = monitoring.execution_summary(star.pipeline_runs(spark, sf_dir), POS_NOW)
    return rows.withColumns(
        {c: F.round(c, 6) for c in ("avg_records_processed", "avg_execution_time_seconds")}
    )


@query
def late_summary(spark, sf_dir):
    tracking = late.mark_processed(_tracking(spark, sf_dir), LATE_NOW, schemas.ECOM.name)
    rows = monitoring.late_summary(tracking, LATE_NOW, days=ALL_DAYS)
    return rows.withColumn("avg_delay_seconds", F.round("avg_delay_seconds", 6))


@query
def failed_runs_7d(spark, sf_dir):
    return monitoring.failed_runs_by_day(star.pipeline_runs(spark, sf_dir), POS_NOW)


@query
def failed_runs_1h(spark, sf_dir):
    return monitoring.failed_runs_recent(star.pipeline_runs(spark, sf_dir), POS_NOW)


@query
def freshness(spark, sf_dir):
    return monitoring.freshness(star.raw_tables(spark, sf_dir, schemas.POS, schemas.ECOM), POS_NOW)


@query
def duplicate_check(spark, sf_dir):
    observed = monitoring.recent_duplicates(star.raw_pos(spark, sf_dir), POS_NOW)
    return monitoring.value_check(observed, "duplicate_count", 100, 0.1)


@query
def duplicate_check_upper(spark, sf_dir):
    observed = monitoring.recent_duplicates(star.raw_pos(spark, sf_dir), POS_NOW, hours=24)
    return monitoring.value_check(observed, "duplicate_count", 100, 0.1, upper_bound_only=True)


@query
def duplicate_sketches(spark, sf_dir):
    """Distinct ids of sales and orders by merged hourly sketches, against the exact count."""
    parts = []
    for spec in (schemas.POS, schemas.ECOM):
        rows, key = star.raw_tables(spark, sf_dir, spec)[spec.name], spec.required[0]
        path = scratch_dir(spark, "sketches")
        monitoring.key_sketches(rows, key).write.parquet(path)
        estimated = monitoring.estimated_duplicates(spark.read.parquet(path), LATE_NOW, 24 * ALL_DAYS)
        both = estimated.select("row_count", "duplicate_count", F.lit(None).cast("long").alias("ids")).unionByName(
            rows.agg(F.count_distinct(key).alias("ids")).select(
                F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("long").alias("duplicate_count"), "ids"
            )
        )
        found = both.agg(*[F.max(c).alias(c) for c in both.columns])
        close = F.abs(F.col("row_count") - F.col("duplicate_count") - F.col("ids")) <= 0.03 * F.col("ids")
        parts.append(found.select(F.lit(spec.name).alias("table_name"), "row_count", "ids", close.alias("close")))
    return reduce(DataFrame.unionByName, parts)


@query
def error_check(spark, sf_dir):
    observed = monitoring.recent_failures(star.pipeline_runs(spark, sf_dir), POS_NOW, hours=24)
    return monitoring.value_check(observed, "total_failures", 1000, 0.1)


@query
def monitoring_report(spark, sf_dir):
    runs, pos = star.pipeline_runs(spark, sf_dir), star.raw_pos(spark, sf_dir)
    return monitoring.monitoring_report(runs, pos, POS_NOW).drop("error_message")


@query
def monitoring_run(spark, sf_dir):
    """A monitoring run over stored sales and orders and the stored run log: all four outputs."""
    warehouse = procedures.Warehouse(scratch_dir(spark, "monitoring"))
    for spec, rows in ((schemas.POS, star.raw_pos(spark, sf_dir)), (schemas.ECOM, star.raw_ecom(spark, sf_dir))):
        storage.write_table(dedup.dedup_table(rows, spec), warehouse.table(spec.name), spec)
    procedures.write_run_record(warehouse, star.pipeline_runs(spark, sf_dir), POS_NOW, "runs")
    out = procedures.run_monitoring(spark, warehouse, POS_NOW)

    def rows_of(name, subject, number, flag, detail):
        return comparable(out[name]).select(
            F.lit(name).alias("output"), subject.alias("subject"), number.cast("bigint").alias("number"),
            flag.alias("flag"), detail.alias("detail"),
        )

    none, c = F.lit(None).cast("string"), F.col
    parts = (
        rows_of("freshness", c("table_name"), c("minutes_since_last_ingestion"), c("is_stale"), c("latest_ingestion")),
        rows_of("duplicate_check", F.lit(schemas.POS.name), c("duplicate_count"), c("passed"), none),
        rows_of("error_check", F.lit("pipeline_monitoring"), c("total_failures"), c("passed"), none),
        rows_of("report", c("pipeline_name"), c("records_processed"), c("status"), c("metadata")),
    )
    return reduce(DataFrame.unionByName, parts)


@query
def hourly_ecom(spark, sf_dir):
    """Two hours of order files, loaded hour by hour; a third has no files."""
    warehouse = procedures.Warehouse(scratch_dir(spark, "hourly"))
    fields = "order_id string, customer_id string, store_id string, total_amount double, payment_type string, timestamp string"
    lines = star.ecom_lines(spark, sf_dir)
    for hour in (20, 21, 22):
        if hour < 22:
            rows = lines.where(F.col("delivery") == hour - 19).select(F.from_json("value", fields).alias("j")).select("j.*")
            rows.write.json(f"{warehouse.root}/landing/hourly/2025-10-20/{hour}")
        procedures.run_hourly_ecom(spark, warehouse, f"{warehouse.root}/landing", f"2025-10-20 {hour}:00:00")
    table = storage.read_table(spark, warehouse.table(schemas.ECOM.name), schemas.ECOM)
    return table.select("order_id", "total_amount", "order_date", "record_hash")


@query
def recent_rows(spark, sf_dir):
    return monitoring.recent_rows(star.raw_pos(spark, sf_dir), POS_NOW)


@query
def stream_liveness(spark, sf_dir):
    return monitoring.stream_liveness(star.raw_pos(spark, sf_dir), POS_NOW)


@query
def hourly_metric(spark, sf_dir):
    ecom = star.raw_ecom(spark, sf_dir)
    return monitoring.hourly_run_record(ecom, "hourly_ecommerce", "1998-08-02 13:00:00").drop(
        "error_message", "metadata"
    )


# --- marts -------------------------------------------------------------------


def _sales(spark, sf_dir):
    return marts.deduplicated_sales_fact(star.raw_pos(spark, sf_dir), star.raw_ecom(spark, sf_dir))


@query
def sales_fact(spark, sf_dir):
    return _sales(spark, sf_dir)


@query
def inventory_fact(spark, sf_dir):
    rows = marts.inventory_snapshot_fact(star.raw_inventory(spark, sf_dir))
    return rows.withColumn("quantity", F.col("quantity").cast("double"))


@query
def store_dim(spark, sf_dir):
    sales = marts.sales_fact(star.raw_pos(spark, sf_dir), star.raw_ecom(spark, sf_dir))
    return marts.store_dim(sales, star.raw_inventory(spark, sf_dir))


@query
def product_dim(spark, sf_dir):
    return marts.product_dim(star.raw_inventory(spark, sf_dir))


@query
def date_dim(spark, sf_dir):
    sales = marts.sales_fact(star.raw_pos(spark, sf_dir), star.raw_ecom(spark, sf_dir))
    return marts.date_dim(sales, "sale_date")


@query
def daily_store_sales(spark, sf_dir):
    return marts.daily_store_sales(_sales(spark, sf_dir))


@query
def customer_360(spark, sf_dir):
    snapshot = scd2.source_snapshot(_crm_until(spark, sf_dir, RUN_2), RUN_2)
    dim = scd2.upsert(_dim_after_run_1(spark, sf_dir), snapshot, RUN_2).table
    return marts.customer_360(dim, _sales(spark, sf_dir))


@query
def inventory_kpi(spark, sf_dir):
    rows = marts.inventory_kpi(marts.inventory_snapshot_fact(star.raw_inventory(spark, sf_dir)))
    return rows.withColumn("stock_on_hand", F.col("stock_on_hand").cast("double"))


@query
def kpi_reconciliation(spark, sf_dir):
    """Raw deliveries against the deduplicated mart, per day: shows what dedup removed."""
    raw = marts.sales_fact(star.raw_pos(spark, sf_dir), star.raw_ecom(spark, sf_dir))
    mart = marts.daily_store_sales(_sales(spark, sf_dir)).withColumnRenamed("total_amount", "amount")
    return quality.reconcile(raw, mart, ["sale_date"], ["amount"])


@query
def materialized_daily_sales(spark, sf_dir):
    path = scratch_dir(spark, "daily-store-sales")
    marts.materialize_daily_store_sales(_sales(spark, sf_dir), path)
    return spark.read.parquet(path).drop("sale_month")


# --- streaming ---------------------------------------------------------------


def _streamed(spark, sf_dir, purpose):
    path = _land_json(spark, star.pos_lines(spark, sf_dir), purpose)
    return landing.stream_text_lines(spark, path)


@query
def stream_pos_bronze(spark, sf_dir):
    out = scratch_dir(spark, "stream-bronze")
    messages = _streamed(spark, sf_dir, "stream-in")
    stream.finish(stream.start_bronze(messages, f"{out}/rows", f"{out}/dead", f"{out}/ckpt", POS_NOW))
    return spark.read.parquet(f"{out}/rows").select(
        "transaction_id", "store_id", "customer_id", "amount", "event_ts", "event_date", "record_hash"
    )


@query
def stream_pos_dead_letter(spark, sf_dir):
    out = scratch_dir(spark, "stream-dead")
    messages = _streamed(spark, sf_dir, "stream-in")
    stream.finish(stream.start_bronze(messages, f"{out}/rows", f"{out}/dead", f"{out}/ckpt", POS_NOW))
    return spark.read.parquet(f"{out}/dead").groupBy("error").agg(F.count("*").alias("rejected"))


@query
def stream_windowed_sales(spark, sf_dir):
    out = scratch_dir(spark, "stream-windows")
    rows = feeds.good_rows(stream.parse_messages(_streamed(spark, sf_dir, "stream-in"), POS_NOW))
    stream.finish(stream.start_windowed_sales(stream.windowed_sales(rows), f"{out}/windows", f"{out}/ckpt"))
    return stream.read_windowed_sales(spark, f"{out}/windows")


@query
def stream_dedup(spark, sf_dir):
    out = scratch_dir(spark, "stream-dedup")
    rows = feeds.good_rows(stream.parse_messages(_streamed(spark, sf_dir, "stream-in"), POS_NOW))
    stream.start_append(stream.dedup_stream(rows), f"{out}/rows", f"{out}/ckpt").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("transaction_id", "event_ts", "amount")


@query
def stream_then_dedup(spark, sf_dir):
    """The table dedup run on what the stream has stored."""
    out = scratch_dir(spark, "stream-table")
    messages = _streamed(spark, sf_dir, "stream-in")
    stream.finish(stream.start_bronze(messages, f"{out}/rows", f"{out}/dead", f"{out}/ckpt", POS_NOW))
    stored = stream.read_bronze(spark, f"{out}/rows")
    return dedup.dedup_table(stored, schemas.POS).select("transaction_id", "event_ts", "amount", "record_hash")


@query
def dedup_stream_and_batch(spark, sf_dir):
    """Half of the messages come by file, half by stream; one dedup run takes in both."""
    warehouse, spec = procedures.Warehouse(scratch_dir(spark, "both-ways")), schemas.POS
    lines = star.pos_lines(spark, sf_dir)
    by_file = _land_json(spark, lines.where(F.col("delivery") == 1), "by-file")
    by_stream = _land_json(spark, lines.where(F.col("delivery") == 2), "by-stream")
    procedures.run_batch(
        spark, spec, by_file, warehouse.load(spec.name, POS_NOW), warehouse.dead_letters(spec.name, POS_NOW), POS_NOW
    )
    messages = landing.stream_text_lines(spark, by_stream)
    dead, progress = f"{warehouse.root}/stream/dead", f"{warehouse.root}/stream/progress"
    stream.finish(stream.start_bronze(messages, warehouse.stream(spec.name), dead, progress, POS_NOW))
    table = procedures.run_dedup(spark, warehouse, spec, POS_NOW, streamed_since=procedures.FIRST)
    return table.select("transaction_id", "event_ts", "amount", "record_hash")


@query
def incremental_files(spark, sf_dir):
    """Two deliveries land one after the other; the second run reads only the new files."""
    out = scratch_dir(spark, "incremental")
    lines = star.pos_lines(spark, sf_dir)
    for delivery in (1, 2):
        lines.where(F.col("delivery") == delivery).select("value").write.mode("append").text(f"{out}/landing")
        rows = landing.stream_text_lines(spark, f"{out}/landing")
        stream.ingest_new_files(rows.withColumn("run", F.lit(delivery)), f"{out}/rows", f"{out}/ckpt")
    return spark.read.parquet(f"{out}/rows").groupBy("run").agg(F.count("*").alias("line_count"))


# --- storage -----------------------------------------------------------------


@query
def partitioned_layout(spark, sf_dir):
    path = scratch_dir(spark, "layout")
    storage.write_table(star.raw_pos(spark, sf_dir), path, schemas.POS)
    table = storage.read_table(spark, path, schemas.POS)
    return table.groupBy("event_date").agg(
        F.count("*").alias("row_count"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("total_amount")
    )


@query
def retention_filter(spark, sf_dir):
    kept = storage.retained(star.raw_ecom(spark, sf_dir), schemas.ECOM, RETENTION_NOW)
    return kept.groupBy("order_date").agg(F.count("*").alias("row_count"))


@query
def expired_partitions(spark, sf_dir):
    return storage.expired_partitions(star.raw_ecom(spark, sf_dir), schemas.ECOM, RETENTION_NOW)


@query
def maintenance_run(spark, sf_dir):
    """Ageing of sales: days past retention leave the stored table for the archive, and the raw loads."""
    warehouse, spec = procedures.Warehouse(scratch_dir(spark, "maintenance")), schemas.POS
    storage.write_table(star.raw_pos(spark, sf_dir), warehouse.load(spec.name, POS_NOW), spec, mode="replace")
    procedures.run_dedup(spark, warehouse, spec, POS_NOW)
    procedures.run_maintenance(spark, warehouse, spec, ARCHIVE_NOW)
    places = {"raw": warehouse.bronze(spec.name), "kept": warehouse.table(spec.name), "archived": warehouse.archive(spec.name)}
    parts = [
        storage.read_table(spark, path, spec)
        .groupBy(F.lit(part).alias("part"), F.col("event_date").alias("day")).agg(F.count("*").alias("row_count"))
        for part, path in places.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def archive_split(spark, sf_dir):
    path = scratch_dir(spark, "archive")
    pos = star.raw_pos(spark, sf_dir)
    storage.archive(pos, path, schemas.POS, ARCHIVE_NOW)
    archived = spark.read.parquet(path).agg(F.count("*").alias("row_count")).withColumn("part", F.lit("archived"))
    kept = (
        storage.retained(pos, schemas.POS, ARCHIVE_NOW)
        .agg(F.count("*").alias("row_count"))
        .withColumn("part", F.lit("retained"))
    )
    return archived.unionByName(kept)


@query
def compaction_roundtrip(spark, sf_dir):
    base = scratch_dir(spark, "compaction")
    pos = star.raw_pos(spark, sf_dir)
    for delivery in ("delivery_1", "delivery_2"):
        storage.write_table(pos.where(F.col("source_file") == delivery), f"{base}/many", schemas.POS)
    storage.compact(spark, f"{base}/many", f"{base}/compacted", schemas.POS)
    table = storage.read_table(spark, f"{base}/compacted", schemas.POS)
    return table.select("transaction_id", "amount", "event_date", "ingestion_ts", "source_file")


@query
def compaction_run(spark, sf_dir):
    """Sales appended in six small loads; the days of many files are rewritten in place."""
    path, spec = scratch_dir(spark, "many-files"), schemas.POS
    pos = star.raw_pos(spark, sf_dir)
    for k in range(6):
        storage.write_table(pos.where(F.pmod(F.xxhash64("transaction_id"), F.lit(6)) == k), path, spec)
    storage.compact_days(spark, path, spec, f"{path}-staged", spare_files=1)
    rows = storage.read_table(spark, path, spec).groupBy(F.col("event_date").alias("day")).agg(
        F.count("*").alias("row_count"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("total_amount")
    )
    return rows.join(storage.file_sizes(spark, path, spec).drop("total_bytes"), "day")
