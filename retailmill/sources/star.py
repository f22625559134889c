"""Retail tables and feeds derived from a TPC-H-like star schema plus an event table.

The mapping is plain projections, so the same tables can be stated in SQL. It
plants the defects a feed has in practice: repeated deliveries, broken lines,
missing keys, unparsable numbers, local-time offsets, two file layouts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.hashing import record_hash

CRM_DAY_1 = "2025-10-20 08:00:00"
CRM_DAY_2 = "2025-10-21 08:00:00"


# The columns used here. Declared, so that opening a table needs no look at its files.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows that multiply and widen in what follows, dealt by key to all tasks: a file is
    cut at row groups only, so that a few tasks would do all of that. The number of parts is
    given, or adaptive execution would merge them by their size before they grow."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _id(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _hours(column: Column) -> Column:
    return F.make_dt_interval(hours=column)


def _minutes(column: Column) -> Column:
    return F.make_dt_interval(mins=column)


def _tier() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", "Gold")
        .when(segment == "AUTOMOBILE", "Silver")
        .when(segment == "HOUSEHOLD", "Platinum")
        .otherwise("Bronze")
    )


def transactions(spark: SparkSession, sf_dir: str, with_customer: bool = True) -> DataFrame:
    """Sales lines. Without ``with_customer`` the join to orders is left out."""
    lines = load(spark, sf_dir, "lineitem")
    if with_customer:
        orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        customer = _id("C", "o_custkey")
    else:
        customer = F.lit(None).cast("string")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    # open lines of undecided return status have no flag yet
    returned = F.when(F.col("l_returnflag") == "R", True).when(
        ~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")), False
    )
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        customer.alias("customer_id"),
        _id("P", "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (price * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)").alias("sale_amount"),
        F.to_date("l_shipdate").alias("sale_date"),
        returned.alias("is_return"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_timestamp"),
    )


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = load(spark, sf_dir, "customer")
    nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        _id("C", "c_custkey").alias("customer_id"),
        _tier().alias("loyalty_tier"),
        (F.col("c_acctbal") > 0).alias("is_active"),
        F.col("n_name").alias("country"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias(
            "registration_date"
        ),
    )


# --- point of sale -----------------------------------------------------------


def _pos_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per message: purchases are delivered twice."""
    events = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    times = F.when(F.col("event_type") == "purchase", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    failed = F.col("event_type") == "error"
    ts = F.col("ts")
    delay = F.when(F.col("delivery") == 1, F.col("k") * 2).otherwise(F.col("k") * 3)
    return (
        events.select(
            "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
            k.alias("k"), F.explode(times).alias("delivery"),
        )
        .select(
            "*",
            (failed & (F.col("k") < 10)).alias("broken"),
            F.when(~(failed & (F.col("k") >= 90)), _id("T", "event_id")).alias("transaction_id"),
            F.when(F.col("k") == 7, "").otherwise(F.concat(F.lit("S"), (F.col("k") % 20).cast("string"))).alias("store_id"),
            F.when(F.col("k") != 33, _id("C", "user_id")).alias("customer_id"),
            F.when(F.col("event_type") == "signup", -F.col("value")).otherwise(F.col("value")).alias("signed"),
            (F.col("k") % 20 >= 10).alias("western"),
            (ts + _minutes(delay)).alias("delivered_ts"),
        )
    )


def pos_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as JSON text, plus ``delivery``."""
    d = _pos_deliveries(spark, sf_dir)
    local = F.date_format(F.col("ts") - _hours(F.lit(5)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-05:00'")
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    def message(amount: Column) -> Column:
        return F.to_json(
            F.struct(
                "transaction_id",
                "store_id",
                "customer_id",
                "event_type",
                amount.alias("amount"),
                F.lit("USD").alias("currency"),
                F.when(F.col("western"), local).otherwise(utc).alias("timestamp"),
            )
        )

    text = F.when(F.col("k") == 50, message(F.lit("notanumber"))).otherwise(message(F.col("signed")))
    line = F.when(F.col("broken"), F.expr("left(line, length(line) - 5)")).otherwise(F.col("line"))
    return d.withColumn("line", text).select(line.alias("value"), "delivery")


def pos_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages as table rows, rejected ones included with NULL keys."""
    d = _pos_deliveries(spark, sf_dir)

    def unless_broken(c: Column) -> Column:
        return F.when(~F.col("broken"), c)

    local_day = F.to_date(F.when(F.col("western"), F.col("ts") - _hours(F.lit(5))).otherwise(F.col("ts")))
    rows = d.select(
        unless_broken(F.col("transaction_id")).alias("transaction_id"),
        unless_broken(F.col("store_id")).alias("store_id"),
        unless_broken(F.col("customer_id")).alias("customer_id"),
        unless_broken(F.when(F.col("k") != 50, F.col("signed"))).alias("amount"),
        unless_broken(F.lit("USD")).alias("currency"),
        unless_broken(F.col("ts")).alias("event_ts"),
        unless_broken(local_day).alias("event_date"),
        F.col("delivered_ts").alias("ingestion_ts"),
        F.concat(F.lit("delivery_"), F.col("delivery").cast("string")).alias("source_file"),
        F.lit(None).cast("string").alias("raw_payload"),
        F.when(F.col("broken"), "INVALID").otherwise("VALID").alias("dq_status"),
        F.when(F.col("broken"), "JSON_PARSE_ERROR").alias("dq_errors"),
    )
    return _ordered(rows, schemas.POS)


def raw_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table: rows with a key."""
    return pos_rows(spark, sf_dir).where(F.col("transaction_id").isNotNull())


# --- e-commerce --------------------------------------------------------------


def _ecom_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per message: pending orders are delivered again when they move on."""
    orders = load(spark, sf_dir, "orders")
    times = F.when(F.col("o_orderstatus") == "P", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    delay = F.when(F.col("delivery") == 1, F.col("o_orderkey") % 12).otherwise(12 + F.col("o_custkey") % 24)
    refund = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return orders.select("*", F.explode(times).alias("delivery")).select(
        _id("O", "o_orderkey").alias("order_id"),
        _id("C", "o_custkey").alias("customer_id"),
        F.when(refund, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", "CARD").when(F.col("o_orderstatus") == "O", "WALLET").alias("payment_type"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"),
        (F.col("o_orderdate").cast("timestamp") + _hours(delay.cast("int"))).alias("delivered_ts"),
        "delivery",
    )


def ecom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.to_json(
        F.struct(
            "order_id",
            "customer_id",
            F.lit("ONLINE").alias("store_id"),
            "total_amount",
            "payment_type",
            F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        )
    )
    return _ecom_deliveries(spark, sf_dir).select(line.alias("value"), "delivery")


def raw_ecom(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ecom_deliveries(spark, sf_dir).select(
        "order_id",
        "customer_id",
        F.lit("ONLINE").alias("store_id"),
        "total_amount",
        "payment_type",
        "order_ts",
        F.to_date("order_ts").alias("order_date"),
        F.col("delivered_ts").alias("ingestion_ts"),
        F.concat(F.lit("delivery_"), F.col("delivery").cast("string")).alias("source_file"),
        F.lit(None).cast("string").alias("raw_payload"),
        F.lit("VALID").alias("dq_status"),
        F.lit(None).cast("string").alias("dq_errors"),
    )
    return _ordered(rows, schemas.ECOM)


# --- customers ---------------------------------------------------------------


def _crm_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily exports. On day 2 one segment has a new status, suppliers join as
    business customers, and one segment's export is delivered twice."""
    nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = _spread(load(spark, sf_dir, "customer"), "c_custkey")
    times = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(
        F.array(F.lit(1), F.lit(2))
    )
    people = (
        c.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("*", F.explode(times).alias("delivery"))
        .select(
            _id("C", "c_custkey").alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.col("c_name"), F.lit(', "Jr"')))
            .otherwise(F.col("c_name"))
            .alias("last_name"),
            F.when(F.col("c_acctbal") < 0, F.lower("c_name"))
            .otherwise(F.concat(F.translate(F.lower("c_name"), "#", "."), F.lit("@example.com")))
            .alias("email"),
            F.when((F.col("delivery") > 1) & (F.col("c_mktsegment") == "MACHINERY"), "Gold")
            .otherwise(_tier())
            .alias("loyalty_status"),
            _id("City ", "c_nationkey").alias("city"),
            F.col("n_name").alias("country"),
            F.when(F.col("c_acctbal") > 5000, "Plus").otherwise("Basic").alias("membership_tier"),
            F.when(F.col("delivery") == 1, F.lit(CRM_DAY_1)).otherwise(F.lit(CRM_DAY_2)).cast("timestamp")
            .alias("updated_at"),
            (F.col("c_custkey") % 5 + F.when(F.col("delivery") == 3, 6).otherwise(0)).cast("int").alias("delay"),
            "delivery",
        )
    )
    s = load(spark, sf_dir, "supplier")
    business = s.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        _id("B", "s_suppkey").alias("customer_id"),
        F.lit("Business").alias("first_name"),
        F.col("s_name").alias("last_name"),
        F.concat(F.translate(F.lower("s_name"), "#", "."), F.lit("@example.com")).alias("email"),
        F.lit("Silver").alias("loyalty_status"),
        _id("City ", "s_nationkey").alias("city"),
        F.col("n_name").alias("country"),
        F.lit(None).cast("string").alias("membership_tier"),
        F.lit(CRM_DAY_2).cast("timestamp").alias("updated_at"),
        F.lit(0).alias("delay"),
        F.lit(2).alias("delivery"),
    )
    return people.unionByName(business)


CRM_HEADER = "customer_id,first_name,last_name,email,loyalty_status,city,country,membership_tier,updated_at"


def crm_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text: nine columns for people, the older eight for businesses."""
    quoted = F.concat(F.lit('"'), F.replace("last_name", F.lit('"'), F.lit('""')), F.lit('"'))
    # concat_ws leaves the absent tier out
    line = F.concat_ws(
        ",", "customer_id", "first_name", quoted, "email", "loyalty_status", "city", "country",
        "membership_tier", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    return _crm_snapshots(spark, sf_dir).select(line.alias("value"), "delivery")


def raw_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _crm_snapshots(spark, sf_dir).select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "loyalty_status",
        "city",
        "country",
        "membership_tier",
        "updated_at",
        F.lit(None).cast("string").alias("raw_extra_attributes"),
        (F.col("updated_at") + _hours(F.col("delay"))).alias("ingestion_ts"),
        F.concat(F.lit("delivery_"), F.col("delivery").cast("string")).alias("source_file"),
        F.lit(None).cast("string").alias("raw_payload"),
        F.lit("VALID").alias("dq_status"),
        F.lit(None).cast("string").alias("dq_errors"),
    )
    return _ordered(rows, schemas.CRM)


# --- inventory ---------------------------------------------------------------


def _inventory_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    short = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    count = F.when(short, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("bigint")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        _id("P", "l_partkey").alias("product_id"),
        _id("S", "l_suppkey").alias("store_id"),
        F.col("p_name").alias("product_name"),
        # full pallets come as "50.0", which is no whole number
        F.when(F.abs("l_quantity") == 50, "50.0").otherwise(count.cast("string")).alias("quantity_text"),
        F.when(F.abs("l_quantity") != 50, count).alias("quantity"),
        F.col("p_retailprice").alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("last_updated"),
        F.col("l_linenumber").alias("delay"),
    )


INVENTORY_HEADER = "product_id,store_id,product_name,quantity,price,last_updated"


def inventory_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws(
        ",", "product_id", "store_id", F.coalesce("product_name", F.lit("")), "quantity_text",
        F.coalesce(F.col("price").cast("string"), F.lit("")),
        F.date_format("last_updated", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    return _inventory_snapshots(spark, sf_dir).select(line.alias("value"), F.lit(1).alias("delivery"))


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _inventory_snapshots(spark, sf_dir).select(
        "product_id",
        "store_id",
        "product_name",
        "quantity",
        "price",
        "last_updated",
        (F.col("last_updated") + _hours(F.col("delay"))).alias("ingestion_ts"),
        F.lit("delivery_1").alias("source_file"),
        F.lit(None).cast("string").alias("raw_payload"),
        F.lit("VALID").alias("dq_status"),
        F.lit(None).cast("string").alias("dq_errors"),
    )
    return _ordered(rows, schemas.INVENTORY)


def _ordered(rows: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    names = [f.name for f in spec.schema.fields]
    return rows.withColumn("record_hash", record_hash(rows, spec.hash_keys)).select(*names)


# --- runs --------------------------------------------------------------------


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monitoring row per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = load(spark, sf_dir, "events").select("*", k.alias("k"))
    failed = F.col("k") < 20
    return e.select(
        F.col("event_type").alias("pipeline_name"),
        F.to_date("ts").alias("run_date"),
        F.col("ts").cast("timestamp").alias("run_timestamp"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        (F.col("k") * 10).cast("bigint").alias("records_processed"),
        F.when(failed, F.col("k")).otherwise(0).cast("bigint").alias("records_failed"),
        F.col("user_id").cast("bigint").alias("execution_time_seconds"),
        F.when(failed, F.concat(F.lit("code "), F.col("k").cast("string"))).alias("error_message"),
        F.lit(None).cast("string").alias("metadata"),
    )


_RAW = {
    schemas.POS.name: raw_pos,
    schemas.ECOM.name: raw_ecom,
    schemas.CRM.name: raw_crm,
    schemas.INVENTORY.name: raw_inventory,
}


def raw_tables(spark: SparkSession, sf_dir: str, *specs: schemas.TableSpec) -> dict[str, DataFrame]:
    """Bronze tables by name; all four unless some are named."""
    return {name: build(spark, sf_dir) for name, build in _RAW.items() if not specs or name in {s.name for s in specs}}
