"""Conformed facts and dimensions, and the marts built on them."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.parsing import money
from retailmill.operators.dedup import dedup_table
from retailmill.operators.late import rows_to_reaggregate
from retailmill.operators.latest import latest_per_key


def _money(column: str) -> Column:
    return money(F.col(column))


def sales_fact(pos: DataFrame, ecom: DataFrame) -> DataFrame:
    """Point-of-sale and online sales in one shape, tagged by channel."""
    return pos.select(
        F.lit("POS").alias("channel"),
        F.col("transaction_id").alias("sale_id"),
        "store_id",
        "customer_id",
        F.col("event_ts").alias("sale_ts"),
        F.col("event_date").alias("sale_date"),
        _money("amount").alias("amount"),
    ).unionByName(
        ecom.select(
            F.lit("ECOM").alias("channel"),
            F.col("order_id").alias("sale_id"),
            "store_id",
            "customer_id",
            F.col("order_ts").alias("sale_ts"),
            F.col("order_date").alias("sale_date"),
            _money("total_amount").alias("amount"),
        )
    )


POS_SALE = ("transaction_id", "store_id", "customer_id", "event_ts", "event_date", "amount", "ingestion_ts")
ECOM_SALE = ("order_id", "store_id", "customer_id", "order_ts", "order_date", "total_amount", "ingestion_ts")


def deduplicated_sales_fact(pos: DataFrame, ecom: DataFrame) -> DataFrame:
    """The fact from raw tables: deduplicated on just the columns it needs."""
    return sales_fact(
        dedup_table(pos.select(*POS_SALE), schemas.POS), dedup_table(ecom.select(*ECOM_SALE), schemas.ECOM)
    )


def inventory_snapshot_fact(inventory: DataFrame) -> DataFrame:
    """The newest stock row per product and store, with its day."""
    # only what the fact holds, so nothing else is sorted and shuffled
    narrow = inventory.select("product_id", "store_id", "quantity", "price", "last_updated")
    newest = latest_per_key(narrow, ["product_id", "store_id"], "last_updated")
    return newest.select(
        F.to_date("last_updated").alias("snapshot_date"),
        "product_id",
        "store_id",
        "quantity",
        _money("price").alias("price"),
        "last_updated",
    )


def store_dim(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every store that sold or stocks something, and in what roles it was seen."""
    seen = sales.select(
        "store_id", (F.col("channel") == "POS").alias("p"), (F.col("channel") == "ECOM").alias("e"), F.lit(False).alias("i")
    ).unionByName(
        inventory.select(
            "store_id", F.lit(False).alias("p"), F.lit(False).alias("e"), F.lit(True).alias("i")
        )
    )
    return (
        seen.where(F.col("store_id").isNotNull() & (F.col("store_id") != ""))
        .groupBy("store_id")
        .agg(
            F.bool_or("p").alias("sells_pos"),
            F.bool_or("e").alias("sells_online"),
            F.bool_or("i").alias("holds_inventory"),
        )
    )


def product_dim(inventory: DataFrame) -> DataFrame:
    """Products with the name and price of their newest snapshot."""
    narrow = inventory.select("product_id", "product_name", "price", "last_updated")
    return latest_per_key(narrow, ["product_id"], "last_updated").select(
        "product_id", "product_name", _money("price").alias("price")
    )


def date_dim(dates: DataFrame, date_column: str) -> DataFrame:
    """One row per calendar day from the first to the last date in the data."""
    day = F.col("date_day")
    span = dates.agg(F.min(date_column).alias("first"), F.max(date_column).alias("last"))
    return span.select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date_day")
    ).select(
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.weekday(day) + 1).alias("iso_day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def daily_store_sales(sales: DataFrame) -> DataFrame:
    """Sales per store and day."""
    return sales.groupBy("store_id", "sale_date").agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.sum(F.when(F.col("amount") < 0, F.col("amount"))).alias("refund_amount"),
        F.max("amount").alias("largest_amount"),
    )


def customer_360(dim: DataFrame, sales: DataFrame) -> DataFrame:
    """Current customers with their sales per channel; customers without sales show zeros.

    Sales are reduced to one row per customer before the join.
    """
    per_customer = sales.groupBy("customer_id").agg(
        F.count("*").alias("sales_count"),
        F.count_if(F.col("channel") == "ECOM").alias("online_count"),
        F.sum("amount").alias("total_amount"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )
    current = dim.where(F.col("is_current")).select(
        "customer_id", "first_name", "last_name", "loyalty_status", "membership_tier", "country"
    )
    zero = F.lit(0)
    return current.join(per_customer, "customer_id", "left").select(
        *current.columns,
        F.coalesce("sales_count", zero).alias("sales_count"),
        F.coalesce("online_count", zero).alias("online_count"),
        F.coalesce("total_amount", zero.cast("decimal(18,2)")).alias("total_amount"),
        "first_sale_date",
        "last_sale_date",
    )


def inventory_kpi(snapshot: DataFrame) -> DataFrame:
    """Stock level, out-of-stock positions and stock value per store."""
    out = F.col("quantity") <= 0
    return snapshot.groupBy("store_id").agg(
        F.count("*").alias("positions"),
        F.sum("quantity").alias("stock_on_hand"),
        F.count_if(out).alias("out_of_stock"),
        F.sum(F.col("quantity") * F.col("price")).alias("stock_value"),
    )


def affected_daily_store_sales(sales: DataFrame, pending_dates: DataFrame) -> DataFrame:
    """The daily mart recomputed for the given dates only."""
    return daily_store_sales(rows_to_reaggregate(sales, "sale_date", pending_dates))


def materialize_daily_store_sales(sales: DataFrame, path: str) -> None:
    """Writes the daily mart by month; months present in ``sales`` replace their old version.

    A day of the mart is only one row per store, so days as partitions would be
    thousands of tiny files. Pass whole months when refreshing.
    """
    (
        daily_store_sales(sales)
        .withColumn("sale_month", F.trunc("sale_date", "month"))
        .hint("rebalance", "sale_month")
        .sortWithinPartitions("sale_month", "sale_date", "store_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sale_month")
        .parquet(path)
    )
