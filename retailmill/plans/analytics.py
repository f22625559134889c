"""Sales questions over ``transactions`` and ``customer_profiles``.

Money is summed as decimal, so results do not depend on the order of rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailmill.operators.latest import first_per_key, total_order


def _sold_in(year: int) -> Column:
    # "is not a return": an unknown flag does not pass
    return F.col("sale_date").between(date(year, 1, 1), date(year, 12, 31)) & (
        F.col("is_return") != F.lit(True)
    )


def top_products(transactions: DataFrame, year: int, n: int = 5) -> DataFrame:
    """Best-selling products of a year by sales amount."""
    return (
        transactions.where(_sold_in(year))
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("sale_amount").alias("total_sale_amount"),
        )
        .orderBy(F.col("total_sale_amount").desc(), "product_id")
        .limit(n)
    )


def monthly_growth(transactions: DataFrame, year: int) -> DataFrame:
    """Sales per month and growth over the previous month present, in percent.

    The window has no partition; its input is one row per month of a year.
    """
    monthly = (
        transactions.where(_sold_in(year))
        .groupBy(F.trunc("sale_date", "month").alias("month"))
        .agg(F.sum("sale_amount").alias("total_sale_amount"))
    )
    total = F.col("total_sale_amount").cast("double")
    previous = F.lag(total).over(Window.orderBy("month"))
    return (
        monthly.withColumn("_previous", previous)
        .select(
            "month",
            "total_sale_amount",
            F.when(F.col("_previous").isNull(), F.lit(0.0))
            .when(F.col("_previous") == 0, F.lit(None))
            .otherwise(100.0 * (total - F.col("_previous")) / F.col("_previous"))
            .alias("mom_pct_growth"),
        )
        .orderBy("month")
    )


def active_tier_customers(
    transactions: DataFrame, profiles: DataFrame, tier: str = "Gold", over: int = 100
) -> DataFrame:
    """How many active customers of a tier bought something above an amount.

    Buyers are made distinct before the join, so a customer with very many
    purchases is one row in it.
    """
    members = profiles.where((F.col("loyalty_tier") == tier) & F.col("is_active")).select("customer_id")
    buyers = (
        transactions.where((F.col("is_return") != F.lit(True)) & (F.col("sale_amount") > over))
        .select("customer_id")
        .distinct()
    )
    return buyers.join(members, "customer_id", "left_semi").agg(
        F.count("customer_id").alias("active_gold_customers_over_100")
    )


def latest_transactions(transactions: DataFrame) -> DataFrame:
    """The last ingested version of each transaction; ``rn`` stays in the output."""
    keys = ["transaction_id"]
    return first_per_key(transactions, keys, total_order(transactions, "ingestion_timestamp", keys=keys))


def customer_lifetime_value(profiles: DataFrame, latest: DataFrame) -> DataFrame:
    """Sales minus returns per customer since registration; 0 without any.

    Sales are summed per customer and day first: the join then sees at most one
    row per day for any customer, however many transactions there are.
    """
    signed = F.when(F.col("is_return"), -F.col("sale_amount")).otherwise(F.col("sale_amount"))
    daily = latest.groupBy("customer_id", "sale_date").agg(F.sum(signed).alias("day_amount"))
    c, d = profiles.alias("c"), daily.alias("d")
    since_registration = (F.col("c.customer_id") == F.col("d.customer_id")) & (
        F.col("d.sale_date") >= F.col("c.registration_date")
    )
    return (
        c.join(d, since_registration, "left")
        .groupBy("c.customer_id", "c.country")
        .agg(F.coalesce(F.sum("d.day_amount"), F.lit(0)).alias("clv_amount"))
        .orderBy(F.col("clv_amount").desc(), "customer_id")
    )
