"""Data-quality counts, dead-letter analysis, contracts and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill import schemas
from retailmill.functions.clock import ts_lit
from retailmill.functions.parsing import unfit


def _null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _negative(column: str) -> Column:
    return F.count_if(F.col(column) < 0)


def _invalid() -> Column:
    return F.count_if(F.col("dq_status") == "INVALID")


def _duplicates(column: str) -> Column:
    # both counts leave NULL ids out
    return F.count(column) - F.count_distinct(column)


def _checks(as_of: datetime | str) -> dict[str, dict[str, Column]]:
    now = ts_lit(as_of)
    bad_email = F.col("email").isNotNull() & ~F.col("email").like("%@%.%")
    return {
        schemas.POS.name: {
            "pos_null_transaction_id_count": _null("transaction_id"),
            "pos_negative_amount_count": _negative("amount"),
            "pos_future_date_count": F.count_if(F.col("event_ts") > now),
            "pos_duplicate_transaction_count": _duplicates("transaction_id"),
            "pos_invalid_dq_row_count": _invalid(),
        },
        schemas.ECOM.name: {
            "ecom_null_order_id_count": _null("order_id"),
            "ecom_negative_amount_count": _negative("total_amount"),
            "ecom_future_date_count": F.count_if(F.col("order_ts") > now),
            "ecom_duplicate_order_count": _duplicates("order_id"),
            "ecom_invalid_dq_row_count": _invalid(),
        },
        schemas.CRM.name: {
            "crm_null_customer_id_count": _null("customer_id"),
            "crm_invalid_email_count": F.count_if(bad_email),
            "crm_invalid_dq_row_count": _invalid(),
        },
        schemas.INVENTORY.name: {
            "inv_null_product_id_count": _null("product_id"),
            "inv_null_store_id_count": _null("store_id"),
            "inv_negative_quantity_count": _negative("quantity"),
            "inv_invalid_dq_row_count": _invalid(),
        },
    }


def dq_scorecard(tables: Mapping[str, DataFrame], as_of: datetime | str) -> DataFrame:
    """All checks in one row, with a single pass over each table."""
    checks = _checks(as_of)
    parts = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            tables[name].agg(*[value.alias(column) for column, value in checks[name].items()])
            for name in checks
        ],
    )
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def dead_letter_summary(dead: DataFrame) -> DataFrame:
    """Rejected lines by reason and file."""
    return dead.groupBy("error", "source_file").agg(F.count("*").alias("rejected"))


def contract_violations(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Per required column of a contract, how many rows break it."""
    required = [f.name for f in contract.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*[_null(c).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "violations")


def unfit_amounts(amounts: Mapping[str, Column], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table, how many amounts are there and how many of them cannot be money."""

    def branch(name: str) -> DataFrame:
        value = amounts[name]
        return tables[name].agg(F.count(value).alias("amounts"), F.count_if(unfit(value)).alias("unfit")).select(
            F.lit(name).alias("table_name"), "amounts", "unfit"
        )

    return reduce(DataFrame.unionByName, [branch(name) for name in amounts])


def reconcile(
    source: DataFrame, target: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Totals of the measures on both sides per key, and their difference.

    Both sides are summed in one aggregation, so a key missing on one side shows
    up with the other side's full total.
    """
    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, *measures, F.lit(sign).alias("_side"))

    is_source = F.col("_side") == 1
    totals = (
        side(source, 1)
        .unionByName(side(target, -1))
        .groupBy(*keys)
        .agg(
            *[F.coalesce(F.sum(F.when(is_source, F.col(m))), F.lit(0)).alias(f"source_{m}") for m in measures],
            *[F.coalesce(F.sum(F.when(~is_source, F.col(m))), F.lit(0)).alias(f"target_{m}") for m in measures],
        )
    )
    for m in measures:
        totals = totals.withColumn(f"{m}_difference", F.col(f"source_{m}") - F.col(f"target_{m}"))
    return totals
