"""One row, or the first few rows, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType)


def total_order(
    df: DataFrame, order_column: str, newest: bool = True, keys: Sequence[str] = ()
) -> list[Column]:
    """Sort expressions on the order column (NULLs lose), ties broken by the columns other than the keys.

    The tiebreak makes the choice repeatable after a task retry: two rows that
    still tie are equal in every column.
    """
    column = F.col(order_column)
    first = column.desc_nulls_last() if newest else column.asc_nulls_last()
    others = [
        F.col(f.name).asc_nulls_last()
        for f in df.schema.fields
        if f.name != order_column and f.name not in keys and not isinstance(f.dataType, _UNORDERABLE)
    ]
    return [first, *others]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key with their rank in ``rn``.

    The rank limit is applied before the shuffle too, so a key with very many
    copies sends at most ``n`` rows per input task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= n)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_column: str, newest: bool = True
) -> DataFrame:
    """Latest (or earliest) row per key; use with ``df.transform``."""
    return first_per_key(df, keys, total_order(df, order_column, newest, keys)).drop("rn")
