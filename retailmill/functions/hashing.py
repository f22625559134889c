"""Record and attribute fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill.functions.clock import iso_text


def _key_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return iso_text(F.col(name))
    return F.col(name).cast("string")


def record_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """md5 of the key values joined by ``|``; NULL counts as the empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_key_text(df, k), F.lit("")) for k in keys]))


def attributes_hash(columns: Sequence[str]) -> Column:
    """md5 of the columns as compact JSON, NULLs kept."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
