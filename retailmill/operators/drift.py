"""Schema drift: what the feed carries against what is declared."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmill import schemas
from retailmill.functions.parsing import evaluated_once

# The customer columns every record must offer; anything else is an extra attribute.
_OWN = {"raw_extra_attributes", "ingestion_ts", "source_file", "raw_payload", "record_hash", "dq_status", "dq_errors"}
CRM_BASE_FIELDS = tuple(name for name in schemas.RAW_CRM.names if name not in _OWN)


def declared_fields(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A schema as rows ``field, type``: one row per column."""
    rows = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "field string, type string")


def _plain_type(kind: Column) -> Column:
    """Variant type names reduced to the declared vocabulary."""
    return (
        F.when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "double")
        .when(kind.rlike("^OBJECT"), "struct")
        .when(kind.rlike("^ARRAY"), "array")
        .otherwise(F.lower(kind))
    )


def json_profile(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Observed ``field, type`` pairs of the JSON payloads with the number of rows.

    Each payload is exploded to its fields and counted at once, so only a
    handful of combinations per task are shuffled. JSON nulls have no type and
    are left out.
    """
    parsed = evaluated_once(df.select(payload), v=F.try_parse_json(payload)).select("v").where(F.col("v").isNotNull())
    fields = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kinds = evaluated_once(fields.select("key", "value"), kind=F.schema_of_variant("value"))
    return (
        kinds.select(F.col("key").alias("field"), _plain_type(F.col("kind")).alias("type"))
        .where(F.col("field").isNotNull() & (F.col("type") != "void"))
        .groupBy("field", "type")
        .agg(F.count("*").alias("row_count"))
    )


def compare_fields(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Added and removed fields and changed types, from two ``field, type`` frames.

    Whole numbers are no change for a declared ``double``. A field seen with
    several types gives one row per differing type.
    """
    d, o = declared.alias("d"), observed.alias("o")
    same = (F.col("d.type") == F.col("o.type")) | (
        (F.col("d.type") == "double") & (F.col("o.type") == "bigint")
    )
    change = (
        F.when(F.col("d.field").isNull(), "added")
        .when(F.col("o.field").isNull(), "removed")
        .when(~same, "type_changed")
    )
    return (
        d.join(o, F.col("d.field") == F.col("o.field"), "full_outer")
        .select(
            F.coalesce("d.field", "o.field").alias("field"),
            change.alias("change"),
            F.col("d.type").alias("declared_type"),
            F.col("o.type").alias("observed_type"),
        )
        .where(F.col("change").isNotNull())
    )


def schema_drift(spark: SparkSession, declared: T.StructType, observed: T.StructType) -> DataFrame:
    """Drift between two schemas."""
    return compare_fields(declared_fields(spark, declared), declared_fields(spark, observed))


def feed_drift(df: DataFrame, declared: T.StructType, payload: str = "raw_payload") -> DataFrame:
    """Drift between the JSON that arrived and the declared feed schema."""
    return compare_fields(declared_fields(df.sparkSession, declared), json_profile(df, payload))


def header_drift(headers: DataFrame, layouts: Sequence[str]) -> DataFrame:
    """What the files' headers have beyond, or lack of, the declared CSV layouts: field, change,
    declared_type, observed_type, file_count. A field of some layouts only may be absent. Files
    without a header of their own say nothing."""
    known = [layout.split(",") for layout in layouts]
    every = [name for name in known[0] if all(name in names for names in known)]
    some = sorted({name for names in known for name in names})

    def literal(names: Sequence[str]) -> Column:
        return F.array(*[F.lit(name) for name in names])

    def changes(names: Column, change: str) -> Column:
        return F.transform(names, lambda name: F.struct(name.alias("field"), F.lit(change).alias("change")))

    changed = F.concat(
        changes(F.array_except("header", literal(some)), "added"), changes(F.array_except(literal(every), "header"), "removed")
    )
    text = F.lit("string")
    return (
        headers.where(F.col("header").isNotNull())
        .select(F.explode(changed).alias("c"))
        .groupBy("c.field", "c.change")
        .agg(F.count("*").alias("file_count"))
        .select(
            "field", "change", F.when(F.col("change") == "removed", text).alias("declared_type"),
            F.when(F.col("change") == "added", text).alias("observed_type"), "file_count",
        )
    )


def merge_schemas(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """Existing columns as they are, new ones appended as nullable; none dropped or retyped."""
    known = set(existing.fieldNames())
    added = [T.StructField(f.name, f.dataType, True) for f in incoming.fields if f.name not in known]
    return T.StructType([*existing.fields, *added])


def _as_declared(df: DataFrame, field: T.StructField) -> Column:
    """A column in its declared type; NULL where it is absent or a value does not fit."""
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    if df.schema[field.name].dataType == field.dataType:
        return F.col(field.name)
    value = F.col(field.name).try_cast(field.dataType)
    try:
        df.select(value)
    except AnalysisException:  # no value of the one type is one of the other
        return F.lit(None).cast(field.dataType)
    return value


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with exactly the schema's columns and types; columns the rows lack are
    NULL, and so are values that do not fit, which :func:`misfits` counts."""
    return df.select(*[_as_declared(df, f).alias(f.name) for f in schema.fields])


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column that arrives in another type than declared, how many values do not fit it."""
    retyped = [f for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    if not retyped:
        return df.sparkSession.createDataFrame([], "column_name string, misfits bigint")
    counts = df.agg(
        *[F.count_if(F.col(f.name).isNotNull() & _as_declared(df, f).isNull()).alias(f.name) for f in retyped]
    )
    return counts.unpivot([], [f.name for f in retyped], "column_name", "misfits")


def _types(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def handle_drift(
    table: DataFrame, incoming: DataFrame, auto_update: bool = False
) -> tuple[DataFrame, bool]:
    """(table rows with the incoming rows appended, whether the schema was extended).

    With ``auto_update`` new columns join the table. Without it the table keeps
    its schema and new columns are left out. Columns are never retyped.
    """
    drifted = _types(table.schema) != _types(incoming.schema)
    updated = drifted and auto_update
    target = merge_schemas(table.schema, incoming.schema) if updated else table.schema
    return conform(table, target).unionByName(conform(incoming, target)), updated


def normalize_crm(df: DataFrame, base: Sequence[str] = CRM_BASE_FIELDS) -> DataFrame:
    """Base customer columns plus ``raw_extra_attributes``: the other columns as one JSON text,
    NULL where there are none."""
    extra = [c for c in df.columns if c not in base]
    attributes = (
        F.to_json(F.struct(*extra), {"ignoreNullFields": "false"}) if extra else F.lit(None).cast("string")
    )
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in base],
        attributes.alias("raw_extra_attributes"),
    )
