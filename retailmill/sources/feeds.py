"""Parsing landed lines into bronze rows.

A parser takes ``value`` and ``source_file`` and returns the bronze columns plus
``_error`` and ``_misfits``, the typed fields whose text was there but did not fit.
Good rows and dead letters are two filters over the same frame. All parsing is
built-in expressions, so it works the same on a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmill import schemas
from retailmill.functions.clock import ts_lit
from retailmill.functions.hashing import record_hash
from retailmill.functions.parsing import (
    csv_cell, csv_width, evaluated_once, iso_canonical, iso_local_date, iso_timestamp, parse_csv,
    safe_float, safe_int, split_csv,
)

VALID, INVALID = "VALID", "INVALID"
ERROR, MISFITS = "_error", "_misfits"
#: Per table the columns whose text has to fit a type.
TYPED = {
    schemas.POS.name: ("amount", "event_ts"),
    schemas.ECOM.name: ("total_amount", "order_ts"),
    schemas.CRM.name: ("updated_at",),
    schemas.INVENTORY.name: ("quantity", "price", "last_updated"),
}
UNHEADED, REPEATED, WRONG_TYPE = "First line is no header", "Repeated header", "Wrong type of "


def _json_fields(lines: DataFrame, fields: list[str]) -> DataFrame:
    """Adds ``_j`` with the fields as text, ``_ok``, and the canonical ``_iso`` time text."""
    schema = ", ".join(f"{name} string" for name in fields) + ", _corrupt_record string"
    parsed = F.from_json(
        "value",
        schema,
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "_corrupt_record",
            "allowSingleQuotes": "false",
        },
    )
    df = evaluated_once(lines, _j=parsed, _closed=F.coalesce(_one_value(F.col("value")), F.lit(False)))
    return df.withColumn("_ok", F.col("_j._corrupt_record").isNull() & F.col("_closed")).withColumn(
        "_iso", iso_canonical(_field("timestamp"))
    )


def _one_value(line: Column) -> Column:
    """Whether nothing follows the first object, where the JSON reader stops.

    With a single closing brace, at the end, nothing can. Of a flat object, the text without
    its strings shows where it ends. Other lines are read again in
    two wrappings: what may go on after a value in an array and what may in an object
    have nothing in common, so only a line of exactly one value passes both.
    """
    unescaped = F.replace(F.replace(line, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    bare = F.regexp_replace(unescaped, '"[^"]*+"', "")
    braces = F.length(line) - F.length(F.replace(line, F.lit("}"), F.lit("")))
    elements = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")
    member = F.from_json(F.concat(F.lit('{"_line":'), line, F.lit(',"_end":1}')), "_line string, _end int")
    alone = (F.size(elements) == 1) & (member["_end"] == 1)
    blank, flat = r"[ \t\r\n]*+", r"\{[^{}]*+\}"
    one = (
        F.when(braces == 1, True).when(bare.rlike(f"^{blank}{flat}{blank}$"), True)
        .when(bare.rlike(f"^{blank}{flat}"), False).otherwise(alone)
    )
    return F.rtrim(line, F.lit(" \t\r\n")).endswith("}") & one


def _field(name: str) -> Column:
    return F.when(F.col("_ok"), F.col(f"_j.{name}"))


def _json_number(name: str) -> Column:
    """A JSON number, number text, or a JSON boolean (1.0 / 0.0; the text "true" is not one)."""
    text = _field(name)
    # the reader gives these three tokens with quotes
    text = F.when(text.isin('"NaN"', '"Infinity"', '"-Infinity"'), F.replace(text, F.lit('"'), F.lit(""))).otherwise(text)
    # only looked at for rows whose text is true / false
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json("value"), f"$.{name}", "variant"))
    flag = F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
    return F.when(text.isin("true", "false"), flag).otherwise(safe_float(text))


def _csv_cells(lines: DataFrame, columns: int) -> DataFrame:
    """Adds ``_c`` with the cells by position and ``_width``, the number of cells on the line;
    and ``_n``, the cells as an array, on lines of files whose header is not a declared one."""
    if "header" not in lines.columns:
        lines = lines.withColumns({"header": F.lit(None).cast("array<string>"), "unheaded": F.lit(False)})
    value = F.col("value")
    return evaluated_once(
        lines, _c=parse_csv(value, columns), _width=csv_width(value),
        _n=F.when(F.col("header").isNotNull(), split_csv(value)),
    )


def _cell(i: int) -> Column:
    return csv_cell(F.col("_c"), F.col("_width"), i)


def _by_name(name: str, by_position: Column) -> Column:
    """A column's cell: where the file's own header puts it, else by position."""
    at = F.array_position("header", F.lit(name)).cast("int")
    return F.when(F.col("_n").isNull(), by_position).otherwise(F.get("_n", at - 1))


def _other_columns(known: list[str]) -> Column:
    """JSON of the columns that a header names beyond the known ones; NULL if there are none.
    Of a name that occurs twice, the first column counts."""
    named = F.transform(
        "header",
        lambda name, i: F.struct(
            name.alias("name"), F.get("_n", i).alias("cell"),
            (~name.isin(*known) & (F.array_position("header", name) == i + 1)).alias("other"),
        ),
    )
    others = F.filter(named, lambda c: c["other"])
    pairs = F.map_from_entries(F.transform(others, lambda c: F.struct(c["name"], c["cell"])))
    return F.when(F.size(others) > 0, F.to_json(pairs, {"ignoreNullFields": "false"}))


def _header_errors(spec: schemas.TableSpec, columns: dict[str, Column]) -> Column:
    """Why a CSV line is no row whatever its cells hold."""
    repeated = reduce(and_, [F.lower(F.trim(columns[key])) == key for key in spec.required])
    return F.when(F.col("unheaded"), UNHEADED).when(repeated, REPEATED)


def _finish(
    df: DataFrame,
    spec: schemas.TableSpec,
    columns: dict[str, Column],
    parsed_ok: Column,
    as_of: datetime | str | None,
    parse_error: str,
    typed: dict[str, Column],
    rejected: Column | None = None,
) -> DataFrame:
    """Adds lineage, quality tag, record hash, the reason to reject a line, and which of the
    ``typed`` fields, given as text, do not fit their type."""
    ingestion = F.current_timestamp() if as_of is None else ts_lit(as_of)
    rows = df.select(
        *[value.alias(name) for name, value in columns.items()],
        ingestion.alias("ingestion_ts"),
        "source_file",
        F.col("value").alias("raw_payload"),
        F.when(parsed_ok, VALID).otherwise(INVALID).alias("dq_status"),
        F.when(~parsed_ok, parse_error).alias("dq_errors"),
        F.array_compact(F.array(*[
            F.when((F.trim(text) != "") & columns[name].isNull(), F.lit(name)) for name, text in typed.items()
        ])).alias(MISFITS),
        (F.lit(None).cast("string") if rejected is None else rejected).alias("_rejected"),
    )
    any_missing = reduce(or_, [F.col(key).isNull() for key in spec.required])
    missing = F.coalesce("_rejected", F.when(any_missing, "Missing " + " or ".join(spec.required)))
    ordered = [f.name for f in spec.schema.fields]
    return (
        rows.withColumn("record_hash", record_hash(rows, spec.hash_keys))
        .withColumn(ERROR, missing)
        .select(*ordered, ERROR, MISFITS)
    )


def parse_pos(lines: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Point-of-sale JSON lines."""
    df = _json_fields(lines, ["transaction_id", "store_id", "customer_id", "amount", "currency", "timestamp"])
    columns = {name: _field(name) for name in ("transaction_id", "store_id", "customer_id")}
    columns |= {
        "amount": _json_number("amount"),
        "currency": _field("currency"),
        "event_ts": iso_timestamp(F.col("_iso")),
        "event_date": iso_local_date(F.col("_iso")),
    }
    typed = {"amount": _field("amount"), "event_ts": _field("timestamp")}
    return _finish(df, schemas.POS, columns, F.col("_ok"), as_of, "JSON_PARSE_ERROR", typed)


def parse_ecom(lines: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """E-commerce order JSON lines."""
    df = _json_fields(lines, ["order_id", "customer_id", "store_id", "total_amount", "payment_type", "timestamp"])
    columns = {name: _field(name) for name in ("order_id", "customer_id", "store_id")}
    columns |= {
        "total_amount": _json_number("total_amount"),
        "payment_type": _field("payment_type"),
        "order_ts": iso_timestamp(F.col("_iso")),
        "order_date": iso_local_date(F.col("_iso")),
    }
    typed = {"total_amount": _field("total_amount"), "order_ts": _field("timestamp")}
    return _finish(df, schemas.ECOM, columns, F.col("_ok"), as_of, "JSON_PARSE_ERROR", typed)


def parse_crm(lines: DataFrame, as_of: datetime | str | None = None, legacy: bool = False) -> DataFrame:
    """Customer CSV lines in the 8-column layout or the 9-column one with a tier; in files with
    another header, columns go by their names and further ones into ``raw_extra_attributes``.

    ``legacy=True`` leaves ``membership_tier`` empty for every layout.
    """
    width = F.col("_width")
    updated = _by_name("updated_at", F.when(width == 8, _cell(7)).when(width >= 9, _cell(8)))
    df = _csv_cells(lines, 9).withColumn("_updated", updated).withColumn("_iso", iso_canonical(F.col("_updated")))
    tier = F.lit(None).cast("string") if legacy else _by_name("membership_tier", F.when(width >= 9, _cell(7)))
    names = ("customer_id", "first_name", "last_name", "email", "loyalty_status", "city", "country")
    columns = {name: _by_name(name, _cell(i)) for i, name in enumerate(names)}
    columns |= {
        "membership_tier": tier,
        "updated_at": iso_timestamp(F.col("_iso")),
        "raw_extra_attributes": F.when(F.col("_n").isNotNull(), _other_columns([*names, "membership_tier", "updated_at"])),
    }
    return _finish(
        df, schemas.CRM, columns, F.col("value").isNotNull(), as_of, "CSV_PARSE_ERROR",
        {"updated_at": F.col("_updated")}, _header_errors(schemas.CRM, columns),
    )


def parse_inventory(lines: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Stock snapshot CSV lines; in files with another header, columns go by their names."""
    names = ("product_id", "store_id", "product_name", "quantity", "price", "last_updated")
    text = {name: _by_name(name, _cell(i)) for i, name in enumerate(names)}
    df = _csv_cells(lines, 6).withColumn("_iso", iso_canonical(text["last_updated"]))
    columns = {
        **{name: text[name] for name in names[:3]},
        "quantity": safe_int(text["quantity"]),
        "price": safe_float(text["price"]),
        "last_updated": iso_timestamp(F.col("_iso")),
    }
    return _finish(
        df, schemas.INVENTORY, columns, F.col("value").isNotNull(), as_of, "CSV_PARSE_ERROR",
        {name: text[name] for name in names[3:]}, _header_errors(schemas.INVENTORY, columns),
    )


PARSERS: dict[str, Callable[..., DataFrame]] = {
    schemas.POS.name: parse_pos,
    schemas.ECOM.name: parse_ecom,
    schemas.CRM.name: parse_crm,
    schemas.INVENTORY.name: parse_inventory,
}


def rejection(parsed: DataFrame, strict: bool = False) -> Column:
    """Why a line is rejected, NULL if it is not. ``strict`` rejects wrong types, too."""
    if not strict:
        return F.col(ERROR)
    wrong = F.when(F.size(MISFITS) > 0, F.concat(F.lit(WRONG_TYPE), F.array_join(MISFITS, ", ")))
    return F.coalesce(F.col(ERROR), wrong)


def good_rows(parsed: DataFrame, strict: bool = False) -> DataFrame:
    return parsed.where(rejection(parsed, strict).isNull()).drop(ERROR, MISFITS)


def dead_letters(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Rejected lines with the reason and the file they came from."""
    reason = rejection(parsed, strict)
    return parsed.where(reason.isNotNull()).select(F.col("raw_payload").alias("line"), reason.alias("error"), "source_file")


def misfits(parsed: DataFrame) -> DataFrame:
    """Per typed field, how many lines hold text that does not fit its type: field, rule, line_count."""
    return (
        parsed.select(F.explode(MISFITS).alias("field"))
        .groupBy("field", F.lit("type").alias("rule"))
        .agg(F.count("*").alias("line_count"))
    )
