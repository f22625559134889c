"""Text to typed values. A bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extended ISO-8601 as almost every feed writes it.
_ISO_USUAL = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})?)?$"
# The rarer spellings: compact digits, other separators, no seconds, comma fraction.
_ISO_RARE = (
    r"^(\d{4}-\d{2}-\d{2}|\d{8})"
    r"(.\d{2}((:\d{2}(:\d{2}([.,]\d+)?)?)|(\d{2}(\d{2}([.,]\d+)?)?))?"
    r"([+-]\d{2}(:?\d{2}(:?\d{2}([.]\d+)?)?)?)?)?$"
)


def iso_canonical(text: Column) -> Column:
    """ISO text in the spelling Spark parses, NULL for any other shape.

    Spark alone would also take ``2025`` or ``T09:12``. The rewriting branch is
    only evaluated for rows that miss the usual spelling.
    """
    zoned = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    dated = F.regexp_replace(zoned, r"^(\d{4})(\d{2})(\d{2})", r"$1-$2-$3")
    split = F.regexp_replace(dated, r"^(.{10}).", r"$1T")
    timed = F.regexp_replace(split, r"T(\d{2})(\d{2})(\d{2})?", r"T$1:$2:$3")
    minutes = F.regexp_replace(timed, r"T(\d{2})(?=[+-]|$)", r"T$1:00:00")
    seconds = F.regexp_replace(minutes, r"T(\d{2}:\d{2}):?(?=[+-]|$)", r"T$1:00")
    rewritten = F.replace(seconds, F.lit(","), F.lit("."))
    return F.when(text.rlike(_ISO_USUAL), text).when(zoned.rlike(_ISO_RARE), rewritten)


def iso_timestamp(canonical: Column) -> Column:
    """The instant of canonical ISO text; text without an offset is UTC."""
    return F.try_to_timestamp(canonical)


def iso_local_date(canonical: Column) -> Column:
    """The calendar date as written, in the text's own offset, if the whole text is valid."""
    return F.when(
        F.try_to_timestamp(canonical).isNotNull(), F.substring(canonical, 1, 10).cast("date")
    )


def _plain_number(text: Column) -> Column:
    # 1_000 is a number in the feeds' dialect
    trimmed = F.trim(text)
    return F.when(trimmed.contains("_"), F.regexp_replace(trimmed, r"(?<=\d)_(?=\d)", "")).otherwise(trimmed)


def safe_float(text: Column) -> Column:
    number = _plain_number(text)
    return (
        F.when(number.rlike(r"(?i)^[+-]nan$"), F.lit(float("nan")))
        # the JVM would read 1d and 1f as numbers
        .when(~number.rlike(r"[0-9.][dDfF]$"), number.try_cast("double"))
    )


def money(amount: Column) -> Column:
    """An amount with two decimals. What does not fit (too large, infinite, not a number)
    is NULL here and counted by :func:`unfit`; no value stops a job."""
    return amount.try_cast("decimal(18,2)")


def unfit(amount: Column) -> Column:
    """Whether an amount is there but cannot be money."""
    return amount.isNotNull() & money(amount).isNull()


def safe_int(text: Column) -> Column:
    return _plain_number(text).try_cast("bigint")


def csv_width(line: Column) -> Column:
    """Number of cells: commas outside quoted cells, plus one; none on a blank line."""
    unquoted = F.regexp_replace(line, '(^|,)"[^"]*(?:""[^"]*)*(?:"|$)', "$1")
    unquoted = F.when(line.contains('"'), unquoted).otherwise(line)
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    return F.when(line == "", 0).otherwise(commas + 1)


def csv_cell(cells: Column, width: Column, i: int) -> Column:
    """Cell ``i`` of a parsed line: ``''`` if empty, NULL only past the row's width."""
    return F.when(width > i, F.coalesce(cells[f"c{i}"], F.lit("")))


def parse_csv(line: Column, columns: int) -> Column:
    """One CSV line as a struct ``c0 .. c<n-1>`` of strings; empty cells come back NULL."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    return F.from_csv(line, schema, {"escape": '"', "emptyValue": ""})


def split_csv(line: Column) -> Column:
    """The cells of a CSV line as an array of any length, for lines whose columns are not known beforehand."""
    # each cell after a comma, so that no match is empty
    pattern = F.lit(r',("[^"]*+(?:""[^"]*+)*+(?:"|$)[^,]*|[^,]*)')
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), pattern, 1)
    unquoted = lambda c: F.replace(
        F.regexp_replace(c, r'^"([^"]*+(?:""[^"]*+)*+)"?(.*)$', "$1$2"), F.lit('""'), F.lit('"')
    )
    return F.transform(raw, lambda c: F.when(c.startswith('"'), unquoted(c)).otherwise(c))


def evaluated_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns whose expressions run once per row.

    The optimizer copies an expression into every filter and projection that
    refers to it, so a parsed line would be parsed again for each. It does not
    look through a generator.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
