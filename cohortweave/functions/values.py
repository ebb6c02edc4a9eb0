"""Numbers, arrays, dates and the text form of values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import RESTORATIVE_STAGES
from cohortweave.functions.names import quoted


def array_mean(values: Column) -> Column:
    """Mean of a numeric array; null for an empty or missing one."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(values) > 0, total / F.size(values))


def stage_share(stages: Column, wanted: Iterable[str] = RESTORATIVE_STAGES) -> Column:
    """Percentage of array entries that are one of the wanted stages."""
    hits = F.size(F.filter(stages, lambda s: s.isin(list(wanted))))
    return F.when(F.size(stages) > 0, hits / F.size(stages) * 100)


def whole_years(day: Column, as_of: Column) -> Column:
    """Age in whole 365-day years."""
    return F.floor(F.datediff(as_of, day) / F.lit(365)).cast("long")


def full_date(text: Column) -> Column:
    """Date of a complete year-month-day text; partial dates give null."""
    return F.when(
        text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date")
    )


def parsed_timestamp(value: Column, data_type: T.DataType) -> Column:
    """Timestamp of text or date columns; unparsable text gives null."""
    if not isinstance(data_type, T.StringType):
        return value.cast("timestamp_ntz")
    iso = F.when(value.rlike(r"^\s*\d{4}"), value.try_cast("timestamp_ntz"))
    month_first = F.when(
        value.rlike(r"^\s*\d{1,2}/\d{1,2}/\d{4}\s*$"),
        F.try_to_timestamp(F.trim(value), F.lit("M/d/yyyy")).cast("timestamp_ntz"),
    )
    return F.coalesce(iso, month_first)


def missing_nan(value: Column, data_type: T.DataType) -> Column:
    """The value with floating NaN turned into null."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def plain_double_sql(value: str) -> str:
    """SQL for the text of a double: without an exponent from 1e-4 up to 1e16."""
    text = f"CAST({value} AS STRING)"
    digits = f"rtrim('0', CAST(try_cast({text} AS DECIMAL(38, 21)) AS STRING))"
    spelled = f"CASE WHEN endswith({digits}, '.') THEN concat({digits}, '0') ELSE {digits} END"
    inside = f"contains({text}, 'E') AND abs({value}) BETWEEN 1e-4D AND 9.999999999999998e15D"
    return f"CASE WHEN {inside} THEN {spelled} ELSE {text} END"


def number_text_sql(text: str) -> str:
    """SQL for the shortest spelling of a fractional number read as text; other text is unchanged."""
    number = plain_double_sql(f"try_cast({text} AS DOUBLE)")
    fractional = f"{text} RLIKE '^-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?$' AND {text} RLIKE '[.eE]'"
    return f"CASE WHEN {fractional} THEN {number} ELSE {text} END"


def text_sql(value: str, data_type: T.DataType, missing: str = "'nan'") -> str:
    """SQL for the text of a value of the given type; missing values, NaN included, become `missing`."""
    text = f"CAST({value} AS STRING)"
    if isinstance(data_type, T.DoubleType):
        text = f"CASE WHEN NOT isnan({value}) THEN {plain_double_sql(value)} END"
    elif isinstance(data_type, T.FloatType):
        text = f"CASE WHEN NOT isnan({value}) THEN {text} END"
    elif isinstance(data_type, T.BooleanType):
        text = f"initcap({text})"
    return text if missing == "NULL" else f"coalesce({text}, {missing})"


def plain_text_sql(name: str, data_type: T.DataType) -> str:
    """SQL for the text of a column's value; missing values are written as 'nan'."""
    return text_sql(quoted(name), data_type)


def row_hash(fields: Iterable[T.StructField]) -> Column:
    """SHA-256 over the text of the given columns in order; null is written as 'nan'."""
    return F.expr(f"sha2(concat({', '.join(plain_text_sql(f.name, f.dataType) for f in fields)}), 256)")


def pseudonym(value: Column, salt: str) -> Column:
    """16 hex digits of the salted hash; null and blank values pass through."""
    text = value.cast("string")
    return F.when(F.trim(text) == "", text).otherwise(
        F.substring(F.sha2(F.concat(text, F.lit(salt)), 256), 1, 16)
    )


def laplace(scale: float, *, seed: str, row_key: Iterable[Column] | None = None, column: str = "") -> Column:
    """Laplace noise of the given scale by the inverse distribution function.

    With `row_key` the draw is a keyed hash of the row, so that a retried task draws the same
    noise whatever the partitioning; `seed` is then the secret. The key must be unique per row.
    """
    if row_key is None:
        uniform = F.rand(int.from_bytes(seed.encode()[:7], "big") if seed else None)
    else:
        digest = F.sha2(F.concat_ws("|", F.lit(seed), F.lit(column), *[k.cast("string") for k in row_key]), 256)
        steps = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
        uniform = (steps + 0.5) / float(2**52)
    centred = uniform - F.lit(0.5)
    return F.lit(-float(scale)) * F.signum(centred) * F.ln(F.lit(1.0) - F.lit(2.0) * F.abs(centred))
