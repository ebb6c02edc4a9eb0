"""Removal of identifiers, age cap and birth years."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import (
    AGE_CAP_ABOVE,
    AGE_CAP_VALUE,
    DATE_NAME_PATTERN,
    EXPLICIT_IDENTIFIERS,
    NONSTANDARD_PREFIX,
    PII_NAME_PATTERN,
)
from cohortweave.functions.names import c, last_part, quoted
from cohortweave.functions.values import parsed_timestamp

_PII_NAME = re.compile(PII_NAME_PATTERN, re.IGNORECASE)
_DATE_NAME = re.compile(DATE_NAME_PATTERN, re.IGNORECASE)
_INDEX_SUFFIX = re.compile(r"_\d+$")


def is_identifier(name: str) -> bool:
    """True for a column whose name gives an explicit identifier away."""
    part = last_part(name).lower()
    bare = _INDEX_SUFFIX.sub("", part.removeprefix(NONSTANDARD_PREFIX))
    return part in EXPLICIT_IDENTIFIERS or bare in EXPLICIT_IDENTIFIERS or bool(_PII_NAME.search(part))


def drop_identifiers(keep: Collection[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Drop identifier columns; `keep` names columns (or variables) that stay although they match."""

    def apply(df: DataFrame) -> DataFrame:
        kept = [n for n in df.columns if n in keep or last_part(n) in keep or not is_identifier(n)]
        return df.selectExpr(*[quoted(name) for name in kept])

    return apply


def is_capped_age(name: str) -> bool:
    """True for a column whose name stands for a participant's age."""
    lowered = name.lower()
    return "age" in lowered and "participant" in lowered


def cap_ages(df: DataFrame) -> DataFrame:
    """Numeric participant ages above the limit become the cap."""
    columns = []
    for field in df.schema:
        value = quoted(field.name)
        if is_capped_age(field.name) and isinstance(field.dataType, T.NumericType):
            cap = f"CAST({AGE_CAP_VALUE} AS {field.dataType.simpleString()})"
            value = f"CASE WHEN {value} > {AGE_CAP_ABOVE} THEN {cap} ELSE {value} END AS {value}"
        columns.append(value)
    return df.selectExpr(*columns)


def is_birth(name: str) -> bool:
    """True for a column whose name stands for a date of birth."""
    part = last_part(name).lower()
    return bool(_DATE_NAME.search(part)) and "duration" not in part and ("birth" in part or "dob" in part)


def undated_births(df: DataFrame, names: Mapping[str, Column] | None = None) -> set[str]:
    """Birth columns of text in which no value reads as a date, found by one aggregate.

    `names` may give the text columns to test as name -> value instead of the table's own.
    """
    if names is None:
        texts = [f for f in df.schema if is_birth(f.name) and isinstance(f.dataType, T.StringType)]
        names = {f.name: c(f.name) for f in texts}
    if not names:
        return set()
    counts = df.agg(
        *[F.count(parsed_timestamp(v, T.StringType())).alias(f"_{i}") for i, v in enumerate(names.values())]
    ).first()
    return {name for i, name in enumerate(names) if counts[i] == 0}


def birth_years(df: DataFrame, undated: Collection[str] | None = None) -> DataFrame:
    """Birth dates become years. Text columns in which nothing reads as a date stay as they are.

    Pass `undated` if those columns are known, to save the pass over the table that finds them.
    """
    undated = undated_births(df) if undated is None else undated
    dates = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    births = {
        f.name: f.dataType for f in df.schema
        if is_birth(f.name) and isinstance(f.dataType, dates) and f.name not in undated
    }
    years = {n: F.year(parsed_timestamp(c(n), data_type)).cast("long") for n, data_type in births.items()}
    return df.withColumns(years) if years else df


def deidentify(
    keep: Collection[str] = (), undated: Collection[str] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Drop identifiers, cap ages, truncate birth dates: projections only, no shuffle."""
    return lambda df: (
        df.transform(drop_identifiers(keep)).transform(cap_ages).transform(lambda d: birth_years(d, undated))
    )
