"""Column types as counts, so that files, batches, runs and modalities can be told apart and put together.

A column of text may turn out to hold integers, fractions or truth values. How many of each it holds adds
up over any cut of the data; the type is decided from the sums when the column is read.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.names import c

KINDS = ("integers", "fractions", "truths", "others")
TALLY_DDL = "name string, " + ", ".join(f"{kind} bigint" for kind in KINDS)

_INTEGER = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# How text spells truth values.
_TRUTHS = ("True", "TRUE", "true", "False", "FALSE", "false")


def is_loose(kind: T.DataType) -> bool:
    """Whether a column of this type may meet other types of the same name."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.StringType))


def kind_of(value: Column, kind: T.DataType, open_text: bool) -> Column:
    """Which of KINDS a value is, null for null. Text counts by what it spells if it is open, else as other."""
    if isinstance(kind, T.IntegralType):
        spelled = F.lit("integers")
    elif isinstance(kind, T.NumericType):
        spelled = F.lit("fractions")
    elif isinstance(kind, T.BooleanType):
        spelled = F.lit("truths")
    elif open_text:
        whole = value.rlike(_INTEGER) & value.try_cast("bigint").isNotNull()
        spelled = (
            F.when(whole, F.lit("integers")).when(value.rlike(_NUMBER), F.lit("fractions"))
            .when(value.isin(*_TRUTHS), F.lit("truths")).otherwise(F.lit("others"))
        )
    else:
        spelled = F.lit("others")
    return F.when(value.isNotNull(), spelled)


def tallies(schema: T.StructType, open_text: Collection[str] = (), kinds: Mapping[str, Column] | None = None) -> dict[tuple[str, str], Column]:
    """(column, kind) -> how many values of the column are of the kind, for one aggregate over the table.

    `kinds` has columns that hold the kinds of `open_kinds` already.
    """
    counts = {}
    for f in schema:
        if is_loose(f.dataType):
            kind = (kinds or {}).get(f.name)
            kind = kind_of(c(f.name), f.dataType, f.name in open_text) if kind is None else kind
            possible = KINDS if isinstance(f.dataType, T.StringType) and f.name in open_text else [_only(f.dataType)]
            counts |= {(f.name, k): F.count_if(kind == k) for k in possible}
    return counts


def open_kinds(schema: T.StructType, open_text: Collection[str]) -> dict[str, Column]:
    """The kind of each value of open text, to be projected before it is counted: a count per kind would find it anew."""
    return {f.name: kind_of(c(f.name), f.dataType, True) for f in schema if isinstance(f.dataType, T.StringType) and f.name in open_text}


def _only(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "integers"
    if isinstance(kind, T.NumericType):
        return "fractions"
    return "truths" if isinstance(kind, T.BooleanType) else "others"


def agreed(integers: int, fractions: int, truths: int, others: int) -> str | None:
    """The narrowest type that holds all counted values; None means text.

    Integers and fractions are fractions; anything else that differs stays text.
    """
    if others or (truths and (integers or fractions)):
        return None
    if truths:
        return "boolean"
    if fractions:
        return "double"
    return "bigint" if integers else None


def merged(counted: DataFrame) -> dict[str, str]:
    """Type of each column that is not text, from the tallies of any number of parts. One row per column is collected."""
    sums = counted.groupBy("name").agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in KINDS])
    found = {r["name"]: agreed(*[r[k] for k in KINDS]) for r in sums.collect()}
    return {name: kind for name, kind in found.items() if kind}
