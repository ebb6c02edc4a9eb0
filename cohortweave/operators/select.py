"""Rows and columns of the wide cohort table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import HASH, KEYS, NONSTANDARD_PREFIX, PARTICIPANT
from cohortweave.functions.names import c, quoted, split_qualified
from cohortweave.operators.flatten import CHUNK, is_chunked
from cohortweave.operators.lookups import lookup_join

logger = logging.getLogger(__name__)

# Longer participant lists are joined instead of written into the filter.
IN_LIST = 1_000

_OPERATORS: dict[str, Callable[[Column, Any], Column]] = {
    ">": lambda column, value: column > value,
    "<": lambda column, value: column < value,
    "==": lambda column, value: column == value,
    "contains": lambda column, value: column.cast("string").rlike("(?i)" + str(value)),
}


def _comparable(column: Column, kind: T.DataType, operator: str, value: Any) -> Column:
    """Text compared with a number counts by the number it spells, and never matches where it spells none."""
    is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return column.try_cast("double") if is_number and operator != "contains" and isinstance(kind, T.StringType) else column


def only_participants(df: DataFrame, participants: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the given participants: names, or a table with a participant column.

    No names means no filter.
    """
    if PARTICIPANT not in df.columns:
        return df
    if isinstance(participants, DataFrame):
        return lookup_join(df, participants.select(PARTICIPANT).distinct(), [PARTICIPANT], how="left_semi")
    if not participants:
        return df
    if len(participants) <= IN_LIST:
        return df.filter(c(PARTICIPANT).isin(list(participants)))
    listed = df.sparkSession.createDataFrame([(p,) for p in set(participants)], f"{PARTICIPANT} string")
    return lookup_join(df, listed, [PARTICIPANT], how="left_semi")


def _located(df: DataFrame, name: str) -> tuple[str, int | None] | None:
    """(column, chunk) of a variable of the wide form: record i of a chunked table stands in chunk i div width."""
    base, _, index = name.rpartition("_")
    if not base or not index.isdigit() or f"{base}_0" not in df.columns:
        return (name, None) if name in df.columns else None
    start = f"{base}_"
    width = sum(n.startswith(start) and n[len(start) :].isdigit() for n in df.columns)
    return f"{base}_{int(index) % width}", int(index) // width


def matching(df: DataFrame, filters: Mapping[str, tuple[str, Any]]) -> DataFrame:
    """Rows whose subject and session satisfy all `column: (operator, value)` conditions; null never does.

    Indexed columns count the records of the whole subject and session. Where these take several
    rows, conditions are tested on the row that holds the record and combined per subject and
    session, whose rows are all kept or all dropped.

    Operators are '>', '<', '==' and 'contains' (a regular expression, ignoring case). A column
    that does not exist is skipped with a warning.
    """
    conditions = []
    chunked = is_chunked(df)
    for name, (operator, value) in filters.items():
        found = _located(df, name) if chunked else (name, None) if name in df.columns else None
        if found is None:
            logger.warning("Column %s not found; condition skipped.", name)
            continue
        if operator not in _OPERATORS:
            raise ValueError(f"unknown operator {operator!r}; known: {sorted(_OPERATORS)}")
        column, chunk = found
        condition = _OPERATORS[operator](_comparable(c(column), df.schema[column].dataType, operator, value), value)
        conditions.append(condition if chunk is None else condition & (c(CHUNK) == chunk))
    if not conditions:
        return df
    if not chunked:
        return df.filter(reduce(lambda a, b: a & b, conditions))
    keys = [k for k in KEYS if k in df.columns]
    met = [F.max(F.coalesce(x, F.lit(False))).alias(f"_met_{i}") for i, x in enumerate(conditions)]
    per_key = df.groupBy(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(*met).filter(
        reduce(lambda a, b: a & b, [F.col(f"_met_{i}") for i in range(len(met))])
    )
    same = reduce(lambda a, b: a & b, [c(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(per_key, same, "left_semi")


def _select(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    existing = set(df.columns)
    return df.selectExpr(*[quoted(n) for n in dict.fromkeys(wanted) if n in existing])


def only_modalities(df: DataFrame, modalities: Sequence[str] | None) -> DataFrame:
    """Columns of the named modalities, with keys and hash."""
    if not modalities:
        return df
    found = [n for m in modalities for n in df.columns if n.startswith(f"{m}.")]
    return _select(df, [*KEYS, CHUNK, HASH, *found])


def only_variables(df: DataFrame, variables: Sequence[str] | None) -> DataFrame:
    """Columns whose name contains one of the terms, ignoring case, with the keys."""
    if not variables:
        return df
    found = [n for v in variables for n in df.columns if v.lower() in n.lower()]
    return _select(df, [*KEYS, CHUNK, *found])


def without_nonstandard(df: DataFrame) -> DataFrame:
    """Drop columns that the registry does not know."""
    return _select(df, [n for n in df.columns if NONSTANDARD_PREFIX not in n])


def without_empty(df: DataFrame) -> DataFrame:
    """Drop columns without any value, found by one aggregate; a table without rows keeps its columns."""
    used = df.selectExpr(
        "count(1) AS _rows", *[f"max({quoted(n)} IS NOT NULL) AS _{i}" for i, n in enumerate(df.columns)]
    ).first()
    if used["_rows"] == 0:
        return df
    return _select(df, [n for i, n in enumerate(df.columns) if used[f"_{i}"]])


def catalog(df: DataFrame) -> DataFrame:
    """(modality, variable) of every qualified column."""
    pairs = [split_qualified(n) for n in df.columns if "." in n]
    return df.sparkSession.createDataFrame(pairs, "modality string, variable string")


def to_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object; nulls are written out."""
    return df.selectExpr("to_json(struct(*), map('ignoreNullFields', 'false')) AS record")
