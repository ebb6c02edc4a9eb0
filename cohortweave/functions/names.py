"""Column names: quoting, splitting and normalising.

Tables of thousands of columns are projected with SQL text, which the driver builds much faster
than as many column objects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name in SQL text; dots and spaces in it are not paths."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def c(name: str) -> Column:
    """The column with exactly this name; dots and spaces in it are not paths."""
    return F.col(quoted(name))


def last_part(name: str) -> str:
    """The part of a qualified column name behind its last dot."""
    return name.rpartition(".")[2]


def split_qualified(name: str) -> tuple[str, str]:
    """(modality, variable) of a qualified column name, split at its first dot."""
    modality, _, variable = name.partition(".")
    return modality, variable


def snake(text: Column, hyphens: bool = False) -> Column:
    """Lower case with spaces (and optionally hyphens) as underscores."""
    return F.translate(F.lower(text), " -", "__") if hyphens else F.translate(F.lower(text), " ", "_")


def underscored(names: list[str]) -> list[str]:
    """Column names with spaces replaced, for sinks that reject spaces."""
    return [name.replace(" ", "_") for name in names]
