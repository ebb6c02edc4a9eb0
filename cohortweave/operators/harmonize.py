"""Original column names -> registry names."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.constants import NONSTANDARD_PREFIX, SOURCE, SYSTEM_FIELDS
from cohortweave.functions.names import c


def registry_names(
    registry: DataFrame, columns: Sequence[str], order_by: str = "standard_name"
) -> tuple[dict[str, str], set[str]]:
    """(original -> standard name, known names) for the given columns.

    Of several standard names the registry's last row by `order_by` decides. A column is known
    if it is an original or a standard name. One aggregate whose result is bounded by the number
    of columns, however large the registry is.
    """
    original, standard = c("original_variable_name"), c("standard_name")
    target = F.when(
        (original != "") & (standard != "") & (original != standard),
        F.struct(c(order_by).alias("order"), standard.alias("standard_name")),
    )
    names = registry.select(
        F.inline(F.array(
            F.struct(original.alias("name"), target.alias("target")),
            F.struct(standard.alias("name"), F.when(F.lit(False), target).alias("target")),
        ))
    )
    found = names.filter(c("name").isin(list(columns))).groupBy("name").agg(F.max("target").alias("target")).collect()
    return {r["name"]: r["target"]["standard_name"] for r in found if r["target"]}, {r["name"] for r in found}


def harmonize(registry: DataFrame, order_by: str = "standard_name") -> Callable[[DataFrame], DataFrame]:
    """Rename mapped columns and prefix unknown ones; a projection with no shuffle.

    Columns mapped to one standard name are merged: the first that has a value wins.
    """

    def apply(df: DataFrame) -> DataFrame:
        mapping, listed = registry_names(registry, df.columns, order_by)
        known = listed | set(SYSTEM_FIELDS) | {SOURCE}
        sources: dict[str, list[str]] = {}
        for name in df.columns:
            target = mapping.get(name) or (name if name in known else NONSTANDARD_PREFIX + name)
            sources.setdefault(target, []).append(name)

        types = {f.name: f.dataType for f in df.schema}
        columns = []
        for target, names in sources.items():
            same_type = len({types[n] for n in names}) == 1
            parts = [c(n) if same_type else c(n).cast("string") for n in names]
            columns.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(target))
        return df.select(*columns)

    return apply
