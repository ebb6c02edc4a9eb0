"""Redaction and noise by registry datatype."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import NOISY_DATATYPES, REDACTED_DATE, REDACTED_NAME
from cohortweave.functions.names import c
from cohortweave.functions.values import laplace, missing_nan


def datatypes(registry: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Registry datatype of each of the given columns that the registry maps.

    The result has at most one entry per column. A sensitive datatype wins over others when
    the registry lists a variable more than once.
    """
    rows = (
        registry.filter(c("original_variable_name").isin(list(columns)))
        .groupBy("original_variable_name")
        .agg(
            F.coalesce(
                F.min(F.when(F.startswith("datatype", F.lit("pii")), c("datatype"))), F.min("datatype")
            ).alias("datatype")
        )
    )
    return {row["original_variable_name"]: row["datatype"] for row in rows.collect()}


def redacted(value: Column, datatype: str) -> Column:
    """Redaction text for names and dates; other values pass through."""
    if datatype == "pii_name":
        return F.lit(REDACTED_NAME)
    if datatype == "pii_date":
        return F.lit(REDACTED_DATE)
    return value


def sensitivities(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Largest minus smallest value of each column, in one aggregate."""
    if not columns:
        return {}
    values = {n: missing_nan(c(n), df.schema[n].dataType).cast("double") for n in columns}
    row = df.agg(*[(F.max(v) - F.min(v)).alias(f"_{i}") for i, v in enumerate(values.values())]).first()
    return {n: row[i] for i, n in enumerate(values) if row[i] is not None}


def add_noise(
    df: DataFrame, columns: Sequence[str], epsilon: float, *, seed: str, row_key: Sequence[str] | None = None
) -> DataFrame:
    """Laplace noise of scale range/epsilon on numeric columns; constant columns are unchanged.

    Without `row_key` the noise comes from Spark's random generator, whose draws depend on how
    rows are partitioned. With a unique `row_key` it is a keyed hash and can be replayed.
    """
    scales = {n: range_ / epsilon for n, range_ in sensitivities(df, columns).items() if range_ != 0}
    key = [c(k) for k in row_key] if row_key else None
    return df.select(
        *[
            (c(n).cast("double") + laplace(scales[n], seed=seed, row_key=key, column=n)).alias(n)
            if n in scales
            else c(n)
            for n in df.columns
        ]
    )


def redact(
    registry: DataFrame, epsilon: float = 0.1, *, seed: str, row_key: Sequence[str] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Redact names and dates, add noise to measurements, and keep only columns the registry maps."""

    def apply(df: DataFrame) -> DataFrame:
        types = datatypes(registry, df.columns)
        numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
        noisy = [n for n in df.columns if n in numeric and types.get(n) in NOISY_DATATYPES]
        noised = add_noise(df, noisy, epsilon, seed=seed, row_key=row_key)
        return noised.select(
            *[redacted(c(n), types[n] or "").alias(n) for n in df.columns if n in types]
        )

    return apply
