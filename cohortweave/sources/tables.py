"""Sinks and readers of the harmonized tier, the cohort and the registry."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import CLINICAL_NA, KEYS, MODALITY
from cohortweave.functions.names import c, quoted, underscored
from cohortweave.operators import lattice
from cohortweave.operators.variables import categorical_levels
from cohortweave.sources.bronze import nulls_for_tokens


# How many values of each kind the columns of a batch hold, beside its rows.
_TYPES = "_types"
# Every write is a batch of its own, a folder below the modality that a repeated write replaces.
BATCH = "_batch"


def write_silver(df: DataFrame, path: str, mode: str = "append", *, open_text: Collection[str] = (), batch: str | None = None) -> None:
    """Harmonized rows, one folder per modality so that readers of one modality skip the others.

    Numbers and truth values are stored as text, and what the columns hold is counted while they are
    written: batches whose values differ are read together. `open_text` names text columns whose values
    have no type yet, as those of CSV files. A batch that is written again replaces itself; without a name
    every write is a batch of its own. Columns without any type are left out.
    """
    batch = batch or uuid.uuid4().hex
    kinds = [f for f in df.schema if not isinstance(f.dataType, T.NullType)]
    listed = T.StructType([f for f in kinds if f.name != MODALITY])
    found_kinds = lattice.open_kinds(listed, open_text)
    held = {name: f"_kind_{i}" for i, name in enumerate(found_kinds)}
    counts = lattice.tallies(listed, open_text, {name: c(n) for name, n in held.items()})
    texts = [c(f.name).cast("string").alias(f.name) if lattice.is_loose(f.dataType) else c(f.name) for f in kinds]
    seen = Observation()
    counted = df.select(*[c(f.name) for f in kinds], *[k.alias(held[name]) for name, k in found_kinds.items()])
    if counts:
        counted = counted.observe(seen, *[n.alias(f"_{i}") for i, n in enumerate(counts.values())])
    writer = counted.select(*texts, F.lit(batch).alias(BATCH)).write.partitionBy(MODALITY, BATCH)
    if mode == "append":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)
    found = seen.get if counts else {}
    rows: dict[str, dict[str, int]] = {}
    for i, (name, kind) in enumerate(counts):
        rows.setdefault(name, dict.fromkeys(lattice.KINDS, 0))[kind] = int(found.get(f"_{i}") or 0)
    sums = df.sparkSession.createDataFrame([(n, *k.values()) for n, k in rows.items()], lattice.TALLY_DDL)
    sums.coalesce(1).write.mode("overwrite").json(f"{path}/{_TYPES}/{batch}")


def silver_types(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Type of each column over all batches of harmonized tables; columns not named are text or never changed."""
    return lattice.merged(spark.read.schema(lattice.TALLY_DDL).json([f"{p}/{_TYPES}/*" for p in paths]))


def read_silver(
    spark: SparkSession, path: str, tokens: Iterable[str] = CLINICAL_NA, types: Mapping[str, str] | None = None
) -> DataFrame:
    """Harmonized rows of all modalities; columns a modality lacks are null.

    A column has the narrowest type that holds the values of all batches: integers become fractions
    where a batch found some, anything else that differs is text. `types` may come from more tables.
    """
    raw = nulls_for_tokens(spark.read.option("mergeSchema", True).parquet(path).drop(BATCH), tokens)
    return with_types(raw, silver_types(spark, [path]) if types is None else types)


def with_types(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as the types that their values have."""
    texts = {f.name for f in raw.schema if isinstance(f.dataType, T.StringType)}
    return raw.selectExpr(*[
        f"try_cast({quoted(n)} AS {types[n]}) AS {quoted(n)}" if n in types and n in texts else quoted(n) for n in raw.columns
    ])


def write_gold(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cohort table as Parquet."""
    df.write.mode(mode).parquet(path)


def read_gold(spark: SparkSession, path: str, tokens: Iterable[str] = CLINICAL_NA) -> DataFrame:
    return nulls_for_tokens(spark.read.parquet(path), tokens)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Wide cohort, long observations or redacted rows as CSV files with a header."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_registry(registry: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Registry in one folder per modality, and its categorical levels as a lookup table."""
    renamed = registry.toDF(*underscored(registry.columns))
    renamed.write.mode(mode).partitionBy("modality").parquet(f"{path}/variables")
    categorical_levels(renamed).write.mode(mode).parquet(f"{path}/categorical_lookups")


def read_registry(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(variables, categorical lookups)."""
    return spark.read.parquet(f"{path}/variables"), spark.read.parquet(f"{path}/categorical_lookups")


def first_rows(df: DataFrame, n: int = 10, order_by: Sequence[str] = KEYS) -> DataFrame:
    """The first rows of a table in key order."""
    return df.orderBy(*[c(o) for o in order_by if o in df.columns]).limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.select(F.lit(1)).count(), len(df.columns)
