"""Many rows per subject and session -> one row with indexed columns, over all modalities at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.constants import HASH, KEYS, MODALITY, SOURCE, SYSTEM_FIELDS, UNKNOWN_MODALITY
from cohortweave.functions.names import c, literal, quoted
from cohortweave.operators.ordering import HOT_FLOOR, GroupSizes, measure_groups, row_index

# Position of a row of the wide form inside its subject-session: 0 unless a width was asked for that some group exceeds.
CHUNK = "_chunk"


@dataclass(frozen=True)
class Layout:
    """How modalities are laid out in a wide row: variables and indexed columns of each."""

    variables: Mapping[str, Sequence[str]]
    width: Mapping[str, int]
    # Whether some group has more records than a row holds.
    chunked: bool = False

    @property
    def modalities(self) -> list[str]:
        return list(self.variables)


def qualify(df: DataFrame, modality: str, skip: Sequence[str] = KEYS) -> DataFrame:
    """Prefix every column but the keys with its modality."""
    kept = [name for name in df.columns if name != MODALITY]
    renamed = [c(name) if name in skip else c(name).alias(f"{modality}.{name}") for name in kept]
    return df.select(*renamed, F.lit(modality).alias(f"{modality}._modality"))


def variables_by_modality(silver: DataFrame, skip: Sequence[str] = (*SYSTEM_FIELDS, SOURCE)) -> dict[str, list[str]]:
    """Columns that hold at least one value in each modality: one aggregate over the table."""
    candidates = [name for name in silver.columns if name not in skip]
    used = (
        silver.groupBy(F.coalesce(c(MODALITY), F.lit(UNKNOWN_MODALITY)).alias(MODALITY))
        .agg(*[F.max(c(name).isNotNull()).alias(f"_used_{i}") for i, name in enumerate(candidates)])
        .orderBy(MODALITY)
        .collect()
    )
    return {
        row[MODALITY]: [name for i, name in enumerate(candidates) if row[f"_used_{i}"]] for row in used
    }


def nest(
    silver: DataFrame,
    variables: Mapping[str, Sequence[str]],
    order_by: Sequence[str],
    width: Mapping[str, int] | int | None = None,
    *,
    keys: Sequence[str] = KEYS,
    floor: int = HOT_FLOOR,
) -> tuple[DataFrame, Layout]:
    """One row per subject and session with an ordered array of records per modality.

    Null keys form groups like any other value. All modalities are brought together by one
    grouping over one shuffle, which equals their full outer join on the keys. Without a width,
    every subject and session is one row, as wide as the largest group. A width is for storing very
    long groups: a group that exceeds it goes on in further rows, counted by `_chunk`, and
    `operators.select.matching` still answers per subject and session.
    """
    tagged = silver.withColumn(MODALITY, F.coalesce(c(MODALITY), F.lit(UNKNOWN_MODALITY))).filter(
        c(MODALITY).isin(list(variables))
    )
    group = [*keys, MODALITY]
    sizes = measure_groups(tagged, group, floor, by=MODALITY)
    widths = _widths(variables, sizes, width)
    layout = Layout(variables, widths, any(sizes.largest_by.get(m, 0) > w for m, w in widths.items()))

    indexed = row_index(tagged, group, order_by, sizes=sizes, distribute_by=keys)
    width_of = reduce(
        lambda chain, m: chain.when(c(MODALITY) == m, F.lit(layout.width[m])), layout.modalities, F
    )
    slotted = (
        indexed.withColumn("_width", width_of.cast("long"))
        .withColumn(CHUNK, F.expr("_index div _width"))
        .withColumn("_slot", F.pmod(F.col("_index"), F.col("_width")).cast("int"))
    )
    arrays = [
        F.array_sort(F.collect_list(F.when(c(MODALITY) == m, F.struct("_slot", *[c(v) for v in names]))))
        .alias(m)
        for m, names in variables.items()
    ]
    return slotted.groupBy(*[c(k) for k in keys], CHUNK).agg(*arrays), layout


def _widths(
    variables: Mapping[str, Sequence[str]], sizes: GroupSizes, width: Mapping[str, int] | int | None
) -> dict[str, int]:
    if isinstance(width, int):
        asked = dict.fromkeys(variables, width)
    elif width is not None:
        asked = dict(width)
    else:
        asked = dict(sizes.largest_by)
    # A width of one cannot tell the only row of a group from the first of several.
    return {m: 1 if sizes.largest_by.get(m, 0) <= 1 else max(2, asked.get(m, 2)) for m in variables}


def widen(nested: DataFrame, layout: Layout, keys: Sequence[str] = KEYS) -> DataFrame:
    """Wide form of `nest`: `<modality>.<variable>` for a single record, else `…_<i>` per record.

    Row `_chunk` = k holds the records k*width, k*width+1, … of its subject and session, and
    its indexed columns count from there.
    """
    columns: list[str] = []

    def add(condition: str, value: str, name: str) -> None:
        columns.append(f"CASE WHEN {condition} THEN {value} END AS {quoted(name)}")

    for modality, variables in layout.variables.items():
        records = quoted(modality)
        single = f"size({records}) = 1 AND {CHUNK} = 0"
        slots = range(layout.width[modality]) if layout.width[modality] > 1 else ()
        for variable in variables:
            add(single, f"get({records}, 0).{quoted(variable)}", f"{modality}.{variable}")
        for slot in slots:
            for variable in variables:
                add(f"NOT ({single})", f"get({records}, {slot}).{quoted(variable)}", f"{modality}.{variable}_{slot}")
        add(f"size({records}) > 0", literal(modality), f"{modality}._modality")
    return nested.selectExpr(*[quoted(k) for k in keys], CHUNK, *columns).withMetadata(CHUNK, {"chunked": layout.chunked})


def is_chunked(df: DataFrame) -> bool:
    """Whether a wide table may hold several rows of one subject and session."""
    return CHUNK in df.columns and bool(df.schema[CHUNK].metadata.get("chunked", True))


def hash_order(df: DataFrame, keys: Sequence[str] = KEYS) -> list:
    """Fields in the order in which the provenance hash reads them: keys, then sorted names."""
    fields = {field.name: field for field in df.schema if field.name not in (CHUNK, HASH)}
    return [fields[name] for name in (*keys, *sorted(set(fields) - set(keys)))]
