"""Harmonized tier -> cohort: one row per subject and session, hashed and de-identified."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import HASH, KEYS, MODALITY, SOURCE, UNKNOWN_MODALITY
from cohortweave.functions.names import c
from cohortweave.functions.values import row_hash
from cohortweave.operators.deidentify import deidentify, is_birth, undated_births
from cohortweave.operators.flatten import CHUNK, Layout, hash_order, nest, variables_by_modality, widen
from cohortweave.operators.nested import RECORDS_PER_ROW, deidentify_records, marked, record_hash
from cohortweave.operators.ordering import HOT_FLOOR


def gold_nested(
    silver: DataFrame,
    order_by: Sequence[str] = (SOURCE,),
    variables: Mapping[str, Sequence[str]] | None = None,
    width: Mapping[str, int] | int | None = None,
    *,
    keys: Sequence[str] = KEYS,
    floor: int = HOT_FLOOR,
) -> tuple[DataFrame, Layout]:
    """Nested cohort: an ordered array of records per modality. See `operators.flatten.nest`."""
    layout = variables if variables is not None else variables_by_modality(
        silver, skip=[*keys, MODALITY, *order_by, SOURCE, "_plugin"]
    )
    return nest(silver, layout, order_by, width, keys=keys, floor=floor)


def build_gold(
    silver: DataFrame,
    order_by: Sequence[str] = (SOURCE,),
    variables: Mapping[str, Sequence[str]] | None = None,
    width: Mapping[str, int] | int | None = None,
    *,
    keys: Sequence[str] = KEYS,
    keep: Collection[str] = (),
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Wide cohort with provenance hash, without identifiers.

    Pass `variables` and `width` to save the passes that find them. The hash covers the values
    before identifiers are dropped. The grouping is the only shuffle; hash and de-identification
    are projections on its result.
    """
    nested, layout = gold_nested(silver, order_by, variables, width, keys=keys, floor=floor)
    wide = widen(nested, layout, keys)
    hashed = wide.withColumn(HASH, row_hash(hash_order(wide, keys)))
    if layout.chunked:
        hashed = _hash_of_all_chunks(hashed, keys)
    return hashed.transform(deidentify(keep, _undated(silver, layout)))


def build_nested(
    silver: DataFrame,
    order_by: Sequence[str] = (SOURCE,),
    variables: Mapping[str, Sequence[str]] | None = None,
    width: Mapping[str, int] | int = RECORDS_PER_ROW,
    *,
    keys: Sequence[str] = KEYS,
    keep: Collection[str] = (),
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Nested cohort with provenance hash, without identifiers: the form to store.

    Its columns are the modalities, so a group of any length can be planned; a row holds at most
    `width` records of each. `operators.nested` answers wide names, statistics and exports from it.
    """
    nested, layout = gold_nested(silver, order_by, variables, width, keys=keys, floor=floor)
    hashed = nested.withColumn(HASH, record_hash(nested, keys))
    if layout.chunked:
        hashed = _hash_of_all_chunks(hashed, keys)
    undated = _undated(silver, Layout(layout.variables, dict.fromkeys(layout.variables, 1)))
    return marked(deidentify_records(hashed, keep, undated), layout)


def _hash_of_all_chunks(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One hash per subject and session: of its chunks' hashes in order where it has several."""
    chunks = F.array_sort(F.collect_list(F.struct(CHUNK, HASH)).over(Window.partitionBy(*[c(k) for k in keys])))
    joined = F.array_join(F.transform(chunks, lambda x: x[HASH]), "")
    return wide.withColumn(HASH, F.when(F.size(chunks) > 1, F.sha2(joined, 256)).otherwise(c(HASH)))


def _undated(silver: DataFrame, layout: Layout) -> set[str]:
    """Wide names of text birth variables without any date, found in the harmonized rows.

    Testing the rows before they are grouped costs a scan of these columns only; a variable is
    tested as a whole, not each of its indexed columns.
    """
    of_modality = F.coalesce(c(MODALITY), F.lit(UNKNOWN_MODALITY))
    texts = {
        f"{modality}.{variable}": F.when(of_modality == modality, c(variable))
        for modality, names in layout.variables.items()
        for variable in names
        if is_birth(variable) and isinstance(silver.schema[variable].dataType, T.StringType)
    }
    undated = undated_births(silver, texts)
    return {name if slot is None else f"{name}_{slot}"
            for name in undated
            for slot in (None, *range(layout.width[name.partition(".")[0]]))}
