"""The cohort as arrays of records: as many columns as modalities, however long a group is.

A row holds up to `RECORDS_PER_ROW` records of each modality; longer groups go on in further rows,
counted by `_chunk`. Wide names (`<modality>.<variable>` for a single record, `…_<i>` for record i of
several) are array accesses here, so conditions, statistics and exports plan only the names they ask for.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import AGE_CAP_ABOVE, AGE_CAP_VALUE, HASH, KEYS
from cohortweave.functions.names import c, literal, quoted, split_qualified
from cohortweave.functions.values import parsed_timestamp, text_sql
from cohortweave.operators.deidentify import is_birth, is_capped_age, is_identifier
from cohortweave.operators.flatten import CHUNK, Layout, is_chunked, widen
from cohortweave.operators.select import matching

RECORDS_PER_ROW = 4_096
# Name of the column that says whether a subject and session has records of a modality.
PRESENT = "_modality"
# Columns of `long_values` beside the keys.
LONG = {"modality": "STRING", "variable": "STRING", "record": "BIGINT", "value": "STRING"}


def _record(data_type: T.DataType) -> T.StructType | None:
    """Fields of the records that a column of this type holds."""
    is_records = isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType)
    return data_type.elementType if is_records else None


def records_of(df: DataFrame) -> dict[str, list[T.StructField]]:
    """Fields of each modality's records; empty for a wide table."""
    found = {field.name: _record(field.dataType) for field in df.schema}
    return {name: [f for f in record if f.name != "_slot"] for name, record in found.items() if record is not None}


def is_nested(df: DataFrame) -> bool:
    return CHUNK in df.columns and bool(records_of(df))


def marked(nested: DataFrame, layout: Layout) -> DataFrame:
    """The table with its row width noted beside `_chunk`, where a stored table keeps it."""
    return nested.withMetadata(CHUNK, {"chunked": layout.chunked, "width": dict(layout.width)})


def layout_of(nested: DataFrame) -> Layout:
    """Layout of a nested table as `marked` noted it."""
    noted = nested.schema[CHUNK].metadata
    variables = {m: [f.name for f in fields] for m, fields in records_of(nested).items()}
    return Layout(variables, {m: noted["width"][m] for m in variables}, is_chunked(nested))


def record_hash(nested: DataFrame, keys: Sequence[str] = KEYS) -> Column:
    """SHA-256 over keys and records: modalities and variables in name order, records in their own.

    Variables are separated by `|`, records by `;`, keys and modalities by `#`. Unlike the hash of the wide
    form it does not change with the width of other groups.
    """
    parts = [text_sql(quoted(k), nested.schema[k].dataType) for k in keys]
    for modality, fields in sorted(records_of(nested).items()):
        texts = [text_sql(f"r.{quoted(f.name)}", f.dataType) for f in sorted(fields, key=lambda f: f.name)]
        joined = f"concat_ws('|', {', '.join(texts)})" if texts else "''"
        parts.append(f"array_join(transform({quoted(modality)}, r -> {joined}), ';')")
    return F.expr(f"sha2(concat_ws('#', {', '.join(parts)}), 256)")


def deidentify_records(
    nested: DataFrame, keep: Collection[str] = (), undated: Collection[str] = ()
) -> DataFrame:
    """Records without identifiers, with capped ages and years of birth, as in the wide form.

    A variable goes if its wide name would, with an index or without. `keep` and `undated` hold
    variables or `<modality>.<variable>`. A modality of which nothing is left keeps its records' number.
    """

    def value(modality: str, field: T.StructField, record: Column) -> Column:
        name, found = f"{modality}.{field.name}", record[field.name]
        dates = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
        if is_capped_age(name) and isinstance(field.dataType, T.NumericType):
            found = F.when(found > AGE_CAP_ABOVE, F.lit(AGE_CAP_VALUE).cast(field.dataType)).otherwise(found)
        elif is_birth(name) and isinstance(field.dataType, dates) and name not in undated:
            found = F.year(parsed_timestamp(found, field.dataType)).cast("long")
        return found.alias(field.name)

    def kept(modality: str, field: T.StructField) -> bool:
        name = f"{modality}.{field.name}"
        return name in keep or field.name in keep or not (is_identifier(name) or is_identifier(f"{name}_0"))

    def cleaned(modality: str, fields: Sequence[T.StructField]) -> Column:
        left = [f for f in fields if kept(modality, f)]
        # A record without variables still counts, as its place.
        return F.transform(c(modality), lambda r, i: F.struct(
            *[value(modality, f, r) for f in left] or [i.alias("_slot")]
        )).alias(modality)

    records = records_of(nested)
    plain = [n for n in nested.columns if n in (*KEYS, CHUNK, HASH) or n not in records and not is_identifier(n)]
    return nested.select(*[c(n) for n in plain], *[cleaned(m, fields) for m, fields in records.items()])


@dataclass(frozen=True)
class _Place:
    """Where a wide name stands: a variable of a modality, and the record's number among several."""

    modality: str
    variable: str
    index: int | None


def _place(records: Mapping[str, Sequence[T.StructField]], name: str) -> _Place | None:
    for modality in sorted(records, key=len, reverse=True):  # modalities may have dots
        if not name.startswith(f"{modality}."):
            continue
        variable = name[len(modality) + 1 :]
        names = {f.name for f in records[modality]}
        if variable == PRESENT or variable in names:
            return _Place(modality, variable, None)
        base, _, index = variable.rpartition("_")
        if base in names and index.isdigit():
            return _Place(modality, base, int(index))
    return None


def _value_sql(layout: Layout, place: _Place) -> str:
    """Array access for a wide name; only the variable itself is read, also for the number of records."""
    if place.variable == PRESENT:
        return f"CASE WHEN size({quoted(place.modality)}) > 0 THEN {literal(place.modality)} END"
    values = f"{quoted(place.modality)}.{quoted(place.variable)}"
    single = f"({CHUNK} = 0 AND size({values}) = 1)"
    if place.index is None:
        return f"CASE WHEN {single} THEN get({values}, 0) END"
    width = layout.width[place.modality]
    here = f"{CHUNK} = {place.index // width} AND NOT {single}"
    return f"CASE WHEN {here} THEN get({values}, {place.index % width}) END"


def columns_of(nested: DataFrame, names: Iterable[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys and the named wide columns, one row per subject and session; unknown names are left out.

    A projection where each group is one row. Otherwise rows that hold none of the records are
    skipped, and the few values are combined per subject and session by a partial aggregate.
    """
    records, layout = records_of(nested), layout_of(nested)
    places = {n: p for n in dict.fromkeys(names) if (p := _place(records, n)) is not None}
    columns = [f"{_value_sql(layout, place)} AS {quoted(name)}" for name, place in places.items()]
    if not is_chunked(nested):
        return nested.selectExpr(*[quoted(k) for k in keys], *columns)
    # Every group has its first row, and modalities with few records have nothing beyond it.
    chunks = {0} | {p.index // layout.width[p.modality] for p in places.values() if p.index is not None}
    rows = nested.filter(c(CHUNK).isin(sorted(chunks))).selectExpr(*[quoted(k) for k in keys], *columns)
    found = [F.first(c(name), ignorenulls=True).alias(name) for name in places] or [F.count(F.lit(1)).alias("_rows")]
    return rows.groupBy(*[c(k) for k in keys]).agg(*found).select(*[c(n) for n in (*keys, *places)])


def matching_records(
    nested: DataFrame, filters: Mapping[str, tuple[str, Any]], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Rows whose subject and session satisfy conditions on wide names; see `operators.select.matching`."""
    asked = columns_of(nested, filters, keys)
    found = matching(asked, filters)
    if found is asked:
        return nested
    same = reduce(lambda a, b: a & b, [c(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    if is_chunked(nested):
        return nested.join(found.select(*[c(k).alias(f"_k{i}") for i, k in enumerate(keys)]), same, "left_semi")
    records, layout = records_of(nested), layout_of(nested)
    values = [
        f"{_value_sql(layout, p)} AS {quoted(n)}" for n in filters if (p := _place(records, n)) is not None
    ]
    return matching(nested.selectExpr("*", *values), filters).select(*[c(n) for n in nested.columns])


def record_rows(
    nested: DataFrame, modality: str, variables: Sequence[str] | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row per record of a modality: keys, `_record` (its number in the subject and session), variables.

    This is the form for statistics over all records; only the variables asked for are read.
    """
    names = [f.name for f in records_of(nested)[modality] if variables is None or f.name in variables]
    if not names:
        raise ValueError(f"no such variables in {modality!r}: {variables}")
    arrays = F.arrays_zip(*[F.col(f"{quoted(modality)}.{quoted(n)}").alias(n) for n in names])
    first = c(CHUNK) * F.lit(layout_of(nested).width[modality])
    exploded = nested.select(*[c(k) for k in keys], first.alias("_first"), F.posexplode(arrays).alias("_at", "_values"))
    values = [F.col("_values").getField(n).alias(n) for n in names]
    return exploded.select(*[c(k) for k in keys], (F.col("_first") + F.col("_at")).alias("_record"), *values)


def long_values(nested: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per present value: keys, modality, variable, record number, value as text.

    The form for exports of groups of any length. NaN counts as missing.
    """
    layout, cells = layout_of(nested), []
    for modality, fields in records_of(nested).items():
        for f in fields:
            text = text_sql("x", f.dataType, missing="NULL")
            cells.append(
                f"transform({quoted(modality)}.{quoted(f.name)}, (x, i) -> named_struct("
                f"'modality', {literal(modality)}, 'variable', {literal(f.name)}, "
                f"'record', CAST({CHUNK} * {layout.width[modality]} + i AS BIGINT), 'value', {text}))"
            )
    if not cells:
        return nested.selectExpr(*[quoted(k) for k in keys]).limit(0).selectExpr(
            "*", *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in LONG.items()]
        )
    present = f"filter(flatten(array({', '.join(cells)})), v -> v.value IS NOT NULL)"
    return nested.selectExpr(*[quoted(k) for k in keys], f"inline({present})")


def wide_form(nested: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """All wide columns of a nested table: for groups that are short enough to be columns."""
    return widen(nested, layout_of(nested), keys)


def variable_catalog(nested: DataFrame) -> DataFrame:
    """(modality, variable) of the records, without indexes."""
    pairs = [(m, f.name) for m, fields in records_of(nested).items() for f in (*fields, T.StructField(PRESENT, T.StringType()))]
    return nested.sparkSession.createDataFrame(pairs, "modality string, variable string")


def positions_beside(nested: DataFrame, target: str) -> list[str]:
    """Wide names at the target's own record number, and those of modalities with single records."""
    place = _place(records_of(nested), target)
    index = "" if place is None or place.index is None else f"_{place.index}"
    names = [f"{m}.{f.name}" for m, fields in records_of(nested).items() for f in fields]
    return list(dict.fromkeys([target, *names, *[f"{n}{index}" for n in names]]))
