"""Raw files -> DataFrames: CSV, Parquet and JSON, all files of a kind in one read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import PARTICIPANT, RAW_NA, SESSION, SOURCE
from cohortweave.functions.names import c, literal, quoted
from cohortweave.functions.paths import default_participant, default_session, file_name, plain, stem
from cohortweave.operators import lattice
from cohortweave.operators.lookups import lookup_join
from cohortweave.sources.bundles import BUNDLE_DDL
from cohortweave.sources.workspace import listing


def plain_path(path: Column) -> Column:
    """File path without URL escapes, as other listings spell it."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def source_of_row() -> Column:
    """(file, block, row): orders the rows of a file as they stand in it."""
    return F.struct(
        plain_path(c("_metadata").getField("file_path")).alias("file"),
        c("_metadata").getField("file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(SOURCE)


def _token_test(value: str, tokens: Iterable[str]) -> str:
    """Null where a text is a token, as SQL text."""
    return f"CASE WHEN NOT ({value} IN ({', '.join(map(literal, tokens))})) THEN {value} END"


def nulls_for_tokens(df: DataFrame, tokens: Iterable[str] = RAW_NA) -> DataFrame:
    """Missing-value tokens in text columns become null."""
    listed = list(tokens)
    return df.selectExpr(*[
        f"{_token_test(quoted(f.name), listed)} AS {quoted(f.name)}" if isinstance(f.dataType, T.StringType) else quoted(f.name)
        for f in df.schema
    ])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the given columns; values that do not fit become null."""
    return df.select(*[c(n).try_cast(types[n]).alias(n) if n in types else c(n) for n in df.columns])


def infer_types(df: DataFrame) -> dict[str, str]:
    """Type of each text column whose values are all integers, numbers or truth values.

    One aggregate over the table; the result has one entry per column.
    """
    texts = T.StructType([f for f in df.schema if isinstance(f.dataType, T.StringType)])
    counts = lattice.tallies(texts, texts.names)
    if not counts:
        return {}
    found = df.agg(*[n.alias(f"_{i}") for i, n in enumerate(counts.values())]).first()
    by_name: dict[str, dict[str, int]] = {}
    for i, (name, kind) in enumerate(counts):
        by_name.setdefault(name, {})[kind] = found[i]
    return {name: kind for name, of in by_name.items() if (kind := lattice.agreed(**of))}


def typed(df: DataFrame, types: Mapping[str, str] | None, tokens: Iterable[str] = RAW_NA) -> DataFrame:
    """Nulls for tokens, then the given types, or inferred ones if none are given."""
    cleaned = nulls_for_tokens(df, tokens)
    return cast_columns(cleaned, infer_types(cleaned) if types is None else types)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    *,
    tokens: Iterable[str] = RAW_NA,
    multi_line: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV files of one layout with a header. Pass `types` to save the inference pass.

    `multi_line` allows line breaks inside quotes, at the price of files that cannot be split. A
    record with more fields than the header is left out; `csv_bad_records` lists it.
    """
    raw = _raw_csv(spark, paths, multi_line, options)
    good = raw.filter(~_too_long(raw)).drop(_CORRUPT)
    return typed(good, types, tokens)


def csv_bad_records(
    spark: SparkSession, paths: str | Sequence[str], *, multi_line: bool = True, options: Mapping[str, str] | None = None
) -> DataFrame:
    """(file, record, parsed) of the records that have more fields than the header of their file.

    `parsed` is what the columns of the header would hold, as JSON.
    """
    raw = _raw_csv(spark, paths, multi_line, options)
    columns = [c(n) for n in raw.columns if n not in (_CORRUPT, SOURCE)]
    return raw.filter(_too_long(raw)).select(
        c(SOURCE).getField("file").alias("file"), c(_CORRUPT).alias("record"), F.to_json(F.struct(*columns)).alias("parsed")
    )


_CORRUPT = "_corrupt_record"


def _raw_csv(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool, options: Mapping[str, str] | None
) -> DataFrame:
    """All columns as text, with the record itself where its number of fields is not the header's."""
    settings = {"header": True, "escape": '"', "multiLine": multi_line, "enforceSchema": False, **(options or {})}
    with listing(spark):
        names = [f for f in spark.read.options(**settings).csv(paths).schema]
        schema = T.StructType([*(T.StructField(f.name, T.StringType()) for f in names), T.StructField(_CORRUPT, T.StringType())])
        raw = spark.read.options(**settings, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT).schema(schema).csv(paths)
    return raw.select(*[c(n) for n in raw.columns], source_of_row())


def _too_long(raw: DataFrame) -> Column:
    """Whether a record has a field beyond the last column; shorter ones are only filled with nulls."""
    width = len(raw.columns) - 2
    wider = ", ".join(f"f{i} string" for i in range(width + 1))
    beyond = F.from_csv(c(_CORRUPT), wider, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}).getField(f"f{width}")
    return F.coalesce(c(_CORRUPT).isNotNull() & beyond.isNotNull(), F.lit(False))


def csv_layouts(spark: SparkSession, paths: str | Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """(header line, file) of CSV files, so that files of different layouts can be read apart."""
    with listing(spark):
        lines = spark.read.options(**(options or {})).text(paths).select("value", source_of_row())
    return (
        lines.filter(c(SOURCE).getField("block") == 0)
        .groupBy(c(SOURCE).getField("file").alias("file"))
        .agg(F.min_by("value", c(SOURCE).getField("row")).alias("header"))
    )


# Columns of a CSV record beyond those of its file, so that one that is too long shows.
_SPARE = 2


def csv_files(
    files: DataFrame, columns: Sequence[str], sources: Sequence[str], *, tokens: Iterable[str] = RAW_NA,
    options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV files of any layouts, all columns as text, and the records with more fields than their header.

    `files` has (path, names): the columns of each file, in order. One scan of `sources` reads them all;
    each row takes its columns from where its file has them, and null for those that it lacks. Files
    that are not listed are left out.
    """
    spark = files.sparkSession
    width = (files.agg(F.max(F.size("names"))).first()[0] or 0) + _SPARE
    fields = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*fields, _CORRUPT)])
    settings = {"header": True, "escape": '"', "multiLine": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    with listing(spark):
        raw = spark.read.options(**settings, **(options or {})).schema(schema).csv(list(sources))
    wide = raw.select(F.array(*fields).alias("_values"), c(_CORRUPT), source_of_row())
    listed = ", ".join(map(literal, columns))
    known = files.select(
        plain(c("path")).alias("_key"), F.size("names").alias("_width"),
        F.expr(f"transform(array({listed}), n -> CAST(array_position(names, n) AS INT) - 1)").alias("_places"),
    )
    placed = lookup_join(wide.withColumn("_key", plain(c(SOURCE).getField("file"))), known, ["_key"], how="inner")
    beyond = F.exists(F.slice("_values", c("_width") + 1, F.lit(width)), lambda x: x.isNotNull())
    # A place of -1 is none.
    values = [f"CASE WHEN _places[{i}] >= 0 THEN get(_values, _places[{i}]) END" for i in range(len(columns))]
    rows = placed.filter(~beyond).selectExpr(*[f"{v} AS {quoted(n)}" for v, n in zip(values, columns)], SOURCE)
    named = F.expr(f"to_json(named_struct({', '.join(f'{literal(n)}, {v}' for v, n in zip(values, columns))}))")
    record = F.coalesce(c(_CORRUPT), F.concat_ws(",", "_values"))
    bad = placed.filter(beyond).select(c(SOURCE).getField("file").alias("file"), record.alias("record"), named.alias("parsed"))
    return nulls_for_tokens(rows, tokens), bad


def only_files(df: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of the listed files (path)."""
    listed = files.select(plain(c("path")).alias("_key")).distinct()
    return lookup_join(df.withColumn("_key", plain(c(SOURCE).getField("file"))), listed, ["_key"], how="left_semi").drop("_key")


def apart(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that could be read, and the others with their file."""
    if _CORRUPT not in raw.columns:
        nothing = raw.sparkSession.createDataFrame([], "file string, record string, parsed string")
        return raw, nothing
    columns = [c(n) for n in raw.columns if n not in (_CORRUPT, SOURCE)]
    bad = raw.filter(c(_CORRUPT).isNotNull()).select(
        c(SOURCE).getField("file").alias("file"), c(_CORRUPT).alias("record"),
        (F.to_json(F.struct(*columns)) if columns else F.lit(None).cast("string")).alias("parsed"),
    )
    return raw.filter(c(_CORRUPT).isNull()).drop(_CORRUPT), bad


def read_parquet(spark: SparkSession, paths: str | Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """Parquet files, columns as stored."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    with listing(spark):
        raw = spark.read.options(mergeSchema=True, **(options or {})).parquet(*listed)
    return raw.select(*[c(n) for n in raw.columns], source_of_row())


def _document_schema(texts: DataFrame, options: Mapping[str, str] | None = None) -> T.StructType:
    """The schema that documents (value) have together."""
    unmarked = texts.select(F.regexp_replace("value", "^\uFEFF", "").alias("value"))
    return texts.sparkSession.read.options(**(options or {})).json(unmarked.rdd.map(lambda r: r["value"])).schema


def parse_documents(documents: DataFrame, schema: str | None = None) -> DataFrame:
    """Rows of documents (path, content), one object each, as `read_json` has them. With a schema, the inference pass is saved.

    The file is a column here, so any number of documents costs the driver nothing.
    """
    found = _document_schema(documents.select(c("content").alias("value"))) if schema is None else T.StructType.fromDDL(schema)
    fields = T.StructType([*found, *([] if len(found) else [T.StructField("_none", T.StringType())])])
    # A file of broken characters is no document; Spark's reader of files finds this, `from_json` does not.
    broken = F.struct(*[(c("content") if f.name == _CORRUPT else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    parsed = F.when(F.is_valid_utf8("content"), F.from_json("content", fields)).otherwise(broken)
    source = F.struct(c("path").alias("file"), F.lit(0).cast("bigint").alias("block"), F.monotonically_increasing_id().alias("row"))
    # A blank file gives no row. The array keeps the parser out of filters, which would run it again.
    whole = documents.select(source.alias(SOURCE), F.filter(F.array(parsed), lambda x: x.isNotNull()).alias("_parsed"))
    return whole.select(SOURCE, F.inline("_parsed")).select(*[c(f.name) for f in found], SOURCE)


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType | None = None,
    *,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """JSON files with one object each. With a schema, the inference pass is saved.

    Types are inferred from the files as whole texts, because Spark's inference over files of many lines cuts its tasks by
    bytes alone: any number of small files would be one task.
    """
    with listing(spark):
        if schema is None:
            schema = _document_schema(spark.read.options(**(options or {})).text(paths, wholetext=True), options)
        reader = spark.read.options(multiLine=True, **(options or {}))
        raw = (reader.schema(schema) if len(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema) else reader).json(paths)
    return raw.select(*[c(n) for n in raw.columns], source_of_row())


def parse_bundles(documents: DataFrame, *, extra: str | None = None) -> DataFrame:
    """Clinical bundles of documents (path, content), as `read_bundles` has them."""
    return parse_documents(documents, f"{BUNDLE_DDL}, {extra}" if extra else BUNDLE_DDL)


def read_bundles(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    one_per_line: bool = False,
    extra: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Clinical bundles: one document per file, or one per line for bulk exports.

    `extra` declares further top-level fields of the documents to carry along; one named `_corrupt_record`
    takes the documents that do not have the expected form.
    """
    schema = f"{BUNDLE_DDL}, {extra}" if extra else BUNDLE_DDL
    with listing(spark):
        raw = spark.read.options(multiLine=not one_per_line, **(options or {})).schema(schema).json(paths)
    return raw.select(*[c(n) for n in raw.columns], source_of_row())


def with_default_keys(df: DataFrame, path: Column) -> DataFrame:
    """Add session and participant where the table has no such column, from each row's file name."""
    file_stem = stem(file_name(path))
    if SESSION not in df.columns:
        df = df.withColumn(SESSION, default_session(file_stem))
    if PARTICIPANT not in df.columns:
        df = df.withColumn(PARTICIPANT, default_participant(file_stem))
    return df
