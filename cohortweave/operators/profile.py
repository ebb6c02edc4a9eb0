"""Quality profile of every column of every file, and the reports built on it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import (
    LOW_COMPLETENESS,
    LOW_COMPLETENESS_MESSAGE,
    MODALITY,
    NONSTANDARD_PREFIX,
    OUTLIER_MESSAGE,
    OUTLIER_Z,
    SAMPLE_VALUES,
    SOURCE,
    UNKNOWN_MODALITY,
)
from cohortweave.functions.names import c
from cohortweave.functions.paths import file_name, subject_of
from cohortweave.functions.text import is_na_like
from cohortweave.functions.values import missing_nan
from cohortweave.operators.lookups import lookup_join
from cohortweave.sources.workspace import stored

# Texts of up to this many bytes are grouped as they are, longer ones by digest.
SHORT_TEXT = 64


def is_numeric(data_type: T.DataType) -> bool:
    """Booleans count as numbers in a profile."""
    return isinstance(data_type, (T.NumericType, T.BooleanType))


def _number(field: T.StructField) -> Column:
    return missing_nan(c(field.name), field.dataType).cast("double")


def _same_keys(left: Sequence[str], prefix: str = "_g") -> list[Column]:
    return [c(name).eqNullSafe(c(f"{prefix}{i}")) for i, name in enumerate(left)]


def _marked(df: DataFrame, keys: Sequence[str], prefix: str = "_g") -> DataFrame:
    return df.select(
        *[c(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)], *[c(n) for n in df.columns if n not in keys]
    )


def column_profile(df: DataFrame, group: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per group and column: counts, completeness and, for numbers, range, mean and spread.

    All columns are measured by one aggregate per group and turned into rows afterwards, so the
    data is neither multiplied by its columns nor shuffled whole.
    """
    fields = _profiled(df, group, columns)
    measures = []
    for i, field in enumerate(fields):
        measures.append(F.count(missing_nan(c(field.name), field.dataType)).alias(f"_n{i}"))
        if is_numeric(field.dataType):
            x = _number(field)
            measures += [
                F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"),
                F.avg(x).alias(f"_mean{i}"), F.stddev_samp(x).alias(f"_std{i}"),
            ]
    wide = df.groupBy(*[c(g) for g in group]).agg(F.count(F.lit(1)).alias("_rows"), *measures)

    def record(i: int, field: T.StructField) -> Column:
        n = c(f"_n{i}")
        numeric = is_numeric(field.dataType)
        none = F.lit(None).cast("double")
        return F.struct(
            F.lit(field.name).alias("column"),
            F.lit(i).alias("position"),
            F.lit(field.dataType.simpleString()).alias("dtype"),
            n.alias("non_null_count"),
            (c("_rows") - n).alias("null_count"),
            F.bround(n / c("_rows"), 3).alias("completeness"),
            F.lit(not field.name.startswith(NONSTANDARD_PREFIX)).alias("is_standard_field"),
            (c(f"_min{i}") if numeric else none).alias("min"),
            (c(f"_max{i}") if numeric else none).alias("max"),
            (F.bround(c(f"_mean{i}"), 4) if numeric else none).alias("mean"),
            (F.when(n > 0, F.bround(F.coalesce(c(f"_std{i}"), F.lit(0.0)), 4)) if numeric else none).alias("std"),
        )

    return wide.select(
        *[c(g) for g in group], F.inline(F.array(*[record(i, field) for i, field in enumerate(fields)]))
    )


def _profiled(df: DataFrame, group: Sequence[str], columns: Sequence[str] | None) -> list[T.StructField]:
    names = columns if columns is not None else [n for n in df.columns if n not in (*group, MODALITY, SOURCE)]
    return [df.schema[n] for n in names]


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def outlier_counts(
    df: DataFrame, group: Sequence[str], columns: Sequence[str] | None = None, **lookup: int
) -> DataFrame:
    """Values more than three standard deviations from the mean of their group and column.

    Only for more than two values that differ; other columns have no row. Means and deviations
    come back to the rows through a checked lookup join, which spreads hot groups; `lookup` goes to it.
    """
    fields = [f for f in _profiled(df, group, columns) if is_numeric(f.dataType)]
    if not fields:
        return df.sparkSession.createDataFrame([], f"{_ddl(df, group)}, column string, outlier_count bigint")
    numbers = df.select(*[c(g) for g in group], *[_number(f).alias(f"_x{i}") for i, f in enumerate(fields)])
    stats = numbers.groupBy(*[c(g) for g in group]).agg(
        *[
            F.struct(F.count(f"_x{i}").alias("n"), F.avg(f"_x{i}").alias("mean"), F.stddev_samp(f"_x{i}").alias("std"))
            .alias(f"_s{i}")
            for i in range(len(fields))
        ]
    )
    joined = lookup_join(numbers, stored(stats, "group-statistics"), group, null_safe=True, **lookup)

    def is_outlier(i: int) -> Column:
        return F.abs((c(f"_x{i}") - c(f"_s{i}").getField("mean")) / c(f"_s{i}").getField("std")) > OUTLIER_Z

    def applies(i: int) -> Column:
        return (c(f"_s{i}").getField("n") > 2) & (c(f"_s{i}").getField("std") > 0)

    counted = joined.groupBy(*[c(g) for g in group]).agg(
        *[F.sum(F.when(applies(i), F.when(is_outlier(i), 1).otherwise(0))).alias(f"_o{i}") for i in range(len(fields))]
    )
    rows = F.array(
        *[F.struct(F.lit(f.name).alias("column"), c(f"_o{i}").alias("outlier_count")) for i, f in enumerate(fields)]
    )
    return counted.select(*[c(g) for g in group], F.inline(rows)).filter("outlier_count IS NOT NULL")


def categorical_profile(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    samples: int = SAMPLE_VALUES,
) -> DataFrame:
    """Distinct count, missing-like count and first distinct values of text columns per group.

    Equal values are combined before the shuffle, long ones as their 128-bit digest, so that what is shuffled does
    not grow with the length of texts. "First" follows `order_by` (the value itself if not given; equal places go by
    the value). Only samples that are long texts are fetched again, from the rows where they stand first.
    """
    fields = [f for f in _profiled(df, group, columns) if not is_numeric(f.dataType)]
    keys = [*group, "column"]
    if not fields:
        measures = "unique_values bigint, na_like_values bigint, sample_values array<string>"
        return df.sparkSession.createDataFrame([], f"{_ddl(df, group)}, column string, {measures}")
    # A single column keeps the aggregate a hash aggregate; several make it sort.
    order = [c(o) for o in order_by or ()]
    position = F.lit(0) if not order else order[0] if len(order) == 1 else F.struct(*order)
    cells = df.select(
        *[c(g) for g in group],
        position.alias("_seq"),
        F.inline(
            F.array(*[F.struct(F.lit(f.name).alias("column"), c(f.name).cast("string").alias("value")) for f in fields])
        ),
    ).filter("value IS NOT NULL")
    is_short = F.octet_length("value") <= SHORT_TEXT
    told_apart = cells.select(
        *[c(k) for k in keys], "value",
        (c("_seq") if order else F.left("value", F.lit(SHORT_TEXT))).alias("_seq"),
        F.when(is_short, c("value")).alias("_text"),
        F.when(~is_short, F.unhex(F.md5("value"))).alias("_digest"),
    )
    identity = [*keys, "_text", "_digest"]
    # Without an order the place of a value is part of the value.
    measures = [F.count(F.lit(1)).alias("_rows"), F.sum(is_na_like(c("value")).cast("long")).alias("_na")]
    if order:
        grouped = told_apart.groupBy(*[c(k) for k in identity]).agg(*measures, F.min("_seq").alias("_seq"))
    else:
        grouped = told_apart.groupBy(*[c(k) for k in identity], "_seq").agg(*measures)
    values = stored(grouped, "distinct-values")
    counts = values.groupBy(*[c(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("unique_values"), F.sum("_na").alias("na_like_values")
    )
    texts = values.select(*[c(k) for k in keys], "_seq", c("_text").alias("value"))
    if not values.filter("_digest IS NOT NULL").isEmpty():
        place = [*keys, "_digest", "_seq"]
        ranked = values.withColumn("_rank", F.rank().over(Window.partitionBy(*[c(k) for k in keys]).orderBy("_seq")))
        wanted = stored(
            ranked.filter((c("_rank") <= samples) & c("_digest").isNotNull()).select(*[c(k) for k in place]), "long-samples"
        )
        rows = told_apart.filter("_digest IS NOT NULL").drop("_text")
        found = lookup_join(rows, wanted, place, how="left_semi", null_safe=True)
        fetched = found.groupBy(*[c(k) for k in place]).agg(F.min("value").alias("value"))
        texts = texts.filter("value IS NOT NULL").unionByName(fetched.select(*[c(k) for k in keys], "_seq", "value"))
    first = Window.partitionBy(*[c(k) for k in keys]).orderBy("_seq", "value")
    picked = (
        texts.withColumn("_rank", F.row_number().over(first))
        .filter(c("_rank") <= samples)
        .groupBy(*[c(k) for k in keys])
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "value"))).alias("_picked"))
        .withColumn("sample_values", c("_picked").getField("value"))
        .drop("_picked")
    )
    return _extend(counts, picked, keys)


def _extend(profile: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two summaries, one row per group and column each."""
    joined = profile.join(_marked(part, keys), _same_keys(keys), "left")
    return joined.drop(*[f"_g{i}" for i in range(len(keys))])


def profile_with_outliers(
    df: DataFrame, group: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """`column_profile` with outlier counts: what quality issues need."""
    return _extend(column_profile(df, group, columns), outlier_counts(df, group, columns), [*group, "column"])


def full_profile(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """`column_profile` with outliers and categorical measures."""
    with_outliers = profile_with_outliers(df, group, columns)
    return _extend(with_outliers, categorical_profile(df, group, columns, order_by), [*group, "column"])


def overall_completeness(profile: DataFrame, group: Sequence[str]) -> DataFrame:
    """Mean of the rounded completeness values of a group's columns, in exact decimals."""
    mean = F.avg(c("completeness").cast("decimal(4,3)"))
    return profile.groupBy(*[c(g) for g in group]).agg(F.bround(mean, 3).cast("double").alias("overall_completeness"))


def quality_issues(profile: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per issue: low completeness first, then outliers, in column order."""
    percent = F.bround(c("completeness") * 100).cast("int")
    rules = F.array(
        F.when(
            c("completeness") < LOW_COMPLETENESS,
            F.struct(F.lit("completeness").alias("rule"),
                     F.format_string(LOW_COMPLETENESS_MESSAGE, percent, c("column")).alias("message")),
        ),
        F.when(
            c("outlier_count") > 0,
            F.struct(F.lit("outliers").alias("rule"),
                     F.format_string(OUTLIER_MESSAGE, c("outlier_count"), c("column")).alias("message")),
        ),
    )
    return profile.select(
        *[c(g) for g in group], "column", "position", F.inline(F.array_compact(rules))
    )


def representative_modality(df: DataFrame, file: str, order_by: Sequence[str]) -> DataFrame:
    """(file, modality) with the modality of each file's first row."""
    order = F.struct(*[c(o) for o in order_by])
    return df.groupBy(c(file)).agg(F.min_by(c(MODALITY), order).alias(MODALITY))


def with_modality_filter(df: DataFrame, modality: str | None) -> DataFrame:
    """Rows of one modality; on a partitioned table only its partition is read."""
    return df if modality is None else df.filter(c(MODALITY) == modality)


def modality_subjects(df: DataFrame, file: str) -> DataFrame:
    """(modality, subject) pairs; a table, because a modality may have any number of subjects."""
    return (
        df.select(F.coalesce(c(MODALITY), F.lit(UNKNOWN_MODALITY)).alias(MODALITY), c(file))
        .distinct()
        .select(MODALITY, subject_of(file_name(c(file))).alias("subject_id"))
        .filter("subject_id IS NOT NULL")
        .distinct()
    )


def modality_report(df: DataFrame, file: str, modality: str | None = None) -> DataFrame:
    """Records, files and distinct subjects per modality."""
    per_file = (
        with_modality_filter(df, modality)
        .groupBy(F.coalesce(c(MODALITY), F.lit(UNKNOWN_MODALITY)).alias(MODALITY), c(file))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_subject", subject_of(file_name(c(file))))
    )
    per_subject = per_file.groupBy(MODALITY, "_subject").agg(
        F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_files")
    )
    return per_subject.groupBy(MODALITY).agg(
        F.sum("_rows").alias("total_records"),
        F.sum("_files").alias("file_count"),
        F.count("_subject").alias("unique_subjects"),
    )


def null_summary(df: DataFrame) -> DataFrame:
    """Nulls per column that has any, with the shape of the table."""
    nulls = [
        F.struct(F.lit(n).alias("column"), F.count_if(c(n).isNull()).alias("null_count")) for n in df.columns
    ]
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*nulls).alias("_nulls"))
        .select("row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"), F.inline("_nulls"))
        .filter("null_count > 0")
    )


def _listed(values: Column, spell: Callable[[Column], Column]) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(values, spell), ", "), F.lit("]"))


def _json_text(value: Column) -> Column:
    in_list = F.to_json(F.array(value))
    return F.substring(in_list, F.lit(2), F.length(in_list) - 2)


def _quoted(value: Column) -> Column:
    quote = F.when(F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"')), F.lit('"')).otherwise(F.lit("'"))
    return F.concat(quote, value, quote)


def suggest_metadata(
    df: DataFrame,
    sample_rows: int = 5,
    order_by: Sequence[str] | None = None,
    *,
    ratio_above: int = 10,
    max_levels: int = 10,
    vocabulary: str = "",
) -> DataFrame:
    """Registry skeleton for the columns of a table, from a sample of its first rows.

    The sample is the feature: measurement level, levels and examples come from `sample_rows`
    rows. `order_by` fixes which rows are first.
    """
    fields = [f for f in df.schema if f.name not in (SOURCE,)]
    order = [c(o) for o in order_by] if order_by else [F.lit(0)]
    sample = (df.orderBy(*order) if order_by else df).limit(sample_rows)
    numbered = sample.select(F.struct(*order).alias("_seq"), *[c(f.name).cast("string").alias(f.name) for f in fields])
    gathered = numbered.agg(F.array_sort(F.collect_list(F.struct("_seq", *[c(f.name) for f in fields]))).alias("_rows"))

    def record(field: T.StructField) -> Column:
        values = F.array_distinct(F.array_compact(c("_rows").getField(field.name)))
        numeric = isinstance(field.dataType, (T.IntegralType, T.FloatType, T.DoubleType))
        datatype = (
            F.when(F.size(values) > ratio_above, F.lit("ratio")).otherwise(F.lit("ordinal"))
            if numeric
            else F.lit("nominal")
        )
        levels = F.when(datatype == "ratio", F.lit("[]")).otherwise(_listed(F.slice(values, 1, max_levels), _json_text))
        blank = ("loinc_code", "sdtm_variable", "accession_id", "hed_tags")
        more = ("cde_id", "phenx_id", "umls_cui")
        standard = field.name.lower().replace(" ", "_").replace("-", "_")
        return F.struct(
            F.lit(field.name).alias("original_variable_name"),
            F.lit(standard).alias("standard_name"),
            *[F.lit("").alias(n) for n in blank],
            F.lit("0").alias("omop_concept_id"),
            *[F.lit("").alias(n) for n in more],
            datatype.alias("datatype"),
            levels.alias("levels"),
            F.lit("").alias("units"),
            F.lit(f"Auto-generated suggestion for {field.name}").alias("description"),
            F.lit("unknown").alias("modality"),
            F.lit(vocabulary).alias("vocabulary"),
            _listed(F.slice(values, 1, 3), (lambda v: v) if numeric else _quoted).alias("sample_values"),
        )

    return gathered.select(F.inline(F.array(*[record(f) for f in fields])))
