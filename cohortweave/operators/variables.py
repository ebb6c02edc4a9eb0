"""Registry work: search, code lookups, categorical levels and validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.constants import (
    DATATYPE_MESSAGE,
    FUZZY_CUTOFF,
    FUZZY_MATCHES,
    LOINC_MESSAGE,
    LOINC_PATTERN,
    OMOP_MESSAGE,
    REGISTRY_DATATYPES,
    REQUIRED_REGISTRY_COLUMNS,
    SCHEMA_MESSAGE,
)
from cohortweave.functions.names import c
from cohortweave.functions.text import edit_similarity
from cohortweave.operators.lookups import first_per_key, lookup_join
from cohortweave.sources.workspace import stored

# Grams are counted per slot of their hash.
GRAM_SLOTS = 1 << 12
_SLACK = 1e-6  # against rounding of fractions of lengths; lets too much through, never too little


def close_matches(
    df: DataFrame,
    column: str,
    keyword: str,
    n: int = FUZZY_MATCHES,
    cutoff: float = FUZZY_CUTOFF,
) -> DataFrame:
    """(name, rows, score) of the names most similar to the keyword, best first, ties by later name.

    Similarity is one less the edit distance as a share of the longer text; equal names are scored
    once. Rows count: repeated names use up places among the `n` best.
    """
    names = df.filter(c(column).isNotNull()).groupBy(c(column).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    scored = names.withColumn("score", edit_similarity(c("name"), F.lit(keyword)))
    return scored.filter(c("score") >= cutoff).orderBy(F.desc("score"), F.desc("name")).limit(n)


def close_matches_of(
    df: DataFrame,
    column: str,
    keywords: DataFrame,
    keyword: str = "keyword",
    n: int = FUZZY_MATCHES,
    cutoff: float = FUZZY_CUTOFF,
) -> DataFrame:
    """(keyword, name, rows, score): for each distinct keyword its `n` most similar names, as `close_matches`.

    An exact join through an index of q-grams. An edit changes at most q of a text's q-grams, so texts as similar
    as `cutoff` share a number of them that grows with the longer one, and at least one among the rarest of each:
    only these are indexed, and pairs that meet there are compared if their lengths allow it. The rarest go by
    counts per hash slot; the order of grams changes the work, never the result. Only pairs that are similar are
    shuffled. Null and empty texts match nothing.
    """
    if not 0 < cutoff <= 1:
        raise ValueError("the cutoff must be above 0 and at most 1")
    edits = 1 - cutoff  # as a share of the longer text
    q = 4 if edits <= 0.25 else int(1 / edits + _SLACK)

    def present(name: str) -> Column:
        return F.length(c(name)) > 0

    def grams(text: Column) -> Column:
        pad = "\x01" * (q - 1)
        padded = F.concat(F.lit(pad), text, F.lit(pad))
        starts = F.sequence(F.lit(1), F.length(text) + (q - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(padded, i, F.lit(q))))

    names = stored(df.filter(present(column)).groupBy(c(column).alias("name")).agg(F.count(F.lit(1)).alias("rows")), "names")
    asked = keywords.filter(present(keyword)).select(c(keyword).alias("keyword")).distinct()
    slot = F.col("gram").bitwiseAND(F.lit(GRAM_SLOTS - 1)).cast("int")
    counts = dict(names.select(F.explode(grams(c("name"))).alias("gram")).groupBy(slot).count().collect())  # at most GRAM_SLOTS
    frequency = F.split(F.lit(",".join(str(counts.get(i, 0)) for i in range(GRAM_SLOTS))), ",").cast("array<bigint>")

    def rarest(text: Column) -> Column:
        shared = F.ceil(F.length(text) * (1 - q * edits) + (q - 1) - _SLACK)
        kept = F.length(text) + q - F.greatest(shared, F.lit(1))
        ordered = F.array_sort(
            F.transform(
                grams(text),
                lambda g: F.struct(F.get(frequency, g.bitwiseAND(F.lit(GRAM_SLOTS - 1)).cast("int")).alias("n"), g.alias("g")),
            )
        )
        return F.array_distinct(F.slice(ordered, F.lit(1), kept.cast("int")).getField("g"))

    index = names.select("name", "rows", F.explode(rarest(c("name"))).alias("_gram"))
    wanted = asked.select("keyword", F.explode(rarest(c("keyword"))).alias("_gram"))
    longest = F.greatest(F.length("name"), F.length("keyword"))
    allowed = F.floor(longest * edits + _SLACK).cast("int")
    met = lookup_join(index, wanted, ["_gram"], how="inner").filter(F.abs(F.length("name") - F.length("keyword")) <= allowed)
    near = met.filter(F.call_function("levenshtein", c("name"), c("keyword"), allowed) >= 0)  # -1 beyond what is allowed
    pairs = near.select("keyword", "name", "rows").distinct().withColumn("score", edit_similarity(c("name"), c("keyword")))
    best = Window.partitionBy("keyword").orderBy(F.desc("score"), F.desc("name"))
    return pairs.filter(c("score") >= cutoff).withColumn("_place", F.row_number().over(best)).filter(c("_place") <= n).drop("_place")


def search_variables(
    registry: DataFrame,
    keyword: str | None = None,
    search_column: str = "standard_name",
    output_column: str = "original_variable_name",
    fuzzy: bool = True,
) -> DataFrame:
    """Distinct variable names whose search column matches the keyword (a regular expression).

    Without a keyword, all names. If nothing matches, the most similar names are used instead.
    """
    if not keyword:
        return registry.select(c(output_column)).distinct()
    strict = registry.filter(c(search_column).rlike("(?i)" + keyword))
    if fuzzy and strict.isEmpty():
        best = close_matches(registry, search_column, keyword).withColumn(
            "_before", F.sum("rows").over(Window.orderBy(F.desc("score"), F.desc("name"))) - F.col("rows")
        )  # a handful of names
        strict = registry.join(best.filter(F.col("_before") < FUZZY_MATCHES), c(search_column) == F.col("name"), "left_semi")
    return strict.select(c(output_column)).distinct()


def standard_names_by_code(
    df: DataFrame,
    registry: DataFrame,
    code: str,
    registry_code: str = "loinc_code",
    *,
    output: str = "standard_name",
    order_by: Sequence[str] = ("standard_name",),
    once: bool = False,
) -> DataFrame:
    """Add the registry's standard name for a code column; the first row by `order_by` decides. `once` as in `lookup_join`."""
    listed = registry.filter(c(registry_code).isNotNull()).select(
        c(registry_code).cast("string").alias(code), *[c(n) for n in dict.fromkeys(["standard_name", *order_by])]
    )
    first = first_per_key(listed, [code], order_by).select(code, c("standard_name").alias(output))
    return lookup_join(df.withColumn(code, c(code).cast("string")), first, [code], once=once)


def categorical_labels(
    df: DataFrame, lookups: DataFrame, standard_name: str, code: str, *, output: str = "label"
) -> DataFrame:
    """Add the label of each (standard name, code) pair."""
    listed = lookups.select(c("standard_name").alias(standard_name), c("code").alias(code), c("label").alias(output))
    first = first_per_key(listed, [standard_name, code], [output])
    return lookup_join(df.withColumn(code, c(code).cast("string")), first, [standard_name, code])


def categorical_levels(registry: DataFrame) -> DataFrame:
    """(standard_name, code, label) for every `code=label` item of the registry's level lists.

    Single quotes are read as double quotes; lists that do not parse and items without '=' are
    left out.
    """
    items = F.from_json(F.replace(c("levels"), F.lit("'"), F.lit('"')), "array<string>")
    return (
        registry.filter(c("levels").isNotNull() & (c("levels") != "[]"))
        .select("standard_name", F.explode(items).alias("item"))
        .filter(F.contains("item", F.lit("=")))
        .select(
            "standard_name",
            F.trim(F.split("item", "=", 2)[0]).alias("code"),
            F.trim(F.split("item", "=", 2)[1]).alias("label"),
        )
    )


def is_valid_loinc(code: Column) -> Column:
    """Missing, blank or digits-dash-digit."""
    return code.isNull() | (code == "") | code.rlike(LOINC_PATTERN)


def _is_integer(value: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return value.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$")
    return F.lit(True)


def registry_violations(registry: DataFrame) -> DataFrame:
    """(variable, rule, message) of everything wrong with a registry; empty means valid."""
    spark = registry.sparkSession
    missing = [n for n in REQUIRED_REGISTRY_COLUMNS if n not in registry.columns]
    schema_rows = [(None, "schema", SCHEMA_MESSAGE % ", ".join(missing))] if missing else []
    schema = spark.createDataFrame(schema_rows, "variable string, rule string, message string")

    def column(name: str) -> Column:
        return c(name) if name in registry.columns else F.lit(None).cast("string")

    variable = F.coalesce(column("original_variable_name").cast("string"), F.lit("nan"))
    loinc, omop, datatype = column("loinc_code").cast("string"), column("omop_concept_id"), column("datatype")
    omop_type = registry.schema["omop_concept_id"].dataType if "omop_concept_id" in registry.columns else T.NullType()

    def violation(broken: Column, rule: str, message: str, value: Column) -> Column:
        text = F.format_string(message, variable, F.coalesce(value.cast("string"), F.lit("nan")))
        return F.when(broken, F.struct(variable.alias("variable"), F.lit(rule).alias("rule"), text.alias("message")))

    found = F.array(
        violation(~is_valid_loinc(loinc), "loinc", LOINC_MESSAGE, loinc),
        violation(omop.isNotNull() & ~_is_integer(omop, omop_type), "omop", OMOP_MESSAGE, omop),
        violation(
            datatype.isNull() | ~datatype.isin(list(REGISTRY_DATATYPES)), "datatype", DATATYPE_MESSAGE, datatype
        ),
    )
    return schema.unionByName(registry.select(F.inline(F.array_compact(found))))
