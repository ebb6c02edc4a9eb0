"""Quality profile, reports and registry suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.checks import query, table
from cohortweave.functions.names import c
from cohortweave.operators import profile
from cohortweave.operators.modalities import specimen_modality
from cohortweave.plans.report import QualityReport

GROUP = ("modality_category", "file")
NUMERIC = ("nonstandard_quantity", "price", "late_tax", "returned")
TEXTS = ("status", "flag")


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as harmonized rows: one file per supplier, modality by line status."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        c("l_linestatus").alias("modality_category"),
        F.concat(F.lit("x/sub-"), c("l_suppkey"), F.lit("_lines.csv")).alias("file"),
        c("l_orderkey").alias("seq_a"), c("l_linenumber").alias("seq_b"), c("l_extendedprice").alias("seq_c"),
        c("l_quantity").alias("nonstandard_quantity"),
        F.when(c("l_linenumber") == 7, c("l_extendedprice") * 50).otherwise(c("l_extendedprice")).alias("price"),
        F.when(c("l_returnflag") == "R", c("l_tax")).alias("late_tax"),
        (c("l_returnflag") == "R").alias("returned"),
        F.when(c("l_linenumber") != 1, c("l_linestatus")).alias("status"),
        F.when(c("l_linenumber") == 2, F.lit("N/A")).otherwise(c("l_returnflag")).alias("flag"),
    )


SQL_LINES = """
    SELECT l_linestatus AS modality_category, 'x/sub-' || l_suppkey || '_lines.csv' AS file,
           l_orderkey AS seq_a, l_linenumber AS seq_b, l_extendedprice AS seq_c, l_quantity AS nonstandard_quantity,
           CASE WHEN l_linenumber = 7 THEN l_extendedprice * 50 ELSE l_extendedprice END AS price,
           CASE WHEN l_returnflag = 'R' THEN l_tax END AS late_tax,
           l_returnflag = 'R' AS returned,
           CASE WHEN l_linenumber <> 1 THEN l_linestatus END AS status,
           CASE WHEN l_linenumber = 2 THEN 'N/A' ELSE l_returnflag END AS flag
    FROM lineitem
"""


def _measures(name: str) -> str:
    x = f"CAST({name} AS DOUBLE)"
    if name in NUMERIC:
        numbers = f"""min({x}) AS min, max({x}) AS max, round_even({{avg}}, 4) AS mean,
                      CASE WHEN count({name}) > 0 THEN round_even(coalesce(stddev_samp({x}), 0), 4) END AS std"""
        numbers = numbers.format(avg=f"avg({x})")
    else:
        numbers = "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS std"
    dtype = {"returned": "boolean", "status": "string", "flag": "string"}.get(name, "double")
    standard = "false" if name.startswith("nonstandard_") else "true"
    return f"""
        SELECT modality_category, file, '{name}' AS "column", '{dtype}' AS dtype, count({name}) AS non_null_count,
               count(*) - count({name}) AS null_count,
               round_even(count({name})::DOUBLE / count(*), 3) AS completeness, {standard} AS is_standard_field, {numbers}
        FROM lines GROUP BY modality_category, file"""


PROFILE_SQL = f"WITH lines AS ({SQL_LINES}) " + " UNION ALL ".join(_measures(n) for n in (*NUMERIC, *TEXTS))


def line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(measured(spark, sf_dir), GROUP, [*NUMERIC, *TEXTS])


@query(PROFILE_SQL)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_profile(spark, sf_dir).drop("position")


OUTLIER_SQL = f"WITH lines AS ({SQL_LINES}), " + """
    stats AS (
        SELECT modality_category, file, {stats} FROM lines GROUP BY modality_category, file),
    joined AS (SELECT * FROM lines JOIN stats USING (modality_category, file))
    {counts}
""".format(
    stats=", ".join(
        f"count({n}) AS n_{n}, avg(CAST({n} AS DOUBLE)) AS m_{n}, stddev_samp(CAST({n} AS DOUBLE)) AS s_{n}" for n in NUMERIC
    ),
    counts=" UNION ALL ".join(
        f"""SELECT modality_category, file, '{n}' AS "column",
                   count(*) FILTER (abs((CAST({n} AS DOUBLE) - m_{n}) / s_{n}) > 3) AS outlier_count
            FROM joined WHERE n_{n} > 2 AND s_{n} > 0 GROUP BY modality_category, file"""
        for n in NUMERIC
    ),
)


@query(OUTLIER_SQL)
def outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.outlier_counts(measured(spark, sf_dir), GROUP, [*NUMERIC, *TEXTS])


@query(OUTLIER_SQL)
def outliers_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As with more groups than are broadcast: hot groups are found and only they are cut into pieces."""
    return profile.outlier_counts(measured(spark, sf_dir), GROUP, [*NUMERIC, *TEXTS], max_rows=0)


def _categorical_sql(name: str) -> str:
    return f"""
        SELECT modality_category, file, '{name}' AS "column", count(*) AS unique_values,
               CAST(sum(n) FILTER (lower(v) IN ('n/a', 'na', 'none', 'null', '')) AS BIGINT) AS na_like,
               string_agg(v, '|' ORDER BY a, b, d, v) FILTER (r <= 2) AS sample_values
        FROM (
            SELECT *, row_number() OVER (PARTITION BY modality_category, file ORDER BY a, b, d, v) AS r FROM (
                SELECT modality_category, file, {name} AS v, count(*) AS n, min((seq_a, seq_b, seq_c)) AS k,
                       k[1] AS a, k[2] AS b, k[3] AS d
                FROM lines WHERE {name} IS NOT NULL GROUP BY modality_category, file, {name}))
        GROUP BY modality_category, file"""


@query(
    f"WITH lines AS ({SQL_LINES}), found AS ("
    + " UNION ALL ".join(_categorical_sql(n).replace("min((seq_a, seq_b, seq_c)) AS k", "min(row(seq_a, seq_b, seq_c)) AS k")
                         for n in TEXTS)
    + """) SELECT modality_category, file, "column", unique_values, coalesce(na_like, 0) AS na_like_values,
                  sample_values FROM found"""
)
def categorical_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.categorical_profile(
        measured(spark, sf_dir), GROUP, [*NUMERIC, *TEXTS], ["seq_a", "seq_b", "seq_c"], samples=2
    )
    return found.withColumn("sample_values", F.array_join("sample_values", "|"))


def _document_sql(name: str) -> str:
    return f"""
        SELECT lang, '{name}' AS "column", count(*) AS unique_values,
               CAST(sum(n) FILTER (lower(v) IN ('n/a', 'na', 'none', 'null', '')) AS BIGINT) AS na_like,
               md5(string_agg(v, '|' ORDER BY k, v) FILTER (r <= 5)) AS samples_md5
        FROM (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k, v) AS r FROM (
                SELECT lang, {name}::VARCHAR AS v, count(*) AS n, min(doc_id) AS k
                FROM documents WHERE {name} IS NOT NULL GROUP BY lang, v))
        GROUP BY lang"""


@query(f"""
    SELECT lang, "column", unique_values, coalesce(na_like, 0) AS na_like_values, samples_md5
    FROM ({_document_sql("text")} UNION ALL {_document_sql("source")})
""")
def categorical_profile_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of up to thousands of words: only their digests are shuffled."""
    found = profile.categorical_profile(table(spark, sf_dir, "documents"), ["lang"], ["text", "source"], ["doc_id"])
    return found.withColumn("samples_md5", F.md5(F.array_join("sample_values", "|"))).drop("sample_values")


COMPLETENESS_SQL = f"""
    WITH profile AS ({PROFILE_SQL})
    SELECT modality_category, file,
           round_even(sum(CAST(round(completeness * 1000) AS BIGINT))::DOUBLE / (1000 * count(*)), 3) AS overall_completeness
    FROM profile GROUP BY modality_category, file
"""


@query(COMPLETENESS_SQL)
def overall_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overall_completeness(line_profile(spark, sf_dir), GROUP)


@query(COMPLETENESS_SQL)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness out of the whole report: profile, outliers and categorical measures together."""
    return QualityReport(measured(spark, sf_dir), "file", order_by=["seq_a", "seq_b", "seq_c"]).completeness


@query(f"""
    WITH profile AS ({PROFILE_SQL}), outliers AS ({OUTLIER_SQL})
    SELECT modality_category, file, "column", 'completeness' AS rule,
           'Low completeness (' || CAST(round_even(completeness * 100, 0) AS INTEGER) || '%) for ''' || "column" || ''''
           AS message
    FROM profile WHERE completeness < 0.5
    UNION ALL
    SELECT modality_category, file, "column", 'outliers', outlier_count || ' outlier(s) in ''' || "column" || ''''
    FROM outliers WHERE outlier_count > 0
""")
def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = profile.profile_with_outliers(measured(spark, sf_dir), GROUP, [*NUMERIC, *TEXTS])
    return profile.quality_issues(checked, GROUP).drop("position")


@query("""
    SELECT event_type AS modality_category, count(*) AS total_records, count(DISTINCT user_id) AS file_count,
           count(DISTINCT user_id) AS unique_subjects
    FROM events GROUP BY event_type
""")
def modality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.modality_report(event_files(spark, sf_dir), "file")


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        c("event_type").alias("modality_category"),
        F.concat(F.lit("silver/harmonized_sub-"), c("user_id"), F.lit("_ses-01.csv")).alias("file"),
        c("ts"), c("event_id"),
    )


@query("SELECT DISTINCT event_type AS modality_category, 'sub-' || user_id AS subject_id FROM events WHERE event_type = 'click'")
def modality_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = profile.with_modality_filter(event_files(spark, sf_dir), "click")
    return profile.modality_subjects(clicks, "file")


@query("""
    SELECT 'silver/harmonized_sub-' || user_id || '_ses-01.csv' AS file, first(event_type ORDER BY ts, event_id) AS modality_category
    FROM events GROUP BY user_id
""")
def representative_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.representative_modality(event_files(spark, sf_dir), "file", ["ts", "event_id"])


@query("""
    WITH holed AS (
        SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status,
               CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price FROM orders)
    SELECT count(*) AS row_count, 3::BIGINT AS column_count, 'status' AS "column", count(*) - count(status) AS null_count FROM holed
    UNION ALL
    SELECT count(*), 3, 'price', count(*) - count(price) FROM holed
""")
def null_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return profile.null_summary(orders.select(
        "o_orderkey", F.nullif(c("o_orderstatus"), F.lit("F")).alias("status"),
        F.when(c("o_totalprice") > 100000, c("o_totalprice")).alias("price"),
    ))


def _suggestion_sql(column: str, name: str, kind: str) -> str:
    values = f"""(SELECT list(v ORDER BY first_at) FROM (
        SELECT "{column}"::VARCHAR AS v, min(p_partkey) AS first_at FROM sample GROUP BY 1))"""
    if kind == "number":
        datatype = f"CASE WHEN len({values}) > 10 THEN 'ratio' ELSE 'ordinal' END"
        samples = f"'[' || array_to_string({values}[1:3], ', ') || ']'"
    else:
        datatype = "'nominal'"
        samples = f"'[''' || array_to_string({values}[1:3], ''', ''') || ''']'"
    levels = f"""CASE WHEN {datatype} = 'ratio' THEN '[]'
                      ELSE '["' || array_to_string({values}[1:10], '", "') || '"]' END"""
    return f"""
        SELECT '{column}' AS original_variable_name, '{name}' AS standard_name, '0' AS omop_concept_id,
               {datatype} AS datatype, {levels} AS levels, 'Auto-generated suggestion for {column}' AS description,
               'unknown' AS modality, 'local' AS vocabulary, {samples} AS sample_values"""


SUGGESTED = (
    ("p_partkey", "p_partkey", "number"), ("Part Name", "part_name", "text"), ("p-brand", "p_brand", "text"),
    ("p_size", "p_size", "number"),
)


@query("""
    WITH sample AS (
        SELECT p_partkey, p_name AS "Part Name", p_brand AS "p-brand", p_size // 10 AS p_size
        FROM part ORDER BY p_partkey LIMIT 40)
""" + " UNION ALL ".join(_suggestion_sql(*row) for row in SUGGESTED))
def metadata_suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of first rows is the feature."""
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", c("p_name").alias("Part Name"), c("p_brand").alias("p-brand"),
        F.expr("p_size div 10").alias("p_size"),
    )
    suggested = profile.suggest_metadata(parts, 40, ["p_partkey"], vocabulary="local")
    return suggested.select(
        "original_variable_name", "standard_name", "omop_concept_id", "datatype", "levels", "description",
        "modality", "vocabulary", "sample_values",
    )


@query("""
    SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'biospecimen_blood' WHEN 1 THEN 'biospecimen_saliva'
        WHEN 2 THEN 'biospecimen_urine' WHEN 3 THEN 'biospecimen_csf' ELSE 'biospecimen_unknown' END AS modality_category
    FROM part
""")
def specimen_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*map(F.lit, ("Whole Blood (urine traces)", "saliva", "URINE", "csf", "tissue")))
    specimen = F.get(words, (c("p_size") % 6).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", specimen_modality(specimen).alias("modality_category"))
