"""Harmonization against a registry, registry search, lookups and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.checks import query, table
from cohortweave.functions.names import c
from cohortweave.operators import variables
from cohortweave.operators.harmonize import harmonize
from cohortweave.operators.modalities import harmonize_modality as harmonize_rows

PART_REGISTRY = [
    ("p_name", "Part Name"), ("p_brand", "brand or type"), ("p_type", "brand or type"), ("p_size", "p_size"),
]


def part_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PART_REGISTRY, "original_variable_name string, standard_name string")


@query("""
    SELECT p_partkey AS nonstandard_p_partkey, p_name AS "Part Name",
           coalesce(nullif(p_brand, 'Brand#2'), p_type) AS "brand or type", p_size,
           p_retailprice AS nonstandard_p_retailprice
    FROM part
""")
def harmonize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("p_brand", F.nullif(c("p_brand"), F.lit("Brand#2")))
    return parts.transform(harmonize(part_registry(spark)))


@query("""
    SELECT 'sub-' || o_custkey AS participant_id, o_totalprice AS "PHQ-9 Total Score",
           o_orderkey AS nonstandard_o_orderkey, 'clinical_survey_psychometrics' AS modality_category
    FROM orders
""")
def harmonize_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    surveys = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("sub-"), c("o_custkey")).alias("participant_id"),
        c("o_totalprice").alias("phq9_total"), "o_orderkey",
    )
    registry = spark.createDataFrame(
        [("phq9_total", "PHQ-9 Total Score")], "original_variable_name string, standard_name string"
    )
    return harmonize_rows(surveys, "assessments", registry)


def derived_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as registry rows, some of them faulty."""
    datatype = F.get(
        F.array(*map(F.lit, ("nominal", "ordinal", "ratio", "interval", "pii_name", "pii_date", "pii_note", "text"))),
        (c("p_size") % 8).cast("int"),
    )
    levels = (
        F.when(c("p_size") % 4 == 0, F.lit("[]"))
        .when(c("p_size") % 4 == 1, F.concat(F.lit("['0=No', '1 = "), c("p_type"), F.lit("']")))
        .when(c("p_size") % 4 == 2, F.concat(F.lit('["2=a=b", "plain", "3='), c("p_brand"), F.lit('"]')))
        .when(c("p_partkey") % 2 == 0, F.lit("not a list"))
    )
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("var_"), c("p_partkey")).alias("original_variable_name"),
        F.regexp_replace("p_name", " ", "_").alias("standard_name"),
        F.when(c("p_partkey") % 7 == 0, c("p_partkey").cast("string"))
        .when(c("p_partkey") % 11 != 0, F.concat(c("p_partkey"), F.lit("-"), c("p_size") % 10)).alias("loinc_code"),
        F.lit("").alias("sdtm_variable"),
        F.when(c("p_partkey") % 13 == 0, F.concat(F.lit("x"), c("p_size")))
        .when(c("p_partkey") % 5 != 0, c("p_partkey").cast("string")).alias("omop_concept_id"),
        datatype.alias("datatype"),
        F.lower("p_type").alias("modality"),
        c("p_brand").alias("vocabulary"),
        levels.alias("levels"),
    )


REGISTRY_SQL = """
    SELECT 'var_' || p_partkey AS original_variable_name, replace(p_name, ' ', '_') AS standard_name,
           CASE WHEN p_partkey % 7 = 0 THEN p_partkey::VARCHAR
                WHEN p_partkey % 11 <> 0 THEN p_partkey || '-' || (p_size % 10) END AS loinc_code,
           CASE WHEN p_partkey % 13 = 0 THEN 'x' || p_size
                WHEN p_partkey % 5 <> 0 THEN p_partkey::VARCHAR END AS omop_concept_id,
           ['nominal', 'ordinal', 'ratio', 'interval', 'pii_name', 'pii_date', 'pii_note', 'text'][p_size % 8 + 1] AS datatype,
           p_partkey, p_size, p_type, p_brand
    FROM part
"""


@query(f"""
    WITH registry AS ({REGISTRY_SQL})
    SELECT original_variable_name AS variable, 'loinc' AS rule,
           'DATA ERROR [' || original_variable_name || ']: Invalid LOINC format ''' || loinc_code || '''' AS message
    FROM registry WHERE NOT regexp_full_match(loinc_code, '[0-9]{{1,7}}-[0-9]')
    UNION ALL
    SELECT original_variable_name, 'omop', 'DATA ERROR [' || original_variable_name || ']: OMOP Concept ID ''' ||
           omop_concept_id || ''' must be an integer'
    FROM registry WHERE omop_concept_id LIKE 'x%'
    UNION ALL
    SELECT original_variable_name, 'datatype', 'DATA ERROR [' || original_variable_name || ']: Invalid datatype ''' || datatype || ''''
    FROM registry WHERE datatype = 'text'
""")
def registry_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variables.registry_violations(derived_registry(spark, sf_dir))


@query("""
    WITH listed AS (
        SELECT replace(p_name, ' ', '_') AS standard_name, unnest(CASE p_size % 4
            WHEN 1 THEN [('0', 'No'), ('1', p_type)] WHEN 2 THEN [('2', 'a=b'), ('3', p_brand)] ELSE [] END) AS item
        FROM part)
    SELECT standard_name, item[1] AS code, item[2] AS label FROM listed
""")
def levels_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variables.categorical_levels(derived_registry(spark, sf_dir))


@query("""
    WITH codes AS (SELECT p_partkey // 2 AS code, min(replace(p_name, ' ', '_')) AS standard_name FROM part GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_partkey AS VARCHAR) AS code, standard_name
    FROM lineitem LEFT JOIN codes ON codes.code = l_partkey
""")
def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two registry rows per code, so that the first must be chosen; half of the codes are unknown."""
    registry = derived_registry(spark, sf_dir).withColumn(
        "loinc_code", F.expr("cast(substring(original_variable_name, 5) as bigint) div 2")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", c("l_partkey").alias("code")
    )
    return variables.standard_names_by_code(lines, registry, "code")


@query("""
    SELECT c_custkey, r_name AS variable, CAST(c_nationkey AS VARCHAR) AS code, n_name AS label
    FROM customer, region LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey = r_regionkey
    WHERE r_regionkey = c_custkey % 5
""")
def categorical_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    lookups = table(spark, sf_dir, "nation").join(regions, c("n_regionkey") == c("r_regionkey")).select(
        c("r_name").alias("standard_name"), c("n_nationkey").cast("string").alias("code"), c("n_name").alias("label")
    )
    asked = table(spark, sf_dir, "customer").join(regions, (c("c_custkey") % 5) == c("r_regionkey")).select("c_custkey", c("r_name").alias("variable"), c("c_nationkey").alias("code"))
    return variables.categorical_labels(asked, lookups, "variable", "code")


@query("SELECT DISTINCT p_brand FROM part WHERE regexp_matches(p_name, 'RING|^hot', 'i')")
def variable_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variables.search_variables(table(spark, sf_dir, "part"), "RING|^hot", "p_name", "p_brand")


MISSPELT = "smal widgett"


@query(f"""
    WITH names AS (
        SELECT p_name AS name, count(*) AS rows,
               1 - levenshtein(p_name, '{MISSPELT}')::DOUBLE / greatest(length(p_name), {len(MISSPELT)}) AS score
        FROM part GROUP BY p_name)
    SELECT * FROM names WHERE score >= 0.6 ORDER BY score DESC, name DESC LIMIT 5
""")
def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best five are the feature."""
    return variables.close_matches(table(spark, sf_dir, "part"), "p_name", MISSPELT)


@query(f"""
    WITH names AS (
        SELECT p_name, count(*) AS n,
               1 - levenshtein(p_name, '{MISSPELT}')::DOUBLE / greatest(length(p_name), {len(MISSPELT)}) AS score
        FROM part GROUP BY p_name),
    best AS (SELECT * FROM names WHERE score >= 0.6 ORDER BY score DESC, p_name DESC LIMIT 5),
    used AS (SELECT p_name, sum(n) OVER (ORDER BY score DESC, p_name DESC) - n AS before FROM best)
    SELECT DISTINCT p_brand FROM part WHERE p_name IN (SELECT p_name FROM used WHERE before < 5)
""")
def variable_search_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No name matches the misspelt keyword, so the most similar ones stand in."""
    return variables.search_variables(table(spark, sf_dir, "part"), MISSPELT, "p_name", "p_brand")


WORD = "[A-Za-z]{5,}"


@query(f"""
    WITH names AS (
        SELECT name, count(*) AS rows FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS name FROM documents)
        GROUP BY name),
    asked AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{WORD}')) AS keyword FROM benchmark),
    scored AS (
        SELECT keyword, name, rows,
               1 - levenshtein(name, keyword)::DOUBLE / greatest(length(name), length(keyword)) AS score
        FROM asked JOIN names ON abs(length(name) - length(keyword)) <= 0.25 * greatest(length(name), length(keyword))),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY score DESC, name DESC) AS place
        FROM scored WHERE score >= 0.75)
    SELECT keyword, name, rows, score FROM ranked WHERE place <= 5
""")
def fuzzy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the benchmark as keywords, all words of the documents as names. The best five are the feature."""

    def words(name: str, alias: str) -> DataFrame:
        found = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
        return table(spark, sf_dir, name).select(F.explode(found).alias(alias))

    return variables.close_matches_of(words("documents", "word"), "word", words("benchmark", "keyword"), cutoff=0.75)


@query("SELECT DISTINCT p_brand FROM part")
def variable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variables.search_variables(table(spark, sf_dir, "part"), None, output_column="p_brand")
