"""De-identification, redaction and noise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.checks import query, table, undotted
from cohortweave.functions.names import c
from cohortweave.functions.values import pseudonym
from cohortweave.operators.deidentify import birth_years as truncate_births
from cohortweave.operators.deidentify import cap_ages, deidentify
from cohortweave.operators.redact import add_noise
from cohortweave.operators.redact import redact as redact_table

SALT = "check-salt"
SEED = "check-seed"


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, c_name AS medication_name FROM customer")
def deidentify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select(
        "*",
        c("c_name").alias("contacts.email"),
        c("c_custkey").alias("nonstandard_account_number"),
        c("c_custkey").alias("device_identifier_0"),
        c("c_name").alias("medication_name"),
    )
    return undotted(named.transform(deidentify(keep=["medication_name"])))


@query("""
    SELECT p_partkey, CASE WHEN p_size * 2 > 89 THEN 90 ELSE p_size * 2 END AS participant_age,
           p_size * 2 AS package_size
    FROM part
""")
def age_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", (c("p_size") * 2).alias("participant_age"), (c("p_size") * 2).alias("package_size")
    )
    return cap_ages(parts)


@query("""
    SELECT o_orderkey, year(o_orderdate) AS birth_date,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE year(o_orderdate) END AS dob_text,
           o_orderpriority AS birth_place, o_totalprice AS birth_weight,
           strftime(o_orderdate, '%Y-%m-%d') AS event_date
    FROM orders
""")
def birth_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        c("o_orderdate").alias("birth_date"),
        F.when(c("o_orderstatus") == "F", F.lit("unclear")).otherwise(day).alias("dob_text"),
        c("o_orderpriority").alias("birth_place"),
        c("o_totalprice").alias("birth_weight"),
        day.alias("event_date"),
    )
    return truncate_births(orders)


@query(f"""
    SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN ' ' ELSE substring(sha256(c_name || '{SALT}'), 1, 16) END AS pseudonym
    FROM customer
""")
def pseudonymize(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    name = F.when(c("c_nationkey") == 0, F.lit(" ")).otherwise(c("c_name"))
    return customers.select("c_custkey", pseudonym(name, SALT).alias("pseudonym"))


POLICY = [
    ("c_custkey", "nominal"), ("c_name", "pii_name"), ("c_mktsegment", "pii_date"), ("c_nationkey", "ordinal"),
    ("no_such_column", "ratio"),
]


def policy(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "original_variable_name string, datatype string")


@query("""
    SELECT c_custkey, '[REDACTED NAME]' AS c_name, c_nationkey, '[DATE SHIFTED]' AS c_mktsegment FROM customer
""")
def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").transform(redact_table(policy(spark, POLICY), seed=SEED))


def _noise_sql(value: str, key: str, source: str, epsilon: float) -> str:
    uniform = f"(CAST('0x' || substring(sha256('{SEED}|{value}|' || {key}), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {2**52}::DOUBLE"
    return f"""
        WITH scaled AS (
            SELECT {key}, {value}, {uniform} - 0.5::DOUBLE AS u,
                   (max({value}) OVER () - min({value}) OVER ()) / {epsilon}::DOUBLE AS scale
            FROM {source})
        SELECT {key}, round({value} - scale * sign(u) * ln(1.0::DOUBLE - 2.0::DOUBLE * abs(u)), 4) AS {value} FROM scaled
    """


@query(_noise_sql("o_totalprice", "o_orderkey", "orders", 0.5))
def laplace_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    noised = add_noise(orders, ["o_totalprice"], 0.5, seed=SEED, row_key=["o_orderkey"])
    return noised.withColumn("o_totalprice", F.round("o_totalprice", 4))


@query(_noise_sql("c_acctbal", "c_custkey", "customer", 0.1).replace(
    "SELECT c_custkey, round(", "SELECT c_custkey, '[REDACTED NAME]' AS c_name, c_nationkey, '[DATE SHIFTED]' AS c_mktsegment, round("
).replace("SELECT c_custkey, c_acctbal,", "SELECT c_custkey, c_nationkey, c_acctbal,"))
def redact_with_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise drawn from each row's key, so it is the same in every layout of the data."""
    rules = policy(spark, [*POLICY, ("c_acctbal", "ratio")])
    noised = table(spark, sf_dir, "customer").transform(redact_table(rules, 0.1, seed=SEED, row_key=["c_custkey"]))
    return noised.withColumn("c_acctbal", F.round("c_acctbal", 4))
