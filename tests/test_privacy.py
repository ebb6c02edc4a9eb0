"""De-identification, hashes, redaction and noise."""

import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

from cohortweave.constants import EXPLICIT_IDENTIFIERS
from cohortweave.functions.names import c
from cohortweave.functions.values import plain_double_sql, pseudonym, row_hash
from cohortweave.operators.deidentify import birth_years, cap_ages, deidentify, is_identifier
from cohortweave.operators.redact import add_noise, redact


@pytest.mark.parametrize("name", EXPLICIT_IDENTIFIERS)
def test_every_identifier_goes_however_it_is_spelt(name):
    for spelling in (name, name.upper(), f"ehr.{name}", f"nonstandard_{name}", f"ehr.nonstandard_{name}_0", f"{name}_12"):
        assert is_identifier(spelling), spelling


@pytest.mark.parametrize("name", ["survey.observation_name", "x.Email", "my_mrn_code", "_pii_patient_x", "ip_addr_2"])
def test_name_patterns(name):
    assert is_identifier(name)


@pytest.mark.parametrize("name", ["participant_id", "account", "name.value", "heart_rate_0"])
def test_other_columns_stay(name):
    assert not is_identifier(name)


def test_keep_list(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`m.observation_name` string, `m.patient_name` string, v string")
    assert df.transform(deidentify(keep=["observation_name"])).columns == ["m.observation_name", "v"]


def test_age_cap(spark):
    rows = [(88, 100, "95"), (89, 100, "x"), (90, 100, None), (95, 100, None), (None, None, None)]
    df = spark.createDataFrame(rows, "`demographics.participant_age` int, age int, participant_age_text string")
    out = cap_ages(df)
    assert [r[0] for r in out.collect()] == [88, 89, 90, 90, None]
    assert out.dtypes == df.dtypes and [r[1] for r in out.collect()][:2] == [100, 100]


def test_birth_years(spark):
    rows = [("1980-02-03", "Paris", 3.5, "2024-01-01", "1999"), ("1980-05", "Rome", 2.5, None, "x"), ("??", None, None, None, None),
            ("7/4/1976", "1st St", 1.0, "x", None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "birth_date string, birth_place string, birth_weight double, event_date string, birth_duration string")
    out = birth_years(df).collect()
    assert [r["birth_date"] for r in out] == [1980, 1980, None, 1976, None]
    assert [r["birth_place"] for r in out] == ["Paris", "Rome", None, "1st St", None]
    assert out[0]["birth_weight"] == 3.5 and out[0]["event_date"] == "2024-01-01" and out[0]["birth_duration"] == "1999"


def test_row_hash_formula(spark):
    df = spark.createDataFrame([("p", 7, 12345678.5, None, float("nan"), True)],
                               "a string, b int, c double, d string, e double, f boolean")
    expected = hashlib.sha256("p712345678.5nannanTrue".encode()).hexdigest()
    assert df.select(row_hash(df.schema.fields).alias("h")).first()["h"] == expected


def test_numbers_are_spelt_without_exponents(spark):
    values = [0.0, -0.5, 1e7, 123456789.125, 1e15, 1e16, 0.0005, 0.00012345, 1e-5, 98765432.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    spelt = [r[0] for r in df.select(F.expr(plain_double_sql("v"))).collect()]
    for value, text in zip(values, spelt):
        assert float(text) == value
        if 1e-4 <= abs(value) < 1e16:
            assert text == repr(value)


def test_pseudonym(spark):
    df = spark.createDataFrame([("x",), (" ",), (None,)], "v string")
    out = [r[0] for r in df.select(pseudonym(c("v"), "salt")).collect()]
    assert out == [hashlib.sha256(b"xsalt").hexdigest()[:16], " ", None]


def test_redact_keeps_only_mapped_columns(spark):
    registry = spark.createDataFrame(
        [("n", "pii_name"), ("d", "pii_date"), ("t", "pii_note"), ("c", "ratio"), ("s", "ratio")],
        "original_variable_name string, datatype string",
    )
    df = spark.createDataFrame([("Ann", "2020", "note", 5, "text", 1)] * 3, "n string, d string, t string, c int, s string, other int")
    out = df.transform(redact(registry, seed="s"))
    assert out.columns == ["n", "d", "t", "c", "s"]
    assert tuple(out.first()) == ("[REDACTED NAME]", "[DATE SHIFTED]", "note", 5, "text")


@pytest.mark.parametrize("row_key", [None, ["id"]])
def test_noise_has_the_stated_scale(spark, row_key):
    df = spark.range(40_000, numPartitions=8).select("id", (F.col("id") % 11).cast("double").alias("v"))
    noised = add_noise(df, ["v"], 0.5, seed="secret", row_key=row_key)
    noise = [b - a for a, b in noised.join(df.withColumnRenamed("v", "w"), "id").select("w", "v").collect()]
    scale = 10 / 0.5
    assert abs(statistics.fmean(noise)) < 1.0
    assert math.isclose(statistics.fmean(map(abs, noise)), scale, rel_tol=0.05)
    assert math.isclose(statistics.median(map(abs, noise)), scale * math.log(2), rel_tol=0.05)


def test_keyed_noise_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select("id", F.col("id").cast("double").alias("v"))
    one = add_noise(df.coalesce(1), ["v"], 1.0, seed="s", row_key=["id"]).collect()
    many = add_noise(df.repartition(7), ["v"], 1.0, seed="s", row_key=["id"]).collect()
    assert sorted(one) == sorted(many)
