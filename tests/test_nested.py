"""The nested cohort against the wide one."""

import time

import pytest
from pyspark.sql import functions as F

from cohortweave.constants import HASH
from cohortweave.operators.flatten import CHUNK
from cohortweave.operators.nested import columns_of, is_nested, long_values, matching_records, record_rows, wide_form
from cohortweave.operators.select import matching
from cohortweave.plans.explorer import CohortExplorer
from cohortweave.plans.gold import build_gold, build_nested
from cohortweave.sources.tables import read_gold, write_gold

DDL = (
    "participant_id string, visit_session string, modality_category string, seq int, g string, x double, "
    "`dot.ted` int, mrn string, date_of_birth string, participant_age int"
)
ROWS = [
    ("p1", "s1", "genomics", 2, "C", 2.5, 1, "m1", None, None),
    ("p1", "s1", "genomics", 1, "A", None, None, "m2", None, None),
    ("p1", "s1", "genomics", 3, None, float("nan"), 3, "m3", None, None),
    ("p1", "s1", "survey", 1, None, 7.0, None, "m4", "1950-02-03", 93),
    ("p2", "s1", "survey", 1, None, 8.0, 5, "m5", "1960-02-03", 40),
    (None, None, "genomics", 1, "A", 1.0, 9, "m6", None, None),
    (None, None, "genomics", 2, "T", 4.0, 8, "m7", None, None),
    ("p3", None, None, 1, "G", 0.5, None, None, None, None),
]
VARIABLES = {
    "genomics": ["g", "x", "dot.ted", "mrn"],
    "survey": ["x", "dot.ted", "mrn", "date_of_birth", "participant_age"],
    "unknown": ["g", "x"],
}


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(ROWS, DDL)


def stored_nested(spark, silver, folder, width):
    write_gold(build_nested(silver, ["seq"], VARIABLES, width), str(folder))
    return read_gold(spark, str(folder))


def as_rows(df, columns):
    return sorted((tuple(str(v) for v in r) for r in df.select(*[f"`{n}`" for n in columns]).collect()))


@pytest.mark.parametrize("width", [4096, 2])
def test_wide_form_of_the_stored_table_is_the_wide_cohort(spark, silver, tmp_path, width):
    nested = stored_nested(spark, silver, tmp_path / "gold", width)
    assert is_nested(nested) and set(nested.columns) == {"participant_id", "visit_session", CHUNK, HASH, *VARIABLES}
    wide = build_gold(silver, ["seq"], VARIABLES, 4 if width > 4 else width).drop(HASH)
    names = sorted(n for n in wide.columns if not n.endswith("_3"))
    back = wide_form(nested.drop(HASH)) if width <= 4 else columns_of(nested, names)
    assert "survey.date_of_birth" in names and not any("mrn" in n for n in names)
    names = [n for n in names if n != CHUNK] if width > 4 else names
    assert as_rows(back, names) == as_rows(wide, names)


@pytest.mark.parametrize("width", [4096, 2])
def test_conditions_equal_those_of_the_wide_cohort(spark, silver, tmp_path, width):
    nested = stored_nested(spark, silver, tmp_path / "gold", width)
    wide = build_gold(silver, ["seq"], VARIABLES)
    for filters in (
        {"genomics.g_0": ("==", "A"), "genomics.dot.ted_2": (">", 2)},
        {"genomics.g_0": ("contains", "a")},
        {"survey.participant_age": (">", 89), "genomics.g_1": ("==", "C")},
        {"survey.date_of_birth": ("<", 1955)},
        {"genomics.x": (">", 0)},
        {"unknown.g": ("==", "G"), "no.such": ("==", 1)},
        {"no.such": ("==", 1)},
    ):
        found = matching_records(nested, filters)
        assert found.columns == nested.columns
        keys = {(r[0], r[1]) for r in matching(wide, filters).select("participant_id", "visit_session").collect()}
        assert {(r["participant_id"], r["visit_session"]) for r in found.collect()} == keys, filters
    kept = matching_records(nested, {"genomics.g_0": ("==", "A"), "genomics.g_1": ("==", "C")})
    assert kept.select(F.sum(F.size("genomics"))).first()[0] == 3
    with pytest.raises(ValueError):
        matching_records(nested, {"genomics.g_0": ("~", 1)})


@pytest.mark.parametrize("width", [4096, 2])
def test_records_and_values(spark, silver, tmp_path, width):
    nested = stored_nested(spark, silver, tmp_path / "gold", width)
    rows = {tuple(r) for r in record_rows(nested, "genomics", ["g", "dot.ted"]).collect()}
    assert rows == {
        ("p1", "s1", 0, "A", None), ("p1", "s1", 1, "C", 1), ("p1", "s1", 2, None, 3),
        (None, None, 0, "A", 9), (None, None, 1, "T", 8),
    }
    values = [tuple(r) for r in long_values(nested).collect()]
    assert len(values) == len(set(values)) == 20
    assert ("p1", "s1", "genomics", "g", 1, "C") in values and ("p1", "s1", "survey", "participant_age", 0, "90") in values
    assert not any(v[3] == "mrn" for v in values)
    with pytest.raises(ValueError):
        record_rows(nested, "genomics", ["none"])


def test_hash_does_not_depend_on_other_groups_but_on_every_value(spark, silver):
    def hashes(df):
        return {(r[0], r[1]): r[2] for r in build_nested(df, ["seq"], VARIABLES)
                .select("participant_id", "visit_session", HASH).collect()}

    whole = hashes(silver)
    alone = hashes(silver.filter("participant_id = 'p2'"))
    assert alone[("p2", "s1")] == whole[("p2", "s1")] and len(set(whole.values())) == len(whole)
    changed = hashes(silver.withColumn("mrn", F.when(F.col("seq") == 3, "other").otherwise(F.col("mrn"))))
    assert {k for k in whole if whole[k] != changed[k]} == {("p1", "s1")}
    several = build_nested(silver, ["seq"], VARIABLES, 2).filter("participant_id = 'p1'").select(CHUNK, HASH).collect()
    assert len(several) == 2 and len({r[HASH] for r in several}) == 1


def test_explorer_answers_from_either_form(spark, silver, tmp_path):
    nested = CohortExplorer(stored_nested(spark, silver, tmp_path / "gold", 4096))
    wide = CohortExplorer(build_gold(silver, ["seq"], VARIABLES))
    names = ["survey.x", "genomics.g_0", "genomics.x_1", "no.such"]
    assert {tuple(r) for r in nested.cohort_stats(names).collect()} == {tuple(r) for r in wide.cohort_stats(names).collect()}
    assert {r["variable"] for r in nested.correlations("survey.x", 0.0).collect()} <= {
        r["variable"] for r in wide.correlations("survey.x", 0.0).collect()
    }
    assert ("survey", "participant_age") in {tuple(r) for r in nested.modalities().collect()}


def test_a_group_of_a_hundred_thousand_records_plans_in_seconds(spark, tmp_path):
    many = spark.range(100_000).select(
        F.lit("p").alias("participant_id"), F.lit("s").alias("visit_session"), F.lit("m").alias("modality_category"),
        F.col("id").alias("seq"), (F.col("id") * 2).alias("v"), F.col("id").cast("string").alias("t"),
    )
    write_gold(build_nested(many, ["seq"], {"m": ["v", "t"]}), str(tmp_path / "gold"))
    nested = read_gold(spark, str(tmp_path / "gold"))
    assert nested.count() == 25
    started = time.monotonic()
    found = CohortExplorer(nested).find_participants({"m.v_99999": ("==", 199_998), "m.t_5": ("==", "5")})
    plan = columns_of(nested, ["m.v_99999"])._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 25 and time.monotonic() - started < 20
    schema = plan[plan.index("ReadSchema"):]
    assert "v:bigint" in schema and "t:string" not in schema
    assert record_rows(nested, "m", ["v"]).agg(F.sum("v"), F.max("_record")).first()[:] == (9_999_900_000, 99_999)
    assert matching_records(nested, {"m.v_100000": ("==", 1)}).isEmpty()


def test_empty_table(spark, silver):
    nested = build_nested(silver.limit(0), ["seq"], VARIABLES)
    assert matching_records(nested, {"genomics.g_0": ("==", "A")}).isEmpty()
    assert columns_of(nested, ["genomics.g_0"]).isEmpty() and long_values(nested).isEmpty()
    assert long_values(build_nested(silver, ["seq"], {"genomics": ["mrn"]})).isEmpty()
