"""Profile and reports against values worked out by hand."""

import pytest

from cohortweave.operators import profile
from cohortweave.plans.report import QualityReport


@pytest.fixture(scope="module")
def silver(spark):
    rows = [("m", "sub-1_a.csv", i, float(i % 2), None, "x" if i % 2 else "N/a", None) for i in range(20)]
    rows += [("m", "sub-1_a.csv", 20, 1000.0, 1, None, True)]
    rows += [("m", "sub-2_a.csv", 0, 5.0, 2, "z", False), ("n", "other.csv", 0, float("nan"), None, "", None)]
    return spark.createDataFrame(
        rows, "modality_category string, file string, seq int, v double, nonstandard_few int, t string, b boolean"
    )


def rows_of(df, file="sub-1_a.csv"):
    return {r["column"]: r for r in df.collect() if r["file"] == file}


GROUP = ["modality_category", "file"]


def test_full_profile(silver):
    found = rows_of(profile.full_profile(silver, GROUP, ["v", "nonstandard_few", "t", "b"], ["seq"]))
    v, few, t, b = (found[n] for n in ("v", "nonstandard_few", "t", "b"))
    assert (v["non_null_count"], v["null_count"], v["completeness"], v["outlier_count"]) == (21, 0, 1.0, 1)
    assert (v["min"], v["max"], v["mean"]) == (0.0, 1000.0, 48.0952)
    assert (few["completeness"], few["is_standard_field"], few["std"], few["outlier_count"]) == (0.048, False, 0.0, None)
    assert (t["unique_values"], t["na_like_values"], t["sample_values"], t["mean"]) == (2, 10, ["N/a", "x"], None)
    assert (b["dtype"], b["mean"], b["unique_values"]) == ("boolean", 1.0, None)


def test_nan_counts_as_missing(silver):
    found = rows_of(profile.column_profile(silver, GROUP, ["v", "t"]), "other.csv")
    assert found["v"]["non_null_count"] == 0 and found["v"]["std"] is None and found["t"]["non_null_count"] == 1


def test_issues_and_completeness(silver):
    full = profile.full_profile(silver, GROUP, ["v", "nonstandard_few", "t", "b"], ["seq"])
    issues = [r["message"] for r in profile.quality_issues(full, GROUP).filter("file = 'sub-1_a.csv'").orderBy("position").collect()]
    assert issues == ["1 outlier(s) in 'v'", "Low completeness (5%) for 'nonstandard_few'", "Low completeness (5%) for 'b'"]
    overall = {r["file"]: r["overall_completeness"] for r in profile.overall_completeness(full, GROUP).collect()}
    assert overall["sub-1_a.csv"] == 0.512 and overall["sub-2_a.csv"] == 1.0


def test_outliers_by_shuffled_statistics_are_the_same(silver, monkeypatch):
    usual = sorted(map(tuple, profile.outlier_counts(silver, GROUP, ["v"]).collect()))
    joined = profile.lookup_join
    monkeypatch.setattr(profile, "lookup_join", lambda *a, **k: joined(*a, max_rows=0, salts=3, **k))
    assert sorted(map(tuple, profile.outlier_counts(silver, GROUP, ["v"]).collect())) == usual


def test_report(silver):
    found = {r["modality_category"]: tuple(r)[1:] for r in profile.modality_report(silver, "file").collect()}
    assert found == {"m": (22, 2, 2), "n": (1, 1, 0)}
    assert [tuple(r) for r in profile.modality_report(silver, "file", "n").collect()] == [("n", 1, 1, 0)]
    assert sorted(r["subject_id"] for r in profile.modality_subjects(silver, "file").collect()) == ["sub-1", "sub-2"]
    modalities = {r["file"]: r["modality_category"] for r in profile.representative_modality(silver, "file", ["seq"]).collect()}
    assert modalities["other.csv"] == "n"


def test_null_summary(silver):
    found = {r["column"]: (r["row_count"], r["column_count"], r["null_count"]) for r in profile.null_summary(silver).collect()}
    assert found == {"nonstandard_few": (23, 7, 21), "t": (23, 7, 1), "b": (23, 7, 21)}


def test_suggestions(spark):
    rows = [(i, f"it's {i % 2}", 0.5, None) for i in range(12)]
    df = spark.createDataFrame(rows, "`Sub ID` int, `Free-Text` string, x double, empty string")
    small = {r["original_variable_name"]: r for r in profile.suggest_metadata(df, 5, ["Sub ID"]).collect()}
    assert small["Sub ID"]["datatype"] == "ordinal" and small["Sub ID"]["levels"] == '["0", "1", "2", "3", "4"]'
    assert small["Free-Text"]["standard_name"] == "free_text" and small["Free-Text"]["datatype"] == "nominal"
    assert small["Free-Text"]["sample_values"] == str(["it's 0", "it's 1"])
    assert small["x"]["sample_values"] == "[0.5]" and small["empty"]["levels"] == "[]"
    large = {r["original_variable_name"]: r for r in profile.suggest_metadata(df, 12, ["Sub ID"]).collect()}
    assert (large["Sub ID"]["datatype"], large["Sub ID"]["levels"], large["Sub ID"]["sample_values"]) == ("ratio", "[]", "[0, 1, 2]")


def test_report_tables_belong_together(silver):
    report = QualityReport(silver, "file", "m", ["seq"])
    assert {r["column"] for r in report.columns.collect()} == {"v", "nonstandard_few", "t", "b"}
    assert [tuple(r) for r in report.modalities.collect()] == [("m", 22, 2, 2)]
    assert report.completeness.count() == 2 and report.issues.filter("rule = 'outliers'").count() == 1
    assert report.subjects.count() == 2


def test_tables_of_one_kind_of_column(spark):
    numbers = spark.createDataFrame([("f", 1.0), ("f", 2.0)], "file string, x double")
    assert profile.full_profile(numbers, ["file"]).first()["unique_values"] is None
    texts = spark.createDataFrame([("f", "a"), ("f", "b")], "file string, x string")
    assert profile.full_profile(texts, ["file"]).first()["outlier_count"] is None


@pytest.mark.parametrize("order_by", [None, ["seq"], ["seq", "other"]])
def test_long_texts_are_told_apart_whole(spark, order_by):
    head = "header of every note " * 20
    texts = [head + "b", head + "a", head, "short", "", " N/A ", "x" * 64, "x" * 65, "\u00e4" * 33, None, head + "a", "short"]
    rows = [(g, len(texts) - i if g == "k" else 1, i, t) for g in ("k", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "g string, seq int, other int, note string")
    found = {r["g"]: r for r in profile.categorical_profile(df, ["g"], ["note"], order_by, samples=4).collect()}
    for g in ("k", None):
        first = {}
        for _, seq, other, t in (r for r in rows if r[0] == g and r[3] is not None):
            place = {"seq": seq, "other": other}
            first[t] = min(first.get(t, (9**9, 9**9)), tuple(place[o] for o in order_by or ()))
        expected = sorted(first, key=lambda t: (first[t], t))[:4]
        assert found[g]["sample_values"] == expected
        assert found[g]["unique_values"] == len(first)

