"""Describe, exact quantiles and correlations against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortweave.operators.statistics import correlations, describe, exact_quantiles


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 5000
    x = rng.normal(size=n)
    data = pd.DataFrame({
        "x": x,
        "y": np.where(rng.random(n) < 0.3, np.nan, 2 * x + rng.normal(size=n)),
        "hot": np.where(rng.random(n) < 0.5, 7.0, rng.integers(0, 20, n)),
        "heavy": rng.pareto(1.0, n),
        "const": 1.0,
        "flag": rng.random(n) < 0.5,
    })
    data["name"] = np.where(np.arange(n) % 3 == 0, None, np.where(np.arange(n) % 2 == 0, "b", "a"))
    df = spark.createDataFrame(
        [[None if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in row] for row in data.astype(object).values.tolist()],
        "x double, y double, hot double, heavy double, const double, flag boolean, name string",
    )
    return df, data


@pytest.mark.parametrize("max_rows", [1_000_000, 50, 3])
def test_quantiles_are_exact_on_both_ways(frame, max_rows):
    df, data = frame
    probabilities = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    columns = ["x", "y", "hot", "heavy", "const"]
    found = exact_quantiles(df, columns, probabilities, max_rows=max_rows)
    for name in columns:
        assert found[name] == pytest.approx(data[name].quantile(list(probabilities)).tolist(), rel=1e-12)


def test_passes_do_not_grow_with_the_columns(spark, frame):
    df, data = frame
    wide = df.select("*", *[(F.col("x") * (i + 2)).alias(f"x{i}") for i in range(12)])

    def jobs(columns):
        group = f"quantiles-{len(columns)}"
        spark.sparkContext.setJobGroup(group, group)
        found = exact_quantiles(wide, columns, max_rows=50)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    (one, alone), (all_, together) = jobs(["x"]), jobs(["x", *[f"x{i}" for i in range(12)]])
    assert together <= alone + 2
    assert all_["x"] == one["x"]
    assert all_["x11"] == pytest.approx((data["x"] * 13).quantile([0.25, 0.5, 0.75]).tolist())


def test_small_columns_share_a_task_only_up_to_the_bound(frame):
    df, data = frame
    found = exact_quantiles(df, ["x", "y", "hot"], max_rows=6000)  # y alone fits
    for name in ("x", "y", "hot"):
        assert found[name] == pytest.approx(data[name].quantile([0.25, 0.5, 0.75]).tolist(), rel=1e-12)


def test_describe(frame):
    df, data = frame
    rows = {r["column"]: r for r in describe(df, ["x", "y", "name", "missing"]).collect()}
    assert set(rows) == {"x", "y", "name"}
    expected = data["y"].describe()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p75", "75%"), ("max", "max")):
        assert rows["y"][ours] == pytest.approx(expected[theirs])
    assert rows["y"]["missing_percent"] == pytest.approx(data["y"].isna().mean() * 100)
    text = data["name"].describe()
    assert (rows["name"]["count"], rows["name"]["unique"], rows["name"]["freq"]) == (text["count"], text["unique"], text["freq"])
    assert describe(df, ["missing"]).collect() == []


def test_correlations(frame):
    df, data = frame
    found = {r["variable"]: r["correlation"] for r in correlations(df, "x", 0.0).collect()}
    expected = data.select_dtypes("number").corr()["x"].dropna().drop("x")
    assert found == pytest.approx(expected.to_dict())
    assert "const" not in found
    assert {r["variable"] for r in correlations(df, "x", 0.5).collect()} == {"y"}
    assert correlations(df, "name").collect() == [] and correlations(df, "missing").collect() == []
