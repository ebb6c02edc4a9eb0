"""Row numbers and cohort layout, with and without groups that hold most of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortweave.constants import HASH
from cohortweave.operators.flatten import CHUNK
from cohortweave.operators.lookups import bit_filter, hot_keys, lookup_join
from cohortweave.operators.ordering import measure_groups, row_index
from cohortweave.operators.select import matching
from cohortweave.plans.gold import build_gold, gold_nested


def skewed(spark, rows=4000):
    rng = random.Random(1)
    data = []
    for i in range(rows):
        key = None if i % 3 == 0 else ("big" if i % 3 == 1 else f"k{rng.randrange(200)}")
        data.append((key, rng.randrange(50), i, float(i % 7)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, a int, b bigint, v double"), data


@pytest.mark.parametrize("floor", [1_000_000, 10])
def test_row_index_equals_brute_force(spark, floor):
    df, data = skewed(spark)
    expected = {}
    groups = defaultdict(list)
    for key, a, b, _ in data:
        groups[key].append((a, b))
    for key, members in groups.items():
        for i, (_, b) in enumerate(sorted(members)):
            expected[b] = i
    sizes = measure_groups(df, ["k"], floor)
    assert (sizes.hot is not None) == (floor == 10)
    got = {r["b"]: r["_index"] for r in row_index(df, ["k"], ["a", "b"], sizes=sizes).collect()}
    assert got == expected


def test_hot_group_is_spread_over_ranges(spark):
    df, _ = skewed(spark)
    indexed = row_index(df, ["k"], ["a", "b"], floor=10)
    plan = indexed._jdf.queryExecution().toString()
    assert "_range" in plan
    assert indexed.count() == df.count()


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, a int")
    assert row_index(df, ["k"], ["a"]).collect() == []


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_gives_the_same_rows_either_way(spark, how):
    df, _ = skewed(spark, 500)
    lookup = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 3 or k is null")
    small = lookup_join(df, lookup, ["k"], how=how, null_safe=True)
    large = lookup_join(df, lookup, ["k"], how=how, null_safe=True, max_rows=0, salts=4)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def silver(spark):
    rows = [
        ("p1", "s1", "genomics", 1, "A", None),
        ("p1", "s1", "genomics", 2, "B", None),
        ("p1", "s1", "genomics", 3, "C", None),
        ("p1", None, "genomics", 4, "D", None),
        ("p1", "s1", "survey", 5, None, 7),
        ("p2", "s1", "survey", 6, None, 9),
        ("p2", "s1", None, 7, "x", None),
    ]
    return spark.createDataFrame(
        rows, "participant_id string, visit_session string, modality_category string, seq int, g string, s int"
    )


def test_wide_rows_one_per_subject_and_session(spark):
    gold = build_gold(silver(spark), ["seq"])
    rows = {(r["participant_id"], r["visit_session"]): r.asDict() for r in gold.collect()}
    assert set(rows) == {("p1", "s1"), ("p1", None), ("p2", "s1")}
    first = rows["p1", "s1"]
    assert [first[f"genomics.g_{i}"] for i in range(3)] == ["A", "B", "C"]
    assert first["genomics.g"] is None and first["survey.s"] == 7 and first["genomics._modality"] == "genomics"
    assert rows["p1", None]["genomics.g"] == "D" and rows["p1", None]["genomics.g_0"] is None
    assert rows["p2", "s1"]["unknown.g"] == "x" and rows["p2", "s1"]["genomics._modality"] is None


def test_longer_groups_go_on_in_further_rows(spark):
    gold = build_gold(silver(spark), ["seq"], width=2)
    rows = {(r["participant_id"], r["visit_session"], r[CHUNK]): r for r in gold.collect()}
    assert rows["p1", "s1", 0]["genomics.g_1"] == "B"
    assert rows["p1", "s1", 1]["genomics.g_0"] == "C" and rows["p1", "s1", 1]["genomics.g"] is None
    assert rows["p1", "s1", 1]["survey._modality"] is None


@pytest.mark.parametrize("width", [None, 2])
def test_conditions_hold_per_subject_and_session_at_any_width(spark, width):
    gold = build_gold(silver(spark), ["seq"], width=width)
    found = matching(gold, {"genomics.g_2": ("==", "C"), "genomics.g_0": ("==", "A")})
    assert {(r["participant_id"], r["visit_session"]) for r in found.collect()} == {("p1", "s1")}
    assert matching(gold, {"genomics.g_0": ("==", "C")}).isEmpty()
    hashes = gold.filter("participant_id = 'p1' AND visit_session = 's1'").select(HASH).distinct().collect()
    assert len(hashes) == 1


def test_one_row_per_subject_and_session_without_a_width(spark):
    gold = build_gold(silver(spark), ["seq"])
    assert gold.count() == gold.select("participant_id", "visit_session").distinct().count()


@pytest.mark.parametrize("floor", [1_000_000, 10])
def test_no_value_is_lost_with_a_hot_subject(spark, floor):
    df, data = skewed(spark, 2000)
    table = df.select(
        F.col("k").alias("participant_id"), F.lit("s").alias("visit_session"), F.lit("m").alias("modality_category"),
        "a", "b",
    )
    nested, layout = gold_nested(table, ["a", "b"], {"m": ["b"]}, width=16, floor=floor)
    got = defaultdict(list)
    for r in nested.orderBy(CHUNK).collect():
        assert len(r["m"]) <= 16
        got[r["participant_id"]] += [x["b"] for x in r["m"]]
    expected = defaultdict(list)
    for key, a, b, _ in sorted(data, key=lambda x: (x[1], x[2])):
        expected[key].append(b)
    assert got == expected


def test_gold_takes_one_exchange(spark):
    gold = build_gold(silver(spark), ["seq"], {"genomics": ["g"], "survey": ["s"]}, width=4)
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan


def test_equal_rows_are_spread_by_the_salted_join(spark):
    df = spark.range(4000, numPartitions=8).select(F.lit("same").alias("k"))
    lookup = spark.createDataFrame([("same", 1)], "k string, n int")
    joined = lookup_join(df, lookup, ["k"], max_rows=0, salts=8)
    plan = joined._jdf.queryExecution().toString()
    assert joined.count() == 4000 and "_salt" in plan
    salts = df.select(F.pmod(F.xxhash64(F.spark_partition_id(), "k"), F.lit(8)).alias("s")).distinct().count()
    assert salts > 3


def test_only_hot_keys_are_cut(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
    hot = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert hot_keys(df, ["k"], 12) == {hot: 4}
    assert hot_keys(df.filter("k <> 'hot'"), ["k"], 12) == {} == hot_keys(df.limit(0), ["k"], 12)
    lookup = df.distinct().withColumn("n", F.length("k"))
    joined = lookup_join(df, lookup, ["k"], max_rows=0, salts=12)
    assert joined.count() == 9000 and joined.filter("n IS NULL OR n <> length(k)").count() == 0
    cold = lookup_join(df.filter("k <> 'hot'"), lookup, ["k"], max_rows=0, salts=12)
    assert "_salt" not in cold._jdf.queryExecution().toString()
    other_type = spark.range(5).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("n"))
    assert lookup_join(spark.range(8).select(F.col("id").alias("k")), other_type, ["k"], max_rows=0, how="inner").count() == 5


def test_bit_filter_passes_all_its_values(spark):
    values = spark.range(3000).select(F.xxhash64("id").alias("h"))
    passes = bit_filter(values, "h", 3000)
    tested = spark.range(30000).select("id", passes(F.xxhash64("id")).alias("p"))
    assert tested.filter("id < 3000 AND p").count() == 3000
    assert tested.filter("id >= 3000 AND p").count() < 27000 * 0.15
    none = bit_filter(values.limit(0), "h", 0)
    assert spark.range(10).filter(none(F.xxhash64("id"))).count() == 0
