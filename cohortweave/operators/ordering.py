"""Row numbers inside groups that stay distributed when one group holds most of the rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.functions.names import c

# Groups below this many rows are never split.
HOT_FLOOR = 1_000_000
# Rows sampled per range when the ranges of a hot group are laid out.
SAMPLES_PER_RANGE = 32


@dataclass(frozen=True)
class GroupSizes:
    """Sizes of the groups of a table, and its hot groups with their row counts.

    A hot group has more rows than `bound`, which is at least 1/ranges of the table, so there
    are fewer than `ranges` hot groups whatever the data.
    """

    bound: float
    largest: int
    hot: DataFrame | None
    largest_by: Mapping[Any, int] = field(default_factory=dict)


def range_count(spark: SparkSession) -> int:
    """Into how many ranges a whole table would be cut: a few per shuffle partition."""
    return max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def measure_groups(
    df: DataFrame, group: Sequence[str], floor: int = HOT_FLOOR, by: str | None = None
) -> GroupSizes:
    """Largest group and hot groups, from one aggregate over the group columns alone.

    `by` names a group column of few values (such as the modality) to find the largest group of
    each of them in the same pass.
    """
    spark = df.sparkSession
    sizes = df.groupBy(*[c(g) for g in group]).agg(F.count(F.lit(1)).alias("_rows"))
    split = F.lit(None).cast("string") if by is None else c(by)
    found = sizes.groupBy(split.alias("_by")).agg(F.max("_rows").alias("largest"), F.sum("_rows").alias("total")).collect()
    if not found:
        return GroupSizes(floor, 0, None)
    largest, total = max(r["largest"] for r in found), sum(r["total"] for r in found)
    largest_by = {r["_by"]: r["largest"] for r in found}
    bound = max(floor, total / range_count(spark))
    if largest <= bound:
        return GroupSizes(bound, largest, None, largest_by)
    rows = sizes.filter(F.col("_rows") > bound).collect()
    return GroupSizes(bound, largest, spark.createDataFrame(rows, sizes.schema), largest_by)


def _marked(group: Sequence[str]) -> list[Column]:
    return [c(g).alias(f"_hot_{i}") for i, g in enumerate(group)]


def _in_marked(group: Sequence[str]) -> list[Column]:
    return [c(g).eqNullSafe(c(f"_hot_{i}")) for i, g in enumerate(group)]


def _range_bounds(df: DataFrame, group: Sequence[str], sizes: GroupSizes, order: Column) -> DataFrame:
    """Ordered cut points inside each hot group, from a sample of its order values.

    The sample only decides where the cuts lie; every row is numbered whatever they are. It holds
    about `SAMPLES_PER_RANGE` rows per range, over all hot groups together.
    """
    rate = max(1, math.ceil(sizes.bound / SAMPLES_PER_RANGE))
    hot = sizes.hot.select(*_marked(group), F.ceil(F.col("_rows") / sizes.bound).cast("int").alias("_cuts"))
    sample = (
        df.join(F.broadcast(hot), _in_marked(group))
        .select(*[f"_hot_{i}" for i in range(len(group))], "_cuts", order.alias("_order"))
        .filter(F.pmod(F.xxhash64("_order"), F.lit(rate)) == 0)
        .groupBy(*[f"_hot_{i}" for i in range(len(group))], "_cuts")
        .agg(F.array_sort(F.collect_set("_order")).alias("_sample"))
    )
    every = F.greatest(F.lit(1), F.ceil(F.size("_sample") / F.col("_cuts")).cast("int"))
    cuts = F.filter("_sample", lambda _, i: F.pmod(i, every) == 0)
    return sample.select(*[f"_hot_{i}" for i in range(len(group))], cuts.alias("_bounds"))


def row_index(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    name: str = "_index",
    *,
    sizes: GroupSizes | None = None,
    floor: int = HOT_FLOOR,
    distribute_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row inside its group.

    `order_by` must order the rows of a group totally. Groups of usual size take one window over
    one shuffle; `distribute_by` (a subset of `group`) lets a later grouping reuse that shuffle.
    A hot group is cut into ranges of its order values: rows are numbered inside each range and
    shifted by the number of rows in the ranges before, so no task holds the group whole.
    """
    sizes = measure_groups(df, group, floor) if sizes is None else sizes
    keys = [c(g) for g in group]
    if sizes.hot is None:
        source = df.repartition(*[c(d) for d in distribute_by]) if distribute_by else df
        window = Window.partitionBy(*keys).orderBy(*[c(o) for o in order_by])
        return source.withColumn(name, (F.row_number().over(window) - 1).cast("long"))

    order = F.struct(*[c(o) for o in order_by])
    marks = [f"_hot_{i}" for i in range(len(group))]
    # Both broadcast sides below hold hot groups only: fewer than `ranges` groups and cuts.
    bounds = F.broadcast(_range_bounds(df, group, sizes, order))
    ranged = (
        df.join(bounds, _in_marked(group), "left")
        .withColumn("_range", F.size(F.filter("_bounds", lambda b: b <= order)))
        .drop("_bounds", *marks)
        .withColumn("_range", F.coalesce("_range", F.lit(-1)))
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(*[c(o) for o in order_by])
    numbered = ranged.withColumn("_position", (F.row_number().over(inside) - 1).cast("long"))

    before = Window.partitionBy(*marks).orderBy("_hot_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.filter(F.col("_range") >= 0)
        .groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*_marked(group), F.col("_range").alias("_hot_range"), "_rows")
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    return (
        numbered.join(F.broadcast(offsets), [*_in_marked(group), c("_range") == c("_hot_range")], "left")
        .withColumn(name, F.col("_position") + F.coalesce("_offset", F.lit(0)))
        .drop("_position", "_range", "_offset", "_hot_range", *marks)
    )
