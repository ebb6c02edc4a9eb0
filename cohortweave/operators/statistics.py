"""Descriptive statistics and correlations over whole columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.names import c
from cohortweave.functions.values import missing_nan

QUARTILES = (0.25, 0.5, 0.75)
# Up to this many values, over all columns that share a task, Spark's exact percentile (which keeps all
# distinct values there) is used as it is; beyond, quantiles are searched for in narrowing brackets.
PERCENTILE_ROWS = 1_000_000
# Columns whose quantiles are searched for together; a sketch takes some hundred KB of a task.
COLUMNS_PER_PASS = 256


def _present(df: DataFrame, name: str) -> Column:
    return missing_nan(c(name), df.schema[name].dataType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


class _Bracket(NamedTuple):
    """Values of a column from `low` to `high`: how many lie below them and how many they are."""

    column: str
    low: float
    high: float
    below: int
    inside: int


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    max_rows: int = PERCENTILE_ROWS,
    counts: Mapping[str, int] | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation between the two nearest ranks.

    Columns that hold at most `max_rows` values together are ranked by one aggregate. For the others an
    approximate percentile brackets each wanted rank, one aggregate counts what lies below and inside
    every bracket, and brackets are narrowed until each holds at most `max_rows` values, which are then
    counted and ranked exactly. All columns narrow in the same passes (in sets of `COLUMNS_PER_PASS`,
    which bounds the sketches of a task), every pass is a map-side combined aggregate with a small
    result, and no task holds a large column. Known `counts` of present values save the first pass.
    """
    values = {n: _present(df, n).cast("double") for n in columns}
    if counts is None and values:
        counted = df.agg(*[F.count(v).alias(f"_{i}") for i, v in enumerate(values.values())]).first()
        counts = dict(zip(values, counted))
    result: dict[str, list[float | None]] = {n: [None] * len(probabilities) for n in columns}

    filled = sorted((n for n in values if counts[n]), key=lambda n: counts[n])
    held = dict(zip(filled, accumulate(counts[n] for n in filled)))
    small = [n for n in filled if held[n] <= max_rows]
    if small:
        row = df.agg(
            *[F.percentile(values[n], F.array(*map(F.lit, probabilities))).alias(f"_{i}") for i, n in enumerate(small)]
        ).first()
        result.update({n: list(row[i]) for i, n in enumerate(small)})
    large = [n for n in filled if held[n] > max_rows]
    for at in range(0, len(large), COLUMNS_PER_PASS):
        part = large[at : at + COLUMNS_PER_PASS]
        numbers = df.select(*[values[n].alias(n) for n in part])
        result.update(_ranked_values(numbers, {n: counts[n] for n in part}, probabilities, max_rows))
    return result


def _ranked_values(
    df: DataFrame, counts: Mapping[str, int], probabilities: Sequence[float], max_rows: int
) -> dict[str, list[float]]:
    positions = {n: [p * (count - 1) for p in probabilities] for n, count in counts.items()}
    at_rank: dict[tuple[str, int], float] = {}
    open_ranks = {
        (n, r): _Bracket(n, -math.inf, math.inf, 0, counts[n])
        for n, wanted in positions.items() for x in wanted for r in (math.floor(x), math.ceil(x))
    }
    ready: dict[tuple[str, int], _Bracket] = {}
    while open_ranks:
        narrowed = _narrow(df, open_ranks, at_rank)
        ready |= {r: b for r, b in narrowed.items() if b.inside <= max_rows}
        open_ranks = {r: b for r, b in narrowed.items() if b.inside > max_rows}
    at_rank |= _pick(df, ready)

    def interpolated(n: str, x: float) -> float:
        low, high = at_rank[n, math.floor(x)], at_rank[n, math.ceil(x)]
        return low + (x - math.floor(x)) * (high - low)

    return {n: [interpolated(n, x) for x in wanted] for n, wanted in positions.items()}


def _narrow(df: DataFrame, brackets: Mapping, at_rank: dict) -> dict:
    """Shrink every bracket around its rank; ranks that fall on one repeated value are settled.

    Ranks of one bracket share a sketch: in the first pass there is one sketch per column.
    """
    margin = 0.001
    ranks_in: dict[_Bracket, list[int]] = {}
    for (_, rank), bracket in brackets.items():
        ranks_in.setdefault(bracket, []).append(rank)
    shares = {
        b: [min(1.0, max(0.0, (rank - b.below) / b.inside + step)) for rank in ranks for step in (-margin, margin)]
        for b, ranks in ranks_in.items()
    }
    sketches = df.agg(*[
        F.percentile_approx(F.when(c(b.column).between(b.low, b.high), c(b.column)), wanted, 10_000).alias(f"_{i}")
        for i, (b, wanted) in enumerate(shares.items())
    ]).first()
    guesses = [
        (b, rank, sketches[i][2 * j], sketches[i][2 * j + 1])
        for i, (b, ranks) in enumerate(ranks_in.items()) for j, rank in enumerate(ranks)
    ]
    tallies = df.agg(*[
        F.array(
            F.count_if(c(b.column) < left), F.count_if(c(b.column) == left),
            F.count_if(c(b.column) <= right), F.count_if(c(b.column) == right),
        ).alias(f"_{i}")
        for i, (b, _, left, right) in enumerate(guesses)
    ]).first()
    remaining = {}
    for i, (b, rank, left, right) in enumerate(guesses):
        under, at_left, upto, at_right = tallies[i]
        key = (b.column, rank)
        if under <= rank < under + at_left:
            at_rank[key] = left
        elif upto - at_right <= rank < upto:
            at_rank[key] = right
        elif rank < under:
            remaining[key] = b._replace(high=math.nextafter(left, -math.inf), inside=under - b.below)
        elif rank >= upto:
            remaining[key] = b._replace(low=math.nextafter(right, math.inf), below=upto, inside=b.below + b.inside - upto)
        else:
            first = under + at_left
            remaining[key] = _Bracket(
                b.column, math.nextafter(left, math.inf), math.nextafter(right, -math.inf), first, upto - at_right - first
            )
    return remaining


def _pick(df: DataFrame, brackets: Mapping) -> dict:
    """Values at the ranks of brackets that are small enough to rank one by one, of all columns in one pass."""
    if not brackets:
        return {}
    distinct = list(dict.fromkeys(brackets.values()))
    cells = F.array_compact(F.array(*[
        F.when(c(b.column).between(b.low, b.high), F.struct(F.lit(i).alias("bracket"), c(b.column).alias("v")))
        for i, b in enumerate(distinct)
    ]))
    counted = df.select(F.inline(cells)).groupBy("bracket", "v").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("bracket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    # One row per wanted rank: at most twice the probabilities times the columns of a pass.
    wanted = df.sparkSession.createDataFrame(
        [(distinct.index(b), rank, rank - b.below) for (_, rank), b in brackets.items()], "wanted int, rank long, place long"
    )
    hits = counted.withColumn("upto", F.sum("n").over(running)).join(
        F.broadcast(wanted),
        (c("bracket") == c("wanted")) & (c("place") < c("upto")) & (c("place") >= c("upto") - c("n")),
    )
    return {(distinct[r["bracket"]].column, r["rank"]): r["v"] for r in hits.select("bracket", "rank", "v").collect()}


DESCRIPTION = (
    "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, "
    "max double, unique bigint, top string, freq bigint, missing_percent double"
)


def describe(df: DataFrame, columns: Sequence[str], max_rows: int = PERCENTILE_ROWS) -> DataFrame:
    """Count, mean, std, quartiles and missing share of numeric columns; count, distinct count and
    most frequent value (the smallest of equals) of others. Unknown columns are ignored.

    The result has one row per column; only such statistics reach the driver.
    """
    spark = df.sparkSession
    valid = [n for n in dict.fromkeys(columns) if n in df.columns]
    numeric = [n for n in valid if n in numeric_columns(df)]
    texts = [n for n in valid if n not in numeric]
    if not valid:
        return spark.createDataFrame([], DESCRIPTION)

    expressions = [F.count(F.lit(1)).alias("_rows")]
    for i, n in enumerate(valid):
        value = _present(df, n)
        expressions.append(F.count(value).alias(f"_count_{i}"))
        if n in numeric:
            number = value.cast("double")
            expressions.append(
                F.array(F.avg(number), F.stddev_samp(number), F.min(number), F.max(number)).alias(f"_stats_{i}")
            )
    totals = df.agg(*expressions).first()
    counts = {n: totals[f"_count_{i}"] for i, n in enumerate(valid)}
    quantiles = exact_quantiles(df, numeric, max_rows=max_rows, counts=counts)
    tops = _most_frequent(df, texts)

    rows = []
    for i, n in enumerate(valid):
        count = counts[n]
        missing = 100.0 * (totals["_rows"] - count) / totals["_rows"] if totals["_rows"] else None
        if n in numeric:
            mean, std, low, high = totals[f"_stats_{i}"]
            p25, p50, p75 = quantiles[n]
            rows.append((n, count, mean, std, low, p25, p50, p75, high, None, None, None, missing))
        else:
            unique, top, freq = tops.get(n, (0, None, None))
            rows.append((n, count, *[None] * 7, unique, top, freq, missing))
    return spark.createDataFrame(rows, DESCRIPTION)


def _most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    if not columns:
        return {}
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("value")) for n in columns]))
        .alias("cell")
    ).select("cell.*")
    counts = long.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique"), F.min(F.struct((-c("n")).alias("n"), c("value"))).alias("top")
    )
    return {r["column"]: (r["unique"], r["top"]["value"], -r["top"]["n"]) for r in best.collect()}


def correlations(df: DataFrame, target: str, threshold: float = 0.3) -> DataFrame:
    """Pearson correlation of the target with every other numeric column, over complete pairs.

    One aggregate for all columns. Constant columns have no correlation and are left out.
    """
    names = [n for n in numeric_columns(df) if n != target]
    if target not in numeric_columns(df) or not names:
        return df.sparkSession.createDataFrame([], "variable string, correlation double")
    y = _present(df, target).cast("double")
    pairs = []
    for n in names:
        x = _present(df, n).cast("double")
        spread = F.stddev_samp(F.when(y.isNotNull(), x)) * F.stddev_samp(F.when(x.isNotNull(), y))
        pairs.append(
            F.struct(F.lit(n).alias("variable"), F.try_divide(F.covar_samp(x, y), spread).alias("correlation"))
        )
    return (
        df.agg(F.array(*pairs).alias("_pairs"))
        .select(F.inline("_pairs"))
        .filter(c("correlation").isNotNull() & (F.abs("correlation") >= threshold))
    )
