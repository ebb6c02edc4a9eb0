"""Joins against lookup tables whose size is checked before they are broadcast, and filters by hash."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.names import c

# A lookup of at most this many rows and bytes (as JSON) is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# In that shuffle, a key with more than this share of the rows is cut into pieces below it.
SALTS = 2048
# Salts of every key where the two sides have keys of different types, so that hashes of equal keys may differ.
BLIND_SALTS = 32
# A bit filter has at most this many 64-bit words; more values only let more of the others pass.
FILTER_WORDS = 1 << 16


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if the table has at most `max_rows` rows and BROADCAST_BYTES bytes; reads no more rows than it needs to know."""
    bytes_of = F.octet_length(F.to_json(F.struct(*[c(name) for name in df.columns])))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(bytes_of)).first()
    return rows <= max_rows and (size or 0) <= BROADCAST_BYTES


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order_by`. A partial aggregate, so hot keys shrink map-side."""
    rest = [name for name in df.columns if name not in keys]
    order = F.struct(*[c(name) for name in order_by])
    picked = df.groupBy(*[c(k) for k in keys]).agg(
        F.min_by(F.struct(*[c(name) for name in rest]), order).alias("_first")
    )
    return picked.select(*[c(k) for k in keys], *[c("_first").getField(name).alias(name) for name in rest])


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int) -> dict[int, int]:
    """Hash -> number of pieces of each key that more than 1/parts of the rows share.

    One narrow pass with a mergeable sketch of frequent hashes, which tracks many more of them than can be
    that frequent: none is missed, and there are fewer than `parts`. Pieces are powers of two.
    """
    key = F.xxhash64(*[c(k) for k in keys])
    tracked = min(max(1024, 32 * parts), 1_000_000)
    top = F.call_function("approx_top_k", key, F.lit(parts), F.lit(tracked))
    rows, found = df.agg(F.count(F.lit(1)), top).first()
    return {hot: 2 ** math.ceil(math.log2(n * parts / rows)) for hot, n in found if n * parts > rows}


def _pieces(key: Column, hot: dict[int, int]) -> Column:
    pieces = F
    for size in sorted(set(hot.values())):
        pieces = pieces.when(key.isin([k for k, n in hot.items() if n == size]), F.lit(size))
    return pieces.otherwise(F.lit(1))


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "left",
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    once: bool = False,
) -> DataFrame:
    """Join a large table to a lookup table on equally named key columns.

    A lookup of a checked size is broadcast, so that hot keys cost nothing. A larger one is joined by a
    shuffle, in which only rows of hot keys get a salt and only their lookup rows are copied, once per piece.
    Both ways give the same rows. `how` is 'inner', 'left', 'left_semi' or 'left_anti'.

    Frequent keys are found by reading the keys of the large table first. Where that costs as much as all of it, as
    for documents that must be parsed, `once` leaves them to adaptive execution, which splits what the shuffle shows to be
    skewed; rows without a key, which match nothing, are spread over all tasks.
    """
    names = [f"_key_{i}" for i in range(len(keys))]
    renamed = lookup.select(
        *[c(k).alias(name) for k, name in zip(keys, names)],
        *[c(name) for name in lookup.columns if name not in keys],
    )

    def matches(name: str, key: str) -> Column:
        return c(key).eqNullSafe(c(name)) if null_safe else c(key) == c(name)

    condition = [matches(name, k) for name, k in zip(names, keys)]
    if is_small(renamed, max_rows):
        return df.join(F.broadcast(renamed), condition, how).drop(*names)

    if once:
        unmatched = F.lit(False) if null_safe else F.greatest(*[c(k).isNull().cast("int") for k in (*keys, keys[0])]) == 1
        row = F.pmod(F.xxhash64(*[c(name) for name in df.columns]), F.lit(salts)).cast("int")
        salted = df.withColumn("_salt", F.when(unmatched, row).otherwise(F.lit(-1)))
        # Never 0: no literal, so that the salt stays one of the columns that the shuffle goes by.
        keyed = renamed.withColumn("_copy", F.when(c(names[0]).isNull() & F.lit(not null_safe), F.lit(0)).otherwise(F.lit(-1)))
        return salted.join(keyed, [*condition, c("_salt") == c("_copy")], how).drop(*names, "_salt", "_copy")

    if [df.schema[k].dataType for k in keys] == [lookup.schema[k].dataType for k in keys]:
        hot = hot_keys(df, keys, salts)
        if not hot:
            return df.join(renamed, condition, how).drop(*names)
        here, there = _pieces(F.xxhash64(*[c(k) for k in keys]), hot), _pieces(F.xxhash64(*map(c, names)), hot)
    else:
        here = there = F.lit(min(salts, BLIND_SALTS))
    # Row content and input partition: the same on a retried task, and different for equal rows
    # of different partitions.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[c(name) for name in df.columns]), here)
    salted = df.withColumn("_salt", spread.cast("int"))
    copies = renamed.withColumn("_copy", F.explode(F.sequence(F.lit(0), there - 1)))
    joined = salted.join(copies, [*condition, c("_salt") == c("_copy")], how)
    return joined.drop(*names, "_salt", "_copy")


def bit_filter(hashes: DataFrame, column: str, count: int) -> Callable[[Column], Column]:
    """A test that all 64-bit hashes of a column pass, and few others: a literal of bounded size.

    `count` is how many distinct hashes there are about; it sets the size.
    """
    words = 64
    while words < min(count // 4, FILTER_WORDS):
        words *= 2
    word = c(column).bitwiseAND(F.lit(words - 1)).cast("int")
    mask = F.expr(f"shiftleft(1L, cast(shiftright(`{column}`, 32) & 63 as int))")
    found = dict(hashes.groupBy(word.alias("word")).agg(F.bit_or(mask)).collect())  # at most FILTER_WORDS rows
    bits = F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(words))), ",").cast("array<bigint>")

    def passes(value: Column) -> Column:
        at = value.bitwiseAND(F.lit(words - 1)).cast("int")
        return F.getbit(F.get(bits, at), F.shiftright(value, 32).bitwiseAND(F.lit(63)).cast("int")) == 1

    return passes
