"""Benchmark passages in training documents, found with DataFrame functions alone.

Benchmark word windows make up a hash set. Every window of every document is tested against a bit
filter of their hashes inside the scan; only windows that pass it meet the set itself, by hash and
by their words, so the result is exact and clean documents move no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 10
# The filter has 64 bits to a slot; more windows than it was made for only let more pass on to the join.
MAX_SLOTS = 1 << 18
# Window sets of at most this many rows (some 200 bytes each) are broadcast; larger ones are joined by a shuffle.
BROADCAST_WINDOWS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Between words, before A-Z are lowered; and what words are made of.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WITHIN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _with(value: Column, use) -> Column:
    """`use` of a value that is computed once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def normal_words(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lowered, and no other letter."""

    def lowered(word: Column) -> Column:
        plain = F.length(word) == F.octet_length(word)
        return F.when(plain, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))

    return F.transform(raw_words(text), lowered)


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(hash, words, items): each distinct window of the benchmark with the items that have it.

    An item of fewer words is one window; an item without words has none.
    """
    words = benchmark.select(F.col(item).cast("string").alias("item"), normal_words(F.col(text)).alias("w"))
    n = F.size("w")
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))))
    return (
        words.select("item", "w", F.explode(starts).alias("i"))
        .select("item", F.slice("w", F.col("i"), F.lit(width)).alias("words"))
        .groupBy(F.xxhash64("words").alias("hash"), "words").agg(F.collect_set("item").alias("items"))
    )


def _filter(windows: DataFrame, count: int) -> tuple[Column, int]:
    """Bit filter of the hashes as a literal, and its number of slots."""
    slots = 64
    while slots < min(count // 4, MAX_SLOTS):
        slots *= 2
    slot = F.col("hash").bitwiseAND(F.lit(slots - 1))
    # "SHIFTLEFT" of a computed distance is plain SQL.
    rows = windows.groupBy(slot.cast("int").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftright(hash, 32) & 63 as int))")).alias("bits"))
    found = dict(rows.collect())  # at most MAX_SLOTS rows
    literal = ",".join(str(found.get(i, 0)) for i in range(slots))
    return F.split(F.lit(literal), ",").cast("array<bigint>"), slots


def _passing(w: Column, width: int, bits: Column, slots: int) -> Column:
    """The windows of `width` words that pass the filter."""
    n = F.size(w)
    every = F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(
        every, lambda i: F.struct(i.alias("start"), F.xxhash64(F.slice(w, i, F.lit(width))).alias("hash"))
    )

    def test(x: Column) -> Column:
        slot = F.get(bits, x["hash"].bitwiseAND(F.lit(slots - 1)).cast("int"))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftright", x["hash"], F.lit(32)).bitwiseAND(F.lit(63)).cast("int"))
        return slot.bitwiseAND(mask) != 0

    return F.transform(
        F.filter(hashed, test),
        lambda x: F.struct(x["start"].alias("start"), x["hash"].alias("hash"), F.slice(w, x["start"], F.lit(width)).alias("words")),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", width: int = WIDTH,
) -> DataFrame:
    """Per document: key, n_words, hits (merged word intervals, from 0, end exclusive), n_hit, items.

    A word is hit if it lies inside any occurrence of a benchmark window; items are the sorted ids
    whose windows occur. `text_hash` tells documents of one id apart; equal rows give equal rows. A
    null text has no words, a null id is kept as null.
    """
    windows = benchmark_windows(benchmark, item, item_text, width)
    sizes = {r["size"]: r["n"] for r in windows.groupBy(F.size("words").alias("size")).agg(F.count("*").alias("n")).collect()}
    count = sum(sizes.values())  # at most `width` rows were collected
    bits, slots = _filter(windows, count)
    source = F.col(text)
    analysed = _with(
        normal_words(source),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.concat(*[_passing(w, k, bits, slots) for k in sorted(sizes)] or [_passing(w, width, bits, slots)]).alias("hits"),
        ),
    )
    scanned = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(source).alias("text_hash"), analysed.alias("a")).select(
        "doc_id", "text_hash", "a.n_words", F.posexplode_outer("a.hits").alias("at", "hit")
    ).select(
        "doc_id", "text_hash", "n_words", "at", "hit.start", "hit.hash", "hit.words"
    )
    if count <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)
    verified = scanned.join(windows, ["hash", "words"], "left")
    found = F.col("items").isNotNull()
    per_doc = verified.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count(F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(found, F.struct((F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.size("words")).alias("end"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def merge(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        touches = (F.size(done) > 0) & (x["start"] <= last["end"])
        return F.when(touches, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    merged = per_doc.withColumn("hits", F.aggregate("hits", empty, merge))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return merged.select(
        "doc_id", "text_hash", "n_words", "hits", n_hit.alias("n_hit"), "items",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", text: str = "text", **how) -> DataFrame:
    """The documents without contaminated ones (`remove="documents"`) or without hit words (`"spans"`).

    Cutting spans leaves all other characters in place; a hit word goes with what separates it from
    the next. Columns stay as they are; null texts are clean.
    """
    key = ["doc_id", "text_hash"]
    found = contamination(docs, benchmark, text=text, **how).filter(F.col("n_hit") > 0).select(*key, "hits").dropDuplicates(key)
    doc_id = how.get("doc_id", "doc_id")
    same = F.col(f"d.{doc_id}").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64(F.col(f"d.{text}")) == F.col("f.text_hash"))
    if remove == "documents":
        return docs.alias("d").join(found.alias("f"), same, "left_anti")
    joined = docs.alias("d").join(found.alias("f"), same, "left")
    source = F.col(f"d.{text}")

    def kept(i: Column) -> Column:
        hit = F.exists("f.hits", lambda x: (x["start"] <= i) & (i < x["end"]))
        return ~hit

    def cut(w: Column, between: Column) -> Column:
        parts = F.transform(w, lambda word, i: F.when(kept(i), F.concat(word, F.get(between, i + 1))).otherwise(""))
        return F.concat(F.get(between, F.lit(0)), F.array_join(parts, ""))

    between = F.split(source, _WITHIN)
    cleaned = F.when(F.col("f.hits").isNull(), source).otherwise(_with(raw_words(source), lambda w: _with(between, lambda b: cut(w, b))))
    return joined.select(*[cleaned.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])


