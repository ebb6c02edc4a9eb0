"""Removal of lines that an earlier line equals or differs from by one word.

Lines are split and hashed once, into a narrow table. Equal lines meet by their hash. Near ones meet by
the variants with one word deleted: two lines are one substitution apart if they give the same variant at
the same word, and one insertion apart if a variant of one is the other. One edit leaves the first or the
last part of a line whole, so only lines that share one with another line are read again and emit
variants, and only without words of the other part. Every step is a grouping with partial aggregates or a
join on hashes; no group of lines is ever brought together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.llm import by_value
from cohortweave.llm.words import Words, _powers, blocks, hash_words, joined, mixed
from cohortweave.sources.workspace import stored

# Lines are compared with near ones from so many words on.
NEAR_WORDS = 5
# Words at either end that are compared first; twice as many for each doubling of the line, half (rounded down) below.
END_WORDS = 5
# Candidate lines are picked in the scan by a bit filter of eight bits each, of at most 2^FILTER_BITS bits
# (16 MB); beyond, more lines pass it than the join after it keeps.
FILTER_BITS = 27
# Bytes of text that are split at once: places of bytes and words take some forty times as much for a while.
LINE_BLOCK_BYTES = 1_500_000

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Where a line stands. Rows of one id and text are one document.
_PLACE = ("doc_id", "row_hash", "line_no")
_DIGEST = "line_no int, h1 long, h2 long, n int, head long, tail long, shorter_head long, shorter_tail long"

_SPACE, _TAB = 0x20, 0x09
_BREAK = 0x0A
_BLANK = np.isin(np.arange(256), [0x20, 0x09, 0x0D, 0x0B, 0x0C])


@dataclass
class Lines:
    """Trimmed lines of a block that are not blank: byte ranges in `data`, where tabs are spaces, and their row and number."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    no: np.ndarray

    def hashes(self, seed: int) -> np.ndarray:
        return hash_words(Words(self.data, self.starts, self.ends, self.row, np.zeros(0, np.int64)), seed)


def find_lines(texts: pa.Array) -> Lines:
    """Lines of every text, split at \\n; spaces and tabs around them do not count."""
    data, offsets = joined(texts)
    size = int(offsets[-1])
    data = np.where(data == _TAB, np.uint8(_SPACE), data)
    breaks = np.flatnonzero(data[:size] == _BREAK)
    # The end of a text comes before a line break that begins the next one.
    ends = np.concatenate([offsets[1:], breaks])
    of_text = np.concatenate([np.ones(len(offsets) - 1, bool), np.zeros(len(breaks), bool)])
    order = np.lexsort((~of_text, ends))
    ends, of_text = ends[order], of_text[order]
    starts = np.concatenate([[0], ends[:-1] + ~of_text[:-1]])[: len(ends)]
    row = np.concatenate([[0], np.cumsum(of_text)[:-1]])[: len(ends)]
    no = np.arange(len(ends)) - np.searchsorted(row, row)
    solid = np.flatnonzero(data[:size] != _SPACE)
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    inked = np.concatenate([[0], np.cumsum(~_BLANK[data[:size]])])
    kept = np.flatnonzero(inked[ends] > inked[starts])
    return Lines(data, solid[first[kept]], solid[last[kept] - 1] + 1, row[kept], no[kept])


def end_words(n: np.ndarray) -> np.ndarray:
    """Words at either end of which one end must be whole if a line of n words has one edit."""
    return (END_WORDS * 2.0 ** np.floor(np.log2(n / (2 * END_WORDS)))).astype(np.int64)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each line and of its first and last words, as many as it and a line of one word less compare."""
    for rows in blocks(batches, "text", LINE_BLOCK_BYTES):
        lines = find_lines(rows.column("text"))
        spaces = np.flatnonzero(lines.data[: int(lines.ends[-1]) if len(lines.ends) else 0] == _SPACE)
        line = np.searchsorted(lines.starts, spaces, side="right") - 1
        spaces = spaces[(line >= 0) & (spaces < lines.ends[np.maximum(line, 0)])] if len(lines.ends) else spaces
        starts, ends = np.sort(np.concatenate([lines.starts, spaces + 1])), np.sort(np.concatenate([lines.ends, spaces]))
        first = np.searchsorted(starts, lines.starts)
        last = np.append(first[1:], len(starts)) if len(first) else first
        n = last - first
        h = hash_words(Words(lines.data, starts, ends, np.zeros(len(starts), np.int64), first))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(h * _powers(int(_BASE), len(h)), dtype=np.uint64)])
        back = _powers(int(_INVERSE), len(h) + 1)

        def part(at: np.ndarray, k: np.ndarray, salt: int) -> np.ndarray:
            return mixed((sums[at + k] - sums[at]) * back[at] + (k.astype(np.uint64) * np.uint64(2) + np.uint64(salt)) * _BASE).view(np.int64)

        k = end_words(n)
        less = np.where(n > NEAR_WORDS, end_words(np.maximum(n - 1, 1)), k)
        near = n >= NEAR_WORDS
        same = less == k
        keys = [pa.array(part(at, w, salt), mask=hide) for w, hide in ((np.where(near, k, 0), ~near), (np.where(near, less, 0), ~near | same))
                for salt, at in ((0, first), (1, last - w))]
        yield pa.RecordBatch.from_arrays(
            [*[rows.column(c).take(pa.array(lines.row)) for c in ("doc_id", "text_hash", "row_hash")], pa.array(lines.no.astype(np.int32)),
             pa.array(lines.hashes(0).view(np.int64)), pa.array(lines.hashes(1).view(np.int64)), pa.array(n.astype(np.int32)), *keys],
            names=["doc_id", "text_hash", "row_hash", "line_no", "h1", "h2", "n", "head", "tail", "shorter_head", "shorter_tail"],
        )


def _reader(bits: np.ndarray, mask: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lines whose place is in the filter, with their words."""
        for rows in blocks(batches, "text", LINE_BLOCK_BYTES):
            lines = find_lines(rows.column("text"))
            h1 = lines.hashes(0).view(np.int64)
            row_hash = rows.column("row_hash").to_numpy()[lines.row]
            slot = (h1 ^ row_hash ^ lines.no) & mask
            wanted = np.flatnonzero((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1))
            text = [lines.data[a:b].tobytes().decode() for a, b in zip(lines.starts[wanted], lines.ends[wanted])]
            at = pa.array(lines.row[wanted])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(at), rows.column("row_hash").take(at), pa.array(lines.no[wanted].astype(np.int32)),
                 pa.array(h1[wanted]), pa.array(text, pa.string())],
                names=["doc_id", "row_hash", "line_no", "h1", "line"],
            )

    return read


def _filter_of(places: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Bits at the hash of each place, and the mask of the hash. At most 2^(FILTER_BITS - 6) words are collected."""
    width = min(FILTER_BITS, max(6, (8 * max(n, 1)).bit_length()))
    slot = F.col("h1").bitwiseXOR(F.col("row_hash")).bitwiseXOR(F.col("line_no").cast("long")).bitwiseAND(F.lit((1 << width) - 1))
    words = places.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    ).toArrow()
    bits = np.zeros(1 << (width - 6), np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bits, (1 << width) - 1


def _place() -> Column:
    return F.struct(*_PLACE)


def _line_words(line: Column) -> Column:
    return F.split(line, " ")


def _without(words: Column, i: Column) -> Column:
    """The words but the i-th, counted from 1; all of them for 0."""
    rest = F.concat(F.slice(words, F.lit(1), F.greatest(i - 1, F.lit(0))), F.slice(words, i + 1, F.size(words)))
    return F.when(i == 0, words).otherwise(rest)


def _end_words(n: Column) -> Column:
    return (END_WORDS * F.pow(F.lit(2), F.floor(F.log2(n / (2 * END_WORDS))))).cast("int")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each line whole (i = 0) and without its i-th word, where that word can be the edited one."""
    for rows in blocks(batches, "line", LINE_BLOCK_BYTES):
        which, cuts, keys = [], [], []
        heads, tails = rows.column("head_k").to_pylist(), rows.column("tail_k").to_pylist()
        for at, line in enumerate(rows.column("line").to_pylist()):
            words = line.split(" ")
            n = len(words)
            h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
            power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(h * power[:n], dtype=np.uint64)])
            i = np.arange(1, n + 1)
            i = i[(i > (heads[at] or n)) | (i <= n - (tails[at] or n))]
            # Words after the cut move up by one place.
            cut = sums[i - 1] + (sums[n] - sums[i]) * _INVERSE
            size = np.concatenate([[n], np.full(len(i), n - 1)]).astype(np.uint64)
            keys.append(mixed(np.concatenate([sums[n:], cut]) + size * _BASE))
            cuts.append(np.concatenate([[0], i]))
            which.append(np.full(len(i) + 1, at))
        at = pa.array(np.concatenate(which))
        yield pa.RecordBatch.from_arrays(
            [rows.column("h1").take(at), rows.column("first").take(at), pa.array(np.concatenate(cuts), pa.int32()), pa.array(np.concatenate(keys).view(np.int64))],
            names=["h1", "first", "i", "key"],
        )


def _near(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """h1 of the lines that an earlier line is one word away from."""
    whole, shorter = _end_words(F.col("n")), _end_words(F.col("n") - 1)

    def end(key: str, k: Column, head: bool) -> Column:
        return F.struct(F.col(key).alias("key"), k.alias("k"), F.lit(head).alias("head"))

    ends = classes.filter(F.col("n") >= NEAR_WORDS).select("h1", F.explode(F.array(
        end("head", whole, True), end("tail", whole, False), end("shorter_head", shorter, True), end("shorter_tail", shorter, False),
    )).alias("end")).select("h1", "end.*").filter("key IS NOT NULL")
    shared_ends = ends.groupBy("key").agg(F.count("*").alias("_k")).filter("_k > 1").select("key")
    cuts = (
        ends.join(shared_ends, "key", "left_semi").groupBy("h1")
        .agg(F.min(F.when(F.col("head"), F.col("k"))).alias("head_k"), F.min(F.when(~F.col("head"), F.col("k"))).alias("tail_k"))
    )
    candidates = stored(classes.select("h1", "first").join(cuts, "h1").select("h1", "first", "head_k", "tail_k"), "line-candidates")
    bits, mask = _filter_of(candidates.select("h1", "first.*"), candidates.count())
    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.select("doc_id", "row_hash", "text").mapInArrow(_reader(bits, mask), f"doc_id {kind}, row_hash long, line_no int, h1 long, line string")
    texts = (
        picked.join(candidates, "h1").filter(_place().eqNullSafe(F.col("first")))
        .groupBy("h1", "first", "head_k", "tail_k").agg(F.min("line").alias("line"))
    )
    texts = stored(texts, "line-texts")

    place = texts.schema["first"].dataType.simpleString()
    variants = texts.select("h1", "first", "head_k", "tail_k", "line").mapInArrow(_variants, f"h1 long, first {place}, i int, key long")
    met = variants.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key")
    variants = stored(variants.join(met, "key", "left_semi"), "line-variants")
    line = F.struct("first", "h1")
    by_cut = variants.groupBy("key", "i").agg(F.min(line).alias("earliest"), F.count("*").alias("k"))
    shared = by_cut.groupBy("key").agg(
        F.sum("k").alias("k"),
        F.min(F.when(F.col("i") == 0, F.struct("earliest", "i"))).alias("whole"),
        F.min(F.when(F.col("i") > 0, F.struct("earliest", "i"))).alias("cut"),
        F.map_from_entries(F.collect_list(F.when(F.col("i") > 0, F.struct("i", "earliest")))).alias("by_cut"),
    ).filter("k > 1").drop("k")  # a key has at most as many entries as a line has words
    partner = F.when(F.col("i") == 0, F.col("cut")).otherwise(F.least(
        F.struct(F.col("by_cut")[F.col("i")].alias("earliest"), F.col("i").alias("i")), F.col("whole")
    ))
    pairs = (
        variants.join(shared, "key").select("h1", "first", "i", partner.alias("other"))
        .filter(F.col("other.earliest.first") < F.col("first"))
        .select("h1", "i", F.col("other.earliest.h1").alias("other_h1"), F.col("other.i").alias("other_i"))
    )
    other = texts.select(F.col("h1").alias("other_h1"), F.col("line").alias("other_line"))
    verified = pairs.join(texts.select("h1", "line"), "h1").join(other, "other_h1").filter(
        _without(_line_words(F.col("line")), F.col("i")) == _without(_line_words(F.col("other_line")), F.col("other_i"))
    )
    return verified.select("h1").distinct()


def removed_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, line_nos): the lines to remove of each document that loses any.

    Lines are split at \\n and trimmed of spaces; tabs count as spaces, and words are what single spaces
    separate. Documents come in the order of doc_id (null first) and then of a hash of the text, lines in
    their own. A line that is not blank goes if an equal line comes earlier; one of NEAR_WORDS words also
    if any earlier line of as many words becomes equal by replacing, adding or deleting one word, whether
    or not that line itself goes. A line without spaces is one word, so only equal ones go. Equal rows are
    one document: they lose the same lines.
    """
    source = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(source).alias("text_hash"),
        F.xxhash64(F.col(f"`{doc_id}`"), source).alias("row_hash"), source.alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    lines = stored(rows.mapInArrow(_digests, f"doc_id {kind}, text_hash long, row_hash long, {_DIGEST}"), "lines")
    keys = [F.any_value(k).alias(k) for k in ("n", "head", "tail", "shorter_head", "shorter_tail")]
    classes = lines.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.count("*").alias("places"), *keys)
    classes = stored(classes, "line-classes")
    near = _near(rows, classes).withColumn("near", F.lit(True))
    matter = (
        classes.select("h1", "h2", "first", "places").join(near, "h1", "left").filter((F.col("places") > 1) | F.col("near"))
        .select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    )
    gone = lines.select("doc_id", "text_hash", "row_hash", "line_no", "h1", "h2").join(matter, ["h1", "h2"]).filter(
        F.col("near") | ~_place().eqNullSafe(F.col("first"))
    )
    return gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line_no")).alias("line_nos"))


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without removed lines, and how many each lost (`n_removed_lines`).

    Documents keep their remaining lines, joined by \\n, and stay even if none is left. A null text
    stays null. A column named like the added one is replaced.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "n_removed_lines"])
    gone = removed_lines(docs, doc_id=doc_id, text=text)
    same = F.col(f"d.{doc_id}").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(F.col(f"d.{text}")) == F.col("g.text_hash"))
    joined = docs.alias("d").join(gone.alias("g"), same, "left")
    source, nos = F.col(f"d.{text}"), F.col("g.line_nos")
    kept = F.array_join(F.filter(F.split(source, "\n"), lambda x, i: ~F.array_contains(nos, i)), "\n")
    cleaned = F.when(nos.isNull(), source).otherwise(kept)
    columns = [cleaned.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns]
    return joined.select(*columns, F.coalesce(F.size(nos), F.lit(0)).cast("long").alias("n_removed_lines"))


by_value(__name__)
