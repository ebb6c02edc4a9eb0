"""Spelling variants: words one code point apart, found in bit-sliced position indexes.

The corpus gives the vocabulary with its counts. Words that differ by one edit share the first or the
last half of the shorter one, so the vocabulary is cut into blocks by length and half. A block keeps
one bitset over its words per (position, letter). A word is looked up in all of its block at once:
going through its letters, three bitsets hold the words that agree so far without an error (Z), with
one replaced letter (S) and with one letter more (I, which reads the index one position further).

    I <- (I | Z) & bits[i + 1, letter]    S <- S & bits[i, letter] | Z & ~bits[i, letter]    Z <- Z & bits[i, letter]

Words with one letter less are found from the other side. Blocks that a frequent half makes too long
are split, and the words looked up go to each of the parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm import by_value
from cohortweave.llm.words import _LOWER, Words, blocks, hash_words, joined, runs
from cohortweave.sources.workspace import stored

# Words are compared from so many code points and occurrences on.
LEAST_LENGTH = 7
LEAST_COUNT = 2
# A form is this many times as frequent as its variant.
RATIO = 10
# One occurrence in so many, chosen by a hash of document and word, loses a letter.
SLIP = 31
# Code points that a block of the index holds, about; longer blocks are split.
BLOCK_CHARS = 24_000
# Words that are looked up together.
_TOGETHER = 256
# Longer words (bytes) get their hash one by one.
_TABLE_BYTES = 64

_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
# First byte of U+00C0 to U+00FF in UTF-8.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def letter_runs(texts: pa.Array) -> Words:
    """Maximal runs `[A-Za-z\\u00C0-\\u00FF]+` of every text, A-Z lowered."""
    data, offsets = joined(texts)
    size = int(offsets[-1])
    lead = data[:size] == _LEAD
    inside = _LETTER[data[:size]] | lead
    inside[1:] |= lead[:-1]
    return runs(_LOWER[data], inside, offsets)


def _crcs(words: Words, prefixes: list[bytes], first: np.ndarray, which: np.ndarray) -> np.ndarray:
    """crc32 of prefix and word at every occurrence.

    crc32(a + b) is the value of a, moved over as many zero bytes as b has, xor the value of b. So each
    distinct word is hashed once, and each prefix is moved over every length once.
    """
    size = words.ends - words.starts
    of_word = np.array([zlib.crc32(words.data[a:b]) for a, b in zip(words.starts[first], words.ends[first])], np.uint32)
    table = _crc_table()
    moved = np.empty((min(int(size.max(initial=0)), _TABLE_BYTES) + 1, len(prefixes)), np.uint32)
    moved[0] = [zlib.crc32(p) for p in prefixes]
    for n in range(1, len(moved)):
        moved[n] = table[moved[n - 1] & np.uint32(0xFF)] ^ (moved[n - 1] >> np.uint32(8))
    out = moved[np.minimum(size, _TABLE_BYTES), words.row] ^ of_word[which]
    for i in np.flatnonzero(size > _TABLE_BYTES):
        out[i] = zlib.crc32(words.data[words.starts[i] : words.ends[i]], zlib.crc32(prefixes[words.row[i]]))
    return out


def _counter(least: int, slip: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            words = letter_runs(rows.column("text"))
            points = np.concatenate([[0], np.cumsum(words.data != _LEAD, dtype=np.int64)])
            n = points[words.ends] - points[words.starts]
            long = n >= least
            words, n = Words(words.data, words.starts[long], words.ends[long], words.row[long], words.first), n[long]
            if not len(n):
                continue
            _, first, which = np.unique(hash_words(words), return_index=True, return_inverse=True)
            text = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts[first], words.ends[first])]
            prefixes = [b"%s:" % (b"" if i is None else str(i).encode()) for i in rows.column("doc_id").to_pylist()]
            crc = _crcs(words, prefixes, first, which).astype(np.int64)
            hit = crc % slip == 0 if slip else np.zeros(len(crc), bool)
            counts = np.bincount(which[~hit], minlength=len(first))
            out = [(text[i], int(counts[i])) for i in np.flatnonzero(counts)]
            cuts, times = np.unique(np.stack([which[hit], crc[hit] % n[hit]]), axis=1, return_counts=True)
            out += [(text[i][:at] + text[i][at + 1 :], int(k)) for i, at, k in zip(*cuts, times) if n[first[i]] > least]
            if out:
                spelled, k = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(spelled, pa.string()), pa.array(k, pa.int64())], names=["word", "n"])

    return count


def vocabulary(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    slip: int = SLIP,
) -> DataFrame:
    """(word, n): the words of at least `least_length` code points and `least_count` occurrences.

    With `slip`, an occurrence whose crc32(`<doc_id>:<word>`) it divides is counted without the code point
    at that value modulo the word's length, as if a letter had been missed; 0 counts all as they stand.
    Null texts have no words, a null doc_id is written as nothing, and repeated rows count again.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_counter(least_length, slip), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


class PositionIndex:
    """Bitsets over words of `length` code points and one more: of each position and letter, who has it there."""

    def __init__(self, words: list[str], length: int) -> None:
        self.length = length
        codes = np.array([np.frombuffer(w.ljust(length + 1, "\0").encode("utf-32-le"), np.uint32) for w in words])
        self.letters, codes = np.unique(codes, return_inverse=True)
        codes = codes.reshape(len(words), length + 1)
        self.width = -(-len(words) // 64)
        # The last letter is one that no word has.
        self.bits = np.zeros((length + 1, len(self.letters) + 1, self.width), np.uint64)
        for i in range(length + 1):
            has = np.zeros((len(self.letters), self.width * 64), bool)
            has[codes[:, i], np.arange(len(words))] = True
            self.bits[i, :-1] = self._pack(has)
        longer = np.array([len(w) > length for w in words])
        self.same, self.longer = (self._pack(np.pad(m, (0, self.width * 64 - len(words)))[None])[0] for m in (~longer, longer))

    @staticmethod
    def _pack(has: np.ndarray) -> np.ndarray:
        return np.packbits(has, axis=1, bitorder="little").view(np.uint64)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(i, j): words[i], of `length` code points, is one letter replaced or one added away from indexed word j."""
        codes = np.array([np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in words])
        at = np.searchsorted(self.letters, codes)
        known = self.letters[np.minimum(at, len(self.letters) - 1)] == codes
        at = np.where(known, at, len(self.letters))
        none = np.full((len(words), self.width), ~np.uint64(0))
        replaced = np.zeros_like(none)
        added = np.zeros_like(none)
        for i in range(self.length):
            here = self.bits[i, at[:, i]]
            added = (added | none) & self.bits[i + 1, at[:, i]]
            replaced = (replaced & here) | (none & ~here)
            none &= here
        found = (replaced & self.same) | ((added | none) & self.longer)
        i, block = np.nonzero(found)
        which, bit = np.nonzero(np.unpackbits(found[i, block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return i[which], block[which] * 64 + bit


def _looked_up(group: pd.DataFrame) -> pd.DataFrame:
    """Pairs one edit apart of a block: the words looked up have its length, the indexed ones may have one more."""
    length, head = int(group["length"].iloc[0]), bool(group["head"].iloc[0])
    half = length // 2
    indexed, asked = group[group["indexed"]], group[group["asked"]]
    out = []
    if len(asked) and len(indexed) and len(group) > 1:
        words, n = indexed["word"].tolist(), indexed["n"].tolist()
        index = PositionIndex(words, length)
        queries, times = asked["word"].tolist(), asked["n"].tolist()
        for start in range(0, len(queries), _TOGETHER):
            for i, j in zip(*index.near(queries[start : start + _TOGETHER])):
                a, b = queries[start + i], words[j]
                # A pair with the same first half is found there alone, and blocks hold several halves.
                same_head = a[:half] == b[:half]
                if same_head if head else not same_head and a[-half:] == b[-half:]:
                    out.append((a, times[start + i], b, n[j]))
                    if len(b) > length:
                        out.append((b, n[j], a, times[start + i]))
    return pd.DataFrame(out, columns=["word", "n", "near", "near_n"]).astype({"n": "int64", "near_n": "int64"})


def near_words(words: DataFrame, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, n, near, near_n): each ordered pair of distinct words exactly one code point edit apart, once.

    `words` has one row per word and count; words of one code point are left out. Blocks hold whole
    halves, many short ones together, and are split where one half has more than `block_chars`.
    """
    size = F.length("word")
    of = F.explode(F.array(*[
        F.struct((size - less).alias("length"), F.lit(head).alias("head")) for less in (0, 1) for head in (True, False)
    ])).alias("of")
    half = F.expr("CAST(of.length DIV 2 AS INT)")
    places = (
        words.filter(size > 1).select("word", "n", of).filter("of.length > 1")
        .select("word", "n", "of.length", "of.head", F.when(F.col("of.head"), F.left("word", half)).otherwise(F.right("word", half)).alias("half"))
    )
    # One row per length, so the number of blocks is a small table.
    lengths = places.groupBy("length", "head").agg(F.ceil(F.sum(F.length("word")) / block_chars).alias("blocks"))
    placed = places.join(lengths, ["length", "head"]).select(
        "word", "n", "length", "head", F.pmod(F.xxhash64("half"), F.col("blocks")).alias("block")
    )
    key = ["length", "head", "block"]
    sizes = placed.groupBy(*key).agg(F.sum(F.length("word")).alias("chars"), F.count("*").alias("members"))
    parts = sizes.filter("members > 1").select(*key, F.ceil(F.col("chars") / (2 * block_chars)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("word", "head"), F.col("parts"))
    rows = placed.join(parts, key).select(
        "word", "n", *key, (F.length("word") == F.col("length")).alias("asked"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    ).withColumn("indexed", F.col("own") == F.col("part")).filter("asked OR indexed")
    return rows.groupBy(*key, "part").applyInPandas(_looked_up, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following forms ends. Forms grow in frequency, so chains are short and have no cycle."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        reached = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reached


def spelling_groups(words: DataFrame, *, ratio: int = RATIO, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n).

    The form of a word is its near word of largest n (ties: smallest in code point order) if that is at
    least `ratio` times the word's own n, else null; `root` follows forms to the last, the word itself if
    it has none. An empty vocabulary gives no rows.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    pairs = near_words(words, block_chars=block_chars)
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("_n"), F.col("near").alias("form"))))
    found = pairs.unionByName(alone).groupBy("word", "n").agg(F.count("near").alias("n_near"), best.alias("best"))
    enough = -F.col("best._n") >= ratio * F.col("n")
    found = stored(found.select(
        "word", "n", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best._n")).alias("form_n")
    ), "spelling-forms")
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


by_value(__name__)
