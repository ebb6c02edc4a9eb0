"""Removal of passages that occur more than once: every word window is hashed and counted.

Each task hashes all windows of its texts (Rabin-Karp) and sends the distinct values, sorted and
split by their leading bits, to the task that counts that range. It answers with one bit per value:
does the window start anywhere else? The answers meet their texts again, and repeated windows that
touch merge into maximal intervals. A value that a third of all texts hold is sent once per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm import by_value
from cohortweave.llm.words import blocks, find_words, hash_words, inside_row, mixed, rolling

WIDTH = 35
# Two odd bases; a window is told by 64 bits of the first value and 16 of the second.
BASES = (0xD1342543DE82EF95, 0x9E3779B97F4A7C15)
# Windows that one group counts, about; characters that make up a word, about.
GROUP_WINDOWS = 1_000_000
WORD_CHARS = 6

_SCHEMA = "bucket long, block long, payload binary"


def _windows(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of all windows, in the order of their values, with both parts of the value."""
    words = find_words(texts)
    hashes = hash_words(words)
    at = np.flatnonzero(inside_row(words, width))
    value = mixed(rolling(hashes, width, BASES[0])[at])
    check = (mixed(rolling(hashes, width, BASES[1])[at]) >> np.uint64(48)).astype(np.uint16)
    order = np.argsort(value, kind="stable")
    return at[order], value[order], check[order]


def _runs(value: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Where runs of equal values start in a sorted array."""
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (check[1:] != check[:-1])
    return np.flatnonzero(new)


def _pack(value: np.ndarray, check: np.ndarray, often: np.ndarray) -> bytes:
    """Sorted values as byte planes of their differences, so that only random bytes cost space."""
    planes = np.diff(value, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    raw = planes.tobytes() + check.tobytes() + np.packbits(often).tobytes()
    return len(value).to_bytes(8, "little") + zstandard.compress(raw, 1)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, raw = int.from_bytes(payload[:8], "little"), zstandard.decompress(payload[8:])
    planes = np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n)
    value = np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)
    check = np.frombuffer(raw, np.uint16, n, 8 * n)
    often = np.unpackbits(np.frombuffer(raw, np.uint8, offset=10 * n), count=n).astype(bool)
    return value, check, often


def _bounds(value: np.ndarray, bits: int) -> np.ndarray:
    edges = (np.arange(1, 1 << bits, dtype=np.uint64)) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(value, edges), [len(value)]])


def _sender(width: int, bits: int, text: str):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for rows in blocks(batches, text):
            _, value, check = _windows(rows.column(text), width)
            starts = _runs(value, check)
            often = np.diff(starts, append=len(value)) > 1
            value, check = value[starts], check[starts]
            bounds = _bounds(value, bits)
            out = [(-1 - block, block, _to_bytes(rows))]
            for bucket in np.flatnonzero(np.diff(bounds)):
                part = slice(bounds[bucket], bounds[bucket + 1])
                out.append((int(bucket), block, _pack(value[part], check[part], often[part])))
            block += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                names=["bucket", "block", "payload"],
            )

    return send


def _to_bytes(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _count(group: pd.DataFrame) -> pd.DataFrame:
    """Of one range of values: which values of each block occur more than once. Texts pass through."""
    bucket = int(group["bucket"].iloc[0])
    if bucket < 0:
        return group
    parts = [_unpack(p) for p in group["payload"]]
    sizes = [len(p[0]) for p in parts]
    value, check, often = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(value, kind="stable")
    starts = _runs(value[order], check[order])
    lengths = np.diff(starts, append=len(value))
    repeated = np.empty(len(value), bool)
    repeated[order] = np.repeat((lengths > 1) | np.logical_or.reduceat(often[order], starts), lengths)
    answers = []
    for block, bits in zip(group["block"], np.split(repeated, np.cumsum(sizes)[:-1])):
        if bits.any():
            answers.append((bucket, block, zstandard.compress(np.packbits(bits).tobytes(), 1)))
    return pd.DataFrame(answers, columns=["bucket", "block", "payload"])


def covered_words(marked: np.ndarray, width: int, n: int) -> np.ndarray:
    """Words covered by any of the windows that start at the marked positions."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, marked, 1)
    np.subtract.at(steps, marked + width, 1)
    return np.cumsum(steps[:-1]) > 0


def _receiver(width: int, bits: int, text: str, schema: pa.Schema):
    def receive(group: pa.Table) -> pa.Table:
        buckets, payloads = group.column("bucket").to_pylist(), group.column("payload").to_pylist()
        found = dict(zip(buckets, payloads))
        rows = pa.ipc.open_stream(found.pop(min(buckets))).read_all().combine_chunks().to_batches()[0]
        texts = rows.column(text)
        words = find_words(texts)
        removed = np.zeros(len(words.starts), bool)
        if found:
            at, value, check = _windows(texts, width)
            starts = _runs(value, check)
            bounds = _bounds(value[starts], bits)
            repeated = np.zeros(len(starts), bool)
            for bucket, payload in found.items():
                n = bounds[bucket + 1] - bounds[bucket]
                raw = np.frombuffer(zstandard.decompress(payload), np.uint8)
                repeated[bounds[bucket] : bounds[bucket + 1]] = np.unpackbits(raw, count=n)
            marked = at[np.repeat(repeated, np.diff(starts, append=len(value)))]
            removed = covered_words(marked, width, len(words.starts))
        kept, n_removed = [], []
        for i, content in enumerate(texts.to_pylist()):
            mine = removed[words.first[i] : words.first[i + 1]]
            all_words = (content or "").encode().split()
            kept.append(b" ".join(compress(all_words, ~mine) if mine.any() else all_words).decode())
            n_removed.append(int(mine.sum()))
        columns = [*rows.columns, pa.array(words.per_row, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept)]
        return pa.Table.from_arrays(columns, schema=pa.schema([*rows.schema, *schema]))

    return receive


def n_bits(docs: DataFrame, text: str) -> int:
    """Leading bits by which values are dealt out, from the size of all texts: at least 64 ranges."""
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    return max(6, int(np.ceil(np.log2(chars / WORD_CHARS / GROUP_WINDOWS + 1))))


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The documents with n_words, n_removed and kept_text: the words outside repeated windows.

    A window is `width` consecutive words `[^\\x20\\x09-\\x0D]+` of one row; it is repeated if its word
    sequence also starts anywhere else, in the same row or another. Equal rows repeat each other.
    Texts of fewer words have no window and stay whole. A null or empty text has no words and an
    empty kept_text. Other columns pass through; those named like the added ones are replaced.
    `docs` must give its rows in the same order when it is read again, as stored tables do.

    Windows are told apart by 80 bits of two Rabin-Karp values: with 10^13 windows, some hundred
    of them would be expected to meet another by chance.
    """
    added = ("n_words", "n_removed", "kept_text")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    bits = n_bits(docs, text)
    sent = docs.mapInArrow(_sender(width, bits, text), _SCHEMA)
    counted = sent.groupBy("bucket").applyInPandas(_count, _SCHEMA)
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
         T.StructField("kept_text", T.StringType())]
    )
    new = [pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept_text", pa.string())]
    return counted.groupBy("block").applyInArrow(_receiver(width, bits, text, pa.schema(new)), schema)


def repeats_of(texts: Iterable[str | None], width: int = WIDTH) -> list[tuple[int, int, str]]:
    """The same by brute force on one machine, for tests: (n_words, n_removed, kept_text) per text."""
    rows = [(t or "").encode().split() for t in texts]
    seen: dict[tuple, int] = {}
    for r in rows:
        for i in range(len(r) - width + 1):
            seen[tuple(r[i : i + width])] = seen.get(tuple(r[i : i + width]), 0) + 1
    out = []
    for r in rows:
        gone = [False] * len(r)
        for i in range(len(r) - width + 1):
            if seen[tuple(r[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((len(r), sum(gone), b" ".join(w for w, g in zip(r, gone) if not g).decode()))
    return out


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


by_value(__name__)
