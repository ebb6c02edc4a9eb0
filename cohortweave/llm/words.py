"""Words, their hashes and their windows over a batch of texts at once, as arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from cohortweave.llm import by_value

# Texts are worked on in blocks of about this many bytes, so a task's memory does not grow with its partition.
BLOCK_BYTES = 6_000_000
# Where much is derived of each word: less memory, and arrays that stay in the processor's cache.
SMALL_BLOCK_BYTES = 500_000
# Longer words are hashed one by one.
LONG_WORD = 1_024

SPACES = (0x20, *range(0x09, 0x0E))
_BYTES = np.arange(256)
# Bytes of words: all but white space, or ASCII letters, digits and everything beyond ASCII.
NOT_SPACE = ~np.isin(_BYTES, SPACES)
LETTERS = (_BYTES >= 0x80) | np.isin(_BYTES, list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


@dataclass
class Words:
    """Words of a block: byte ranges in `data`, the row of each, and the first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    @property
    def per_row(self) -> np.ndarray:
        return np.diff(self.first)


def blocks(batches: Iterable[pa.RecordBatch], text: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `size` bytes of text, at least one row each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another and padded, and where each begins. Null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    buffer = texts.buffers()
    offsets = np.frombuffer(buffer[1], np.int64, len(texts) + 1, texts.offset * 8)
    size = int(offsets[-1] - offsets[0])
    data = np.zeros(size + 16, np.uint8)
    if size:
        data[:size] = np.frombuffer(buffer[2], np.uint8, size, int(offsets[0]))
    return data, offsets - offsets[0]


def find_words(texts: pa.Array, lower: bool = False, of: np.ndarray = NOT_SPACE) -> Words:
    """Words of every text, `[^\\x20\\x09-\\x0D]+` unless other bytes are given; `lower` maps A-Z to a-z first."""
    data, offsets = joined(texts)
    if lower:
        data = _LOWER[data]
    return runs(data, of[data[: int(offsets[-1])]], offsets)


def runs(data: np.ndarray, inside: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of the bytes that are `inside`, none beyond a row."""
    size = len(inside)
    begins = np.zeros(size + 1, bool)
    begins[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | begins[1:size]
    end[:-1] &= ~inside[1:] | begins[1:size]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(end) + 1
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, ends, row, first)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values whose bits all depend on all bits."""
    x = values ^ (values >> np.uint64(30))
    x *= _MIX_A
    x ^= x >> np.uint64(27)
    x *= _MIX_B
    x ^= x >> np.uint64(31)
    return x


def hash_words(words: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    lengths = words.ends - words.starts
    at_byte = np.ndarray(max(0, len(words.data) - 7), "<u8", words.data, strides=(1,))
    state = mixed(lengths.astype(np.uint64) + np.uint64(seed) * _ODD + _ODD)
    longest = int(min(lengths.max(initial=0), LONG_WORD))
    todo = np.arange(len(lengths))
    for done in range(0, longest, 8):
        todo = todo[lengths[todo] > done]
        rest = np.minimum(lengths[todo] - done, 8).astype(np.uint64)
        piece = at_byte[words.starts[todo] + done] & (~np.uint64(0) >> (np.uint64(64) - rest * np.uint64(8)))
        state[todo] = mixed((state[todo] ^ piece) * _ODD + _MIX_A)
    for i in np.flatnonzero(lengths > LONG_WORD):
        state[i] = xxhash.xxh3_64_intdigest(words.data[words.starts[i] : words.ends[i]].tobytes(), seed)
    return state


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp value of the window of `width` words at every position, by prefix sums modulo 2^64.

    The value is sum(hash[i + j] * base^j), the same wherever the window stands; `base` is odd.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * _powers(base, n), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return (sums[width:] - sums[:-width]) * _powers(inverse, n - width + 1)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values. By sorting alone: numpy's own `unique` goes through a hash set, which takes more time and memory."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


def inside_row(words: Words, width: int) -> np.ndarray:
    """Whether the window at each position lies within one row."""
    if len(words.row) < width:
        return np.zeros(0, bool)
    return words.row[width - 1 :] == words.row[: len(words.row) - width + 1]


by_value(__name__)
