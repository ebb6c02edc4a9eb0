"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm import by_value
from cohortweave.llm.words import LETTERS, SMALL_BLOCK_BYTES, Words, blocks, distinct, find_words, hash_words, mixed

# Features are hashed to 2^BITS coordinates.
BITS = 20
# Labelled rows that a model is fitted on at most: those whose ids hash lowest, each text once.
MAX_LABELLED = 12_000
THRESHOLD = 0.7
# A word's stem is its first bytes: insults that share one are learned together.
STEM_BYTES = 6

_PAIR = np.uint64(0xD1342543DE82EF95)
_SKIP = np.uint64(0x2545F4914F6CDD1D)


@dataclass(frozen=True)
class Ftrl:
    """Step size and its smoothing, penalties, passes over the sample and its order."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0
    epochs: int = 6
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Sparse weights: at most 2^bits of them, whatever the corpus."""

    bias: float
    index: np.ndarray
    weight: np.ndarray
    bits: int = BITS


def features(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every word, word stem, pair of neighbours and pair that skips one word.

    Words are runs of letters, digits and characters beyond ASCII; A-Z count as a-z."""
    h, row = hash_words(words), words.row
    stems = Words(words.data, words.starts, np.minimum(words.ends, words.starts + STEM_BYTES), row, words.first)
    found = [(row, mixed(h)), (row, mixed(hash_words(stems, seed=1)))]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            same = row[gap:] == row[:-gap]
            found.append((row[:-gap][same], mixed(h[:-gap] * factor + h[gap:])[same]))
    rows, values = (np.concatenate(x) for x in zip(*found))
    return rows, (values >> np.uint64(64 - bits)).astype(np.int32)


def _distinct(rows: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = distinct((rows.astype(np.int64) << bits) | at)
    return both >> bits, both & ((1 << bits) - 1)


def train(texts: list[np.ndarray], labels: list[int], how: Ftrl, bits: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias and weights after `epochs` passes; each text is the array of its distinct coordinates.

    Every coordinate has its own step size, which shrinks with the gradients that it has seen; the
    L1 penalty keeps a weight at zero until its gradients add up to more than the penalty.
    """
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.random.default_rng(how.seed)

    def weights(at):
        pull = np.maximum(np.abs(z[at]) - how.l1 * (at != size), 0)
        return -np.sign(z[at]) * pull / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2 * (at != size))

    for _ in range(how.epochs):
        for i in order.permutation(len(texts)):
            at = np.append(texts[i], size)  # the last coordinate is the bias
            w = weights(at)
            gradient = 1 / (1 + math.exp(-max(-35.0, min(35.0, w.sum())))) - labels[i]
            step = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / how.alpha
            z[at] += gradient - step * w
            n[at] += gradient * gradient
    w = weights(np.arange(size + 1))
    index = np.flatnonzero(w[:size])
    return float(w[size]), index.astype(np.int32), w[index]


def _trainer(how: Ftrl, bits: int):
    def fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            for rows in blocks([batch], "text", SMALL_BLOCK_BYTES):
                row, at = _distinct(*features(find_words(rows.column("text"), lower=True, of=LETTERS), bits), bits)
                texts += np.split(at.astype(np.int32), np.searchsorted(row, np.arange(1, rows.num_rows)))
                labels += rows.column("label").to_pylist()
        bias, index, weight = train(texts, labels, how, bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(index, -1), pa.int32()), pa.array(np.append(weight, bias))], names=["index", "weight"]
        )

    return fit_rows


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", how: Ftrl = Ftrl(), bits: int = BITS,
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Fit on labelled documents outside the held-out third, at most `max_labelled` of them.

    Rows without id or label are not used; an id with several labels counts as the highest, an id
    with several texts as its first in order. Without any labelled row every score is a half.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    sample = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most max_labelled rows
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))
        .repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    )
    found = sample.select("label", "text").mapInArrow(_trainer(how, bits), "index int, weight double").collect()
    weights = {r["index"]: r["weight"] for r in found}
    bias = weights.pop(-1, 0.0)
    index = np.array(sorted(weights), np.int32)
    return Model(bias, index, np.array([weights[i] for i in index.tolist()]), bits)


def _scorer(model: Model, text: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << model.bits)
        weight[model.index] = model.weight
        known = weight != 0
        for rows in blocks(batches, text, SMALL_BLOCK_BYTES):
            row, at = features(find_words(rows.column(text), lower=True, of=LETTERS), model.bits)
            row, at = _distinct(row[known[at]], at[known[at]], model.bits)
            total = model.bias + np.bincount(row, weight[at], rows.num_rows)
            column = pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700))))
            yield pa.RecordBatch.from_arrays([*rows.columns, column], names=[*rows.schema.names, "score"])

    return score


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with a `score` between 0 and 1, higher where the label is likelier.

    Whole texts are scored; a null or empty text gets the score of the bias alone. Other columns
    pass through; one named `score` is replaced.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "score"])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(_scorer(model, text), schema)


by_value(__name__)
