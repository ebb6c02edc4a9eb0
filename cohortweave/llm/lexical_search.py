"""Ranked search by terms: an index of document blocks, searched by MaxScore with bounds on term pairs.

The index has one row per block of documents: its terms and their postings, all in arrays. A query set
weighs the postings of its terms. Its terms are paired, rarest with next rarest; for each pair a block
keeps the list of documents that have both, with the sum of both impacts, and its maximum. What two
terms give together is at most that or the larger of the two single maxima, which is less than the
sum of the maxima that single terms would give.

A query goes through its pairs from the highest bound on. While the bounds left reach the score that
a document must beat, new documents are added; after that only those whose score plus the bounds
left can still reach it are looked up. That score is at first the tenth best of what pairs alone give
in the whole corpus, then the tenth best that the task has found. Blocks under it are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm import by_value
from cohortweave.llm.words import LETTERS, blocks, find_words, hash_words
from cohortweave.sources.workspace import stored

TOP = 10
# Queries are worked on together up to about this many bytes of their texts.
QUERY_BYTES = 2_000_000

_PACKED = ("terms", "starts", "docs", "times", "lengths")
_TYPES = {"terms": np.uint64, "starts": np.int32, "docs": np.int32, "times": np.int32, "lengths": np.int64}


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 3)


def _unpack(packed: bytes, of: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), of)


def _segments(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins, and the end."""
    new = np.ones(len(sorted_values) + 1, bool)
    new[1:-1] = sorted_values[1:] != sorted_values[:-1]
    return np.flatnonzero(new)


def _indexer(schema: pa.DataType):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            words = find_words(rows.column("text"), lower=True, of=LETTERS)
            hashes = hash_words(words)
            order = np.argsort(hashes, kind="stable")  # rows stay in order within a term
            hashes, row = hashes[order], words.row[order].astype(np.int32)
            new = np.ones(len(hashes) + 1, bool)
            new[1:-1] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            times, docs, hashes = np.diff(at).astype(np.int32), row[at[:-1]], hashes[at[:-1]]
            starts = _segments(hashes) if len(hashes) else np.zeros(1, np.int64)
            lengths = words.per_row.astype(np.int64)
            arrays = (hashes[starts[:-1]], starts.astype(np.int32), docs, times, lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows.column("doc_id").to_pylist()], pa.list_(schema)), *(pa.array([_pack(a)], pa.binary()) for a in arrays),
                 pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64())],
                names=["doc_ids", *_PACKED, "n_docs", "n_terms"],
            )

    return index


def build_index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per block of documents, stored: ids, terms (64-bit hashes), postings and lengths.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lowered. Every row is a
    document of its own, also where ids repeat or are null; null texts have no terms. Every term of
    every document is indexed.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind.simpleString())
    if arrow is None:
        raise ValueError(f"doc_id must be a long, int or string, not {kind.simpleString()}")
    binary = [T.StructField(c, T.BinaryType()) for c in _PACKED]
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(kind)), *binary, T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()),
    ])
    return stored(rows.mapInArrow(_indexer(arrow), schema), "search-index")


@dataclass
class Queries:
    """A block of queries: their items, the terms of all, each one's terms, and the weights of terms."""

    items: list
    terms: np.ndarray
    of_item: list[np.ndarray]
    weights: np.ndarray
    n_docs: int = 0
    n_terms: int = 0

    def pair_up(self) -> None:
        """The terms of each item two by two in falling order of weight, a last one alone (-1)."""
        self.units = []
        seen: dict[tuple[int, int], int] = {}
        for terms in self.of_item:
            order = terms[np.argsort(-self.weights[terms], kind="stable")].tolist()
            pairs = list(zip(order[::2], [*order[1::2], -1]))
            self.units.append(np.array([seen.setdefault(p, len(seen)) for p in pairs], np.int64))
        self.first = np.array([a for a, _ in seen], np.int64)
        self.second = np.array([b for _, b in seen], np.int64)


def _read_queries(rows: list) -> Queries:
    items: dict = {}
    words = find_words(pa.array([r["text"] for r in rows], pa.string()), lower=True, of=LETTERS)
    hashes = hash_words(words)
    for i, r in enumerate(rows):
        items.setdefault(r["item_id"], []).append(hashes[words.first[i] : words.first[i + 1]])
    terms = np.unique(hashes)
    of_item = [np.searchsorted(terms, np.unique(np.concatenate(parts))) for parts in items.values()]
    return Queries(list(items), terms, of_item, np.zeros(len(terms), np.int64))


def _frequency_counter(terms: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many documents of each block have each term of the queries."""
        for batch in batches:
            for packed, packed_starts in zip(batch.column("terms").to_pylist(), batch.column("starts").to_pylist()):
                own = _unpack(packed, np.uint64)
                _, mine, theirs = np.intersect1d(terms, own, assume_unique=True, return_indices=True)
                documents = np.diff(_unpack(packed_starts, np.int32))[theirs]
                yield pa.RecordBatch.from_arrays([pa.array(mine.astype(np.int64)), pa.array(documents.astype(np.int64))], names=["term", "docs"])

    return count


@dataclass
class Block:
    """The postings of query terms in one block, and its pair lists."""

    n_docs: int
    starts: np.ndarray  # by term
    docs: np.ndarray
    impacts: np.ndarray
    maxima: np.ndarray  # of a term
    pair_starts: np.ndarray  # by pair: the documents that have both terms
    pair_docs: np.ndarray
    joint: np.ndarray
    bounds: np.ndarray  # of a pair

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[term], self.starts[term + 1])
        return self.docs[at], self.impacts[at]


_BLOCK = {
    "starts": np.int32, "docs": np.int32, "impacts": np.int64, "maxima": np.int64, "pair_starts": np.int32, "pair_docs": np.int32,
    "joint": np.int64, "bounds": np.int64,
}


def _weighed(packed: dict, queries: Queries) -> Block:
    own, starts, docs, times, lengths = (_unpack(packed[c], _TYPES[c]) for c in _PACKED)
    _, mine, theirs = np.intersect1d(queries.terms, own, assume_unique=True, return_indices=True)
    sizes = np.zeros(len(queries.terms), np.int64)
    sizes[mine] = np.diff(starts)[theirs]
    ends = np.cumsum(sizes)
    first = np.zeros(len(sizes), np.int64)
    first[mine] = starts[theirs]
    at = np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    docs, times, term = docs[at], times[at].astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    m = 100 - 90 + (90 * lengths * queries.n_docs) // max(queries.n_terms, 1)
    impacts = queries.weights[term] * ((1_000_000_000 * times) // (1_000 * times + 8 * m[docs]))
    starts = np.concatenate([[0], ends])
    maxima = np.zeros(len(sizes), np.int64)
    np.maximum.at(maxima, term, impacts)
    out = Block(len(lengths), starts, docs, impacts, maxima, *[np.zeros(0, np.int64)] * 4)
    return _paired(out, queries)


def _paired(block: Block, queries: Queries) -> Block:
    """With the pair lists: the documents of both terms and their joint impacts, and a bound for either or both."""
    slot = np.full(block.n_docs, -1, np.int64)
    both, joint, sizes = [], [], np.zeros(len(queries.first), np.int64)
    single = np.append(block.maxima, 0)  # the last for a missing second term
    bounds = np.maximum(single[queries.first], single[queries.second])
    filled = np.append(np.diff(block.starts) > 0, False)
    for p in np.flatnonzero(filled[queries.first] & filled[queries.second]):
        docs, impacts = block.postings(queries.first[p])
        others, more = block.postings(queries.second[p])
        slot[docs] = np.arange(len(docs))
        at = slot[others]
        slot[docs] = -1
        mine = at >= 0
        if mine.any():
            both.append(others[mine])
            joint.append(impacts[at[mine]] + more[mine])
            sizes[p] = len(both[-1])
            bounds[p] = max(bounds[p], int(joint[-1].max()))
    block.pair_starts = np.concatenate([[0], np.cumsum(sizes)])
    block.pair_docs = np.concatenate(both) if both else np.zeros(0, np.int64)
    block.joint = np.concatenate(joint) if joint else np.zeros(0, np.int64)
    block.bounds = bounds
    return block


def _highest(values: np.ndarray, k: int) -> np.ndarray:
    return values if len(values) <= k else np.partition(values, len(values) - k)[-k:]


def _weigher(queries: Queries, top: int, ids: pa.DataType):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block with weighed postings and pair lists; at the end the best that single pairs give each query."""
        best = [np.zeros(0, np.int64) for _ in queries.items]
        names = ["doc_ids", "n_docs", *_BLOCK, "query", "floor"]
        for batch in batches:
            for row in batch.to_pylist():
                block = _weighed(row, queries)
                score = np.zeros(block.n_docs, np.int64)
                for q, units in enumerate(queries.units):
                    score[:] = 0
                    for p in units[block.bounds[units] > 0]:
                        docs, impacts = block.postings(queries.first[p])
                        np.maximum.at(score, docs, impacts)
                        at = slice(block.pair_starts[p], block.pair_starts[p + 1])
                        np.maximum.at(score, block.pair_docs[at], block.joint[at])
                    best[q] = _highest(np.concatenate([best[q], score[score > 0]]), top)
                columns = [pa.array([_pack(getattr(block, c).astype(t))], pa.binary()) for c, t in _BLOCK.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"]], pa.list_(ids)), pa.array([block.n_docs], pa.int32()), *columns, pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64())],
                    names=names,
                )
        floors = [(q, int(x)) for q, values in enumerate(best) for x in values]
        if floors:
            query, floor = zip(*floors)
            n = len(floors)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.list_(ids)), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * len(_BLOCK), pa.array(query, pa.int32()), pa.array(floor, pa.int64())],
                names=names,
            )

    return weigh


def _scores(block: Block, queries: Queries, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, score) of all documents of the block with at least `least`, and perhaps others."""
    units = queries.units[q]
    units = units[block.bounds[units] > 0]
    units = units[np.argsort(-block.bounds[units], kind="stable")]
    left = np.append(np.cumsum(block.bounds[units][::-1])[::-1], 0)
    if left[0] < least or not len(units):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    score = np.zeros(block.n_docs, np.int64)
    at = 0
    while at < len(units) and left[at] >= least:  # documents not met so far can reach it
        for term in (queries.first[units[at]], queries.second[units[at]]):
            if term >= 0:
                docs, impacts = block.postings(term)
                score[docs] += impacts
        at += 1
    found = np.flatnonzero((score > 0) & (score + left[at] >= least))
    slot = np.full(block.n_docs, -1, np.int64)
    while at < len(units) and len(found):
        slot[found] = np.arange(len(found))
        for term in (queries.first[units[at]], queries.second[units[at]]):
            if term >= 0:
                docs, impacts = block.postings(term)
                mine = slot[docs] >= 0
                score[docs[mine]] += impacts[mine]
        slot[found] = -1
        at += 1
        found = found[score[found] + left[at] >= least]
    return found, score[found]


def _order(entry: tuple) -> tuple:
    score, doc_id = entry
    return -score, doc_id is not None, doc_id


def _searcher(queries: Queries, floors: np.ndarray, top: int, ids: pa.DataType):
    def search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best documents of the whole task for each query."""
        best: list[list[tuple]] = [[] for _ in queries.items]
        least = np.maximum(floors, 1)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["n_docs"], *(_unpack(row[c], t) for c, t in _BLOCK.items()))
                for q in range(len(queries.items)):
                    docs, scores = _scores(block, queries, q, int(least[q]))
                    if len(docs) > top:  # those that tie with the last stay
                        enough = scores >= _highest(scores, top).min()
                        docs, scores = docs[enough], scores[enough]
                    if len(docs):
                        new = [(int(s), row["doc_ids"][d]) for d, s in zip(docs, scores)]
                        best[q] = sorted(best[q] + new, key=_order)[:top]
                        if len(best[q]) == top:
                            least[q] = max(least[q], best[q][-1][0])
        out = [(q, s, d) for q, entries in enumerate(best) for s, d in entries]
        if out:
            query, score, doc_id = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(score, pa.int64()), pa.array(doc_id, ids)], names=["query", "score", "doc_id"])

    return search_blocks


def _first(rows: DataFrame, k: int, key: list[str], order: list) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def _search(index: DataFrame, queries: Queries, top: int) -> DataFrame:
    """(query, rank, doc_id, score) of one block of queries."""
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    queries.n_docs, queries.n_terms = int(totals[0] or 0), int(totals[1] or 0)
    counted = index.select("terms", "starts").mapInArrow(_frequency_counter(queries.terms), "term long, docs long")
    for term, docs in counted.groupBy("term").agg(F.sum("docs")).collect():  # at most the terms of the queries
        queries.weights[term] = math.floor(1000 * math.log((2 * queries.n_docs + 2) / (2 * docs + 1)))
    queries.pair_up()

    kind = index.schema["doc_ids"].dataType.elementType
    ids = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    binary = [T.StructField(c, T.BinaryType()) for c in _BLOCK]
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("n_docs", T.IntegerType()), *binary,
        T.StructField("query", T.IntegerType()), T.StructField("floor", T.LongType()),
    ])
    weighed = stored(index.select("doc_ids", *_PACKED).mapInArrow(_weigher(queries, top, ids), schema), "search-pairs")
    floors = np.zeros(len(queries.items), np.int64)
    met = weighed.filter("query IS NOT NULL").select("query", "floor", F.pmod(F.xxhash64("floor"), F.lit(64)).alias("part"))
    met = _first(_first(met, top, ["query", "part"], [F.desc("floor")]).drop("rank"), top, ["query"], [F.desc("floor")])
    for row in met.filter(F.col("rank") == top).select("query", "floor").collect():  # one row per query
        floors[row["query"]] = row["floor"]

    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("score", T.LongType()), T.StructField("doc_id", kind)])
    blocks_of = weighed.filter("query IS NULL").select("doc_ids", "n_docs", *_BLOCK)
    found = blocks_of.mapInArrow(_searcher(queries, floors, top, ids), schema).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    return _first(_first(found, top, ["query", "part"], order).drop("rank", "part"), top, ["query"], order)


def search(index: DataFrame, items: DataFrame, *, item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of highest positive score of each item.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), its impact on a document of n terms with tf
    occurrences weight * (10^9 tf div (1000 tf + 8 m)), m = 10 + 90 n N div L. Equal scores come by
    ascending doc_id, null first. Items without known terms have no rows; rows of one item_id are one
    item with the terms of all. Items are collected in blocks of about QUERY_BYTES of text, each of
    which goes through the whole index.
    """
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // QUERY_BYTES)
    schema = T.StructType([
        rows.schema["item_id"], T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", index.schema["doc_ids"].dataType.elementType), T.StructField("score", T.LongType()),
    ])
    out = index.sparkSession.createDataFrame([], schema)
    for part in range(parts):
        queries = _read_queries(rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).filter("text IS NOT NULL").collect())
        if not len(queries.terms):
            continue
        found = _search(index, queries, top)
        names = index.sparkSession.createDataFrame(list(enumerate(queries.items)), T.StructType([T.StructField("query", T.IntegerType()), rows.schema["item_id"]]))
        out = out.unionByName(found.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    return out


by_value(__name__)
