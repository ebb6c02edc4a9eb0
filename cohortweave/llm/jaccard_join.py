"""Documents that share most of their word shingles: an exact join by Jaccard distance.

Distance 1 - |x n y| / |x u y| is a metric, so pivots can split the documents. A pivot taken from
the documents is at distance 1 from nearly all others, which splits nothing; the first pivots are
therefore single shingles, the rarest first: a document belongs to the regions of its nearest ones,
as many as it takes for two linked documents to meet in one. Inside a region documents are pivots:
all members are measured against one of them, those within the bound join its component, and the
rest goes on with another pivot. Regions whose members are all connected are left. What remains
after PIVOT_ROUNDS is compared pairwise between components, in the windows that the triangle
inequality leaves. Texts with equal shingle sets are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm import by_value
from cohortweave.llm.components import components, small
from cohortweave.llm.words import SMALL_BLOCK_BYTES, Words, blocks, distinct, find_words, hash_words, mixed, rolling
from cohortweave.sources.workspace import stored

SHINGLE = 5
# Documents link from this similarity on, in hundredths.
PERCENT = 80
PIVOT_ROUNDS = 3
# Occurrences of shingles are counted in 2^SLOT_BITS slots, whatever the corpus: the counts only order
# shingles, so that frequent ones come last; any order is exact.
SLOT_BITS = 21
_CHUNKS = 64
# Counts of so many tasks are added first, then these sums.
_TASKS_ADDED = 64
# A set's sketch counts its shingles by their leading bits.
SKETCH_BITS = 6
# Shingles of the documents that one group measures against a pivot, about.
GROUP_SHINGLES = 1_000_000
# Shingles of pairs that are worth a task of their own.
TASK_SHINGLES = 250_000
# Bytes of packed texts that are measured at once: a few times as many of text.
PACKED_BYTES = 400_000

_BASE = 0xD1342543DE82EF95


def shingle_sets(words: Words, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row of fewer words is one shingle as a whole."""
    hashes = hash_words(words)
    values = mixed(rolling(hashes, width, _BASE))
    n = words.per_row
    out = []
    for i, start in enumerate(words.first[:-1]):
        if n[i] >= width:
            out.append(distinct(values[start : start + n[i] - width + 1]))
        elif n[i]:
            whole = hashes[start : start + n[i]].tobytes()
            out.append(np.array([xxhash.xxh3_64_intdigest(whole, seed=int(n[i]))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _fingerprint(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def prefix_length(n: int, percent: int) -> int:
    """Of any fixed order, how many first shingles two linked sets must share one of."""
    return n + (-n * percent // 100) + 1


def _surveyor(percent: int):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document its set's size and fingerprint; of the whole task its slot counts."""
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        for rows in blocks(batches, "text", SMALL_BLOCK_BYTES):
            sets = shingle_sets(find_words(rows.column("text"), lower=True))
            slots = (np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            np.add.at(counts, slots, 1)
            size = pa.array([len(s) for s in sets], pa.int64())
            node = pa.array([_fingerprint(s) if len(s) else None for s in sets], pa.int64())
            blank = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("row_hash"), size, node, blank.cast(pa.int32()), blank.cast(pa.int32()), blank.cast(pa.binary())],
                names=["doc_id", "row_hash", "n_shingles", "node", "chunk", "part", "counts"],
            )
        if counts.any():
            packed = [zstandard.compress(c.tobytes(), 1) for c in np.split(counts, _CHUNKS)]
            part = TaskContext.get().partitionId() // _TASKS_ADDED
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_CHUNKS, rows.schema.field("doc_id").type), *[pa.nulls(_CHUNKS, pa.int64())] * 3,
                 pa.array(range(_CHUNKS), pa.int32()), pa.array([part] * _CHUNKS, pa.int32()), pa.array(packed, pa.binary())],
                names=["doc_id", "row_hash", "n_shingles", "node", "chunk", "part", "counts"],
            )

    return survey


def _add_counts(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros((1 << SLOT_BITS) // _CHUNKS, np.uint64)
    for payload in group["counts"]:
        raw = zstandard.decompress(payload)
        total += np.frombuffer(raw, np.uint32 if len(raw) == 4 * len(total) else np.uint64)
    first = group.iloc[0]
    return pd.DataFrame({"chunk": [first["chunk"]], "part": [first["part"]], "counts": [zstandard.compress(total.tobytes(), 1)]})


def _ranks(surveyed: DataFrame) -> np.ndarray:
    """Order of magnitude of each slot's count: one byte per slot, whatever the corpus."""
    counts = surveyed.filter("chunk IS NOT NULL").select("chunk", "part", "counts")
    schema = "chunk int, part int, counts binary"
    summed = counts.groupBy("chunk", "part").applyInPandas(_add_counts, schema)
    chunks = summed.groupBy("chunk").applyInPandas(_add_counts, schema).collect()  # 64 rows of fixed size
    total = np.zeros((_CHUNKS, (1 << SLOT_BITS) // _CHUNKS))
    for row in chunks:
        total[row["chunk"]] = np.frombuffer(zstandard.decompress(row["counts"]), np.uint64)
    return np.log2(total.ravel() + 1).astype(np.uint8)


def _prefixer(percent: int, ranks: bytes):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = np.frombuffer(ranks, np.uint8), set()
        for rows in blocks(batches, "text", SMALL_BLOCK_BYTES):
            hashes, nodes, places = [], [], []
            for s in shingle_sets(find_words(rows.column("text"), lower=True)):
                node = _fingerprint(s)
                if len(s) and node not in seen:
                    seen.add(node)
                    order = np.argsort(rank[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)], kind="stable")
                    hashes.append(s[order[: prefix_length(len(s), percent)]])
                    nodes.append(np.full(len(hashes[-1]), node, np.int64))
                    places.append(np.arange(len(hashes[-1]), dtype=np.int32))
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(places))],
                    names=["region", "node", "place"],
                )

    return prefixes


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and sketches of nodes; a row whose set is not its node's is left out."""
    for batch in batches:
        for rows in blocks([batch], "text", SMALL_BLOCK_BYTES):
            sets = shingle_sets(find_words(rows.column("text"), lower=True))
            own = np.array([_fingerprint(s) for s in sets], np.int64) == rows.column("node").to_numpy()
            kept = np.flatnonzero(own)
            texts = rows.column("text").take(pa.array(kept)).to_pylist()
            packed = [zstandard.compress((t or "").encode(), 3) for t in texts]
            sketch = [np.bincount((sets[i] >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS).tolist() for i in kept]
            columns = [rows.column("node").take(pa.array(kept)), pa.array(packed, pa.binary()), pa.array(sketch, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "packed", "sketch"])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sets share."""
    both = np.sort(np.concatenate((x, y)))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _measurer(percent: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distance of each document of a group from its pivot, and whether they link. Groups are in order, their pivots first."""
        group, pivot, last = None, None, None
        for rows in blocks(batches, "packed", PACKED_BYTES):
            texts = pa.array([zstandard.decompress(p).decode() for p in rows.column("packed").to_pylist()], pa.large_string())
            sets = shingle_sets(find_words(texts, lower=True))
            pivots, parts, nodes = (rows.column(n).to_pylist() for n in ("pivot", "part", "node"))
            out = []
            for key, node, shingles in zip(zip(pivots, parts), nodes, sets):
                if key != group:
                    if node != key[0]:
                        raise ValueError(f"no text of pivot {key[0]}")
                    group, pivot, last = key, shingles, node
                elif node != last:  # equal rows give a node several times
                    common, last = _common(pivot, shingles), node
                    union = len(pivot) + len(shingles) - common
                    out.append((key[0], node, 1 - common / union, 100 * common >= percent * union))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                columns = [pa.array(x, kind) for x, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["pivot", "node", "distance", "linked"])

    return measure


def _measured(pairs: DataFrame, texts: DataFrame, percent: int, at_most: int | None = None) -> DataFrame:
    """(pivot, node, distance, linked) of distinct pairs, `at_most` so many, with the node's size n; large groups of a pivot are split."""
    pairs = stored(pairs, "pairs", at_most)  # they are read three times, and may come from a join of large groups
    n, shingles = pairs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = stored(pairs.groupBy("pivot").agg(F.ceil(F.sum("n") / GROUP_SHINGLES).cast("int").alias("parts")), "groups", n)
    members = pairs.join(small(size, n), "pivot").select("pivot", "node", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"))
    pivots = size.select("pivot", F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = stored(members.unionByName(pivots), "measured", n)
    # Texts go to their group alone: the narrow rows come to the texts where they may be broadcast.
    rows = texts.select("node", "packed").join(small(wanted, wanted.count()), "node")
    # Groups are a few documents each: they go through a task in order, not each as a table of its own.
    grouped = rows.select("pivot", "part", "node", "packed").repartition("pivot", "part").sortWithinPartitions(
        "pivot", "part", F.col("node") != F.col("pivot"), "node"
    )
    # Whole partitions one after another, as many as are worth a Python task.
    tasks = max(2 * texts.sparkSession.sparkContext.defaultParallelism, -(-shingles // TASK_SHINGLES))
    grouped = grouped.coalesce(tasks)
    found = grouped.mapInArrow(_measurer(percent), "pivot long, node long, distance double, linked boolean")
    return stored(found, "distances")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z are lowered. component_id is the smallest doc_id reachable
    by links, its own included; a document without words, null texts among them, links with
    nothing. Ids may be of any type that has an order. Rows that share an id but not the text are
    documents of their own; equal rows give equal rows; a document without id has its own component null
    unless it links with others. Sets are told apart by 64-bit hashes of shingles and of whole sets.
    """
    labelled = stored(_components_of(docs, doc_id, text, percent), "components")
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    alone = F.col("component").isNull()
    return labelled.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, row_hash, text): the hash of id and text tells rows apart that are not equal."""
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("row_hash"),
        F.col(f"`{text}`").alias("text"),
    )


def _components_of(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """(doc_id, row_hash, n_shingles, component) per row; the component is null without words."""
    docs = _rows(docs, doc_id, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    surveyed = stored(
        docs.mapInArrow(
            _surveyor(percent), f"doc_id {kind}, row_hash long, n_shingles long, node long, chunk int, part int, counts binary"
        ), "surveyed",
    )
    listed = surveyed.filter("chunk IS NULL").select("doc_id", "row_hash", "n_shingles", "node")
    ranks = _ranks(surveyed).tobytes()
    nodes = listed.filter("node IS NOT NULL").groupBy("node").agg(F.min("row_hash").alias("row_hash"), F.min("n_shingles").alias("n"))

    entries = docs.select("text").mapInArrow(_prefixer(percent, ranks), "region long, node long, place int")
    regions = entries.groupBy("region").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = stored(entries.join(regions.select("region"), "region", "left_semi").distinct(), "members")

    n_members = members.count()
    degrees = members.groupBy("node").agg(F.count("*").alias("degree"))
    wanted = stored(degrees.join(nodes, "node").select("node", "row_hash", "n", "degree"), "wanted", n_members)
    n_wanted = wanted.count()
    chosen = docs.join(small(wanted.select("node", "row_hash"), n_wanted), "row_hash").select("node", "text")
    texts = stored(chosen.mapInArrow(_packed, "node long, packed binary, sketch array<int>"), "texts")

    links, component = None, None
    members = members.join(small(wanted.select("node", "n", "degree"), n_wanted), "node")
    for _ in range(PIVOT_ROUNDS):
        # The member that shares most of its regions stands nearest to the middle of a group.
        labelled = _labelled(members.drop("pivot"), component, n_wanted)
        split = labelled.groupBy("region").agg(
            F.min(F.struct((-F.col("degree")).alias("rank"), "node", "n", "component")).alias("pivot"),
            F.min("component").alias("low"), F.max("component").alias("high"),
        ).filter("low < high").select("region", "pivot")
        rest = stored(
            labelled.join(split, "region").filter(F.col("node") != F.col("pivot.node"))
            .select("region", "node", "place", "n", "degree", (F.col("component") != F.col("pivot.component")).alias("apart"), F.col("pivot.node").alias("pivot"), F.col("pivot.n").alias("pivot_n")),
            "regions", n_members,
        )
        pairs = rest.filter(F.col("apart") & _sizes("n", "pivot_n", percent)).select("pivot", "node", "n").distinct()
        measured = _measured(pairs, texts, percent, n_members)
        links, component = _linked(links, measured, component)
        members = rest.select("region", "node", "place", "n", "degree", "pivot")
    left = _labelled(members, component, n_wanted)
    split = left.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    left = left.join(split.select("region"), "region", "left_semi").join(
        measured.select("pivot", "node", "distance"), ["pivot", "node"], "left"
    ).join(texts.select("node", "sketch").dropDuplicates(["node"]), "node")
    left = stored(left, "regions")
    x, y = left.alias("x"), left.alias("y")
    window = F.coalesce(F.abs(F.col("x.distance") - F.col("y.distance")) <= (100 - percent) / 100 + 1e-9, F.lit(True))
    # Sets of similarity s differ in at most (1 - s) / (1 + s) of their sizes' sum, and no less than their sketches.
    differ = F.aggregate(F.zip_with("x.sketch", "y.sketch", lambda a, b: F.abs(a - b)), F.lit(0), lambda t, d: t + d)
    # Two sets share no shingle before their first common one, so in that region enough must follow it in both.
    enough = percent * (F.col("x.n") + F.col("y.n"))
    follow = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) * (100 + percent)
    crossing = (
        (F.col("x.region") == F.col("y.region")) & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.component") != F.col("y.component")) & _sizes("x.n", "y.n", percent) & window & (follow >= enough)
        & (differ * (100 + percent) <= (F.col("x.n") + F.col("y.n")) * (100 - percent))
    )
    pairs = x.join(y, crossing).select(F.col("x.node").alias("pivot"), F.col("y.node").alias("node"), F.col("y.n").alias("n")).distinct()
    _, component = _linked(links, _measured(pairs, texts, percent), component)

    labelled = nodes.join(component, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    return listed.join(labelled, "node", "left").select("doc_id", "row_hash", "n_shingles", "component")


def _sizes(a: str, b: str, percent: int):
    """Sets of such sizes can link."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _labelled(members: DataFrame, component: DataFrame | None, n_nodes: int) -> DataFrame:
    if component is None:
        return members.withColumn("component", F.col("node"))
    return members.join(small(component, n_nodes), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _linked(links: DataFrame | None, measured: DataFrame, component: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """All links so far and their components, which grow from those of the links before."""
    new = measured.filter("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = new if links is None else links.unionByName(new)
    return links, components(links, known=component)


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without those that link to another one that stays, directly or through others.

    Of each component the row of the smallest id stays, one without id only if none has any; of several
    with this id the one whose hash of id and text is smallest, and of equal rows one. Documents without
    words all stay.
    """
    found = stored(_components_of(docs, doc_id, text, percent), "components")
    of_group = found.filter("component IS NOT NULL")
    first = of_group.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")).alias("first"))
    rows = of_group.groupBy("component", "row_hash").agg(F.count("*").alias("n"))
    judged = rows.join(first, "component").select(
        F.col("row_hash").alias("_row"), "n", (F.col("row_hash") == F.col("first.row_hash")).alias("stays")
    )
    judged = stored(judged, "judged")
    hashed = docs.withColumn("_row", F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    kept = hashed.join(judged.filter("NOT stays").select("_row"), "_row", "left_anti")
    twice = judged.filter("stays AND n > 1").select("_row")
    if not twice.isEmpty():
        once = kept.join(twice, "_row", "left_semi").dropDuplicates(["_row"])
        kept = kept.join(twice, "_row", "left_anti").unionByName(once)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


by_value(__name__)
