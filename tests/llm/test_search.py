"""Ranked search against a plain scorer."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortweave.llm import lexical_search


def terms_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, top):
    bags = [(d, Counter(terms_of(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    merged = {}
    for item, text in items:
        merged.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in merged.items():
        found = []
        for doc_id, bag in bags:
            m = 10 + 90 * sum(bag.values()) * len(bags) // total
            score = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms if t in bag)
            if score > 0:
                found.append((-score, doc_id is not None, doc_id))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def made_docs(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "x1", "THE"]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(63)], k=rng.randint(1, 40))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (4, texts[3]), (None, texts[5]), (None, "w1 w2 rare"), (500, None), (501, ""), (502, "--- !"), (503, "w7 " * 30_000)]


@pytest.mark.parametrize("query_bytes, top, block", [(2_000_000, 10, 6_000_000), (60, 3, 400)])
def test_search_equals_plain_scores(spark, monkeypatch, query_bytes, top, block):
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", query_bytes)
    docs = made_docs(1, 300)
    items = [(1, "w1 w2 w3 w40 w59 über x1"), (2, "rare"), (3, "THE the The w0"), (4, None), (5, "unknown"), (6, ""), (1, "w17"), (None, "w50 w51 w50"), (8, " ".join(f"w{i}" for i in range(60)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7 if block < 1000 else 1).select("*", F.lit(0).alias("score"), F.lit(1).alias("n_docs"))
    asked = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(0).alias("rank"), F.lit(0).alias("query"))
    found = lexical_search.search(lexical_search.build_index(df), asked, top=top).collect()
    assert sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found], key=repr) == plain_search(docs, items, top)


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "x")], "item_id string, text string")
    index = lexical_search.build_index(docs)
    found = lexical_search.search(index, items).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in found] == [("i", 1, "a"), ("i", 2, "b")]
    assert lexical_search.search(index, items.limit(0)).count() == 0
    assert lexical_search.search(lexical_search.build_index(docs.limit(0)), items).count() == 0


def test_pair_bounds_hold_and_are_tighter():
    """No document gives more than its pair's bound, which is below the sum of both maxima where no document has both best."""
    import numpy as np
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["a a a x", "b b b y", "a b"])], names=["doc_id", "text"])
    row = next(lexical_search._indexer(pa.int64())([rows])).to_pylist()[0]
    queries = lexical_search._read_queries([{"item_id": 1, "text": "a b"}])
    queries.weights[:], queries.n_docs, queries.n_terms = 1000, 3, 10
    queries.pair_up()
    block = lexical_search._weighed(row, queries)
    assert block.pair_docs.tolist() == [2] and block.bounds[0] == max(block.joint[0], block.maxima.max()) < block.maxima.sum()
    assert np.array_equal(lexical_search._scores(block, queries, 0, 1)[0], [0, 1, 2])
