"""Near words, forms and counts against plain versions."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortweave.llm import spelling


def edits(word, letters):
    cut = {word[:i] + word[i + 1 :] for i in range(len(word))}
    put = {word[:i] + x + word[i:] for i in range(len(word) + 1) for x in letters}
    new = {word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in letters}
    return (cut | put | new) - {word}


@pytest.mark.parametrize("block_chars", [24_000, 60])
def test_near_words_equal_brute_force(spark, block_chars):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(500)} | {"a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 149}
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    found = spelling.near_words(df, block_chars=block_chars).collect()
    pairs = [(r["word"], r["near"]) for r in found]
    assert len(pairs) == len(set(pairs)) and all((r["n"], r["near_n"]) == (len(r["word"]), len(r["near"])) for r in found)
    longer = {w for w in words if len(w) > 1}
    assert set(pairs) == {(w, v) for w in longer for v in edits(w, "abé") & longer}


def test_forms_and_roots(spark):
    counts = {"abcdefg": 2, "abcdefx": 20, "abcdeyx": 200, "abcdefz": 20, "unrelated": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = {r["word"]: r.asDict() for r in spelling.spelling_groups(df).collect()}
    assert rows["abcdefg"] == {"word": "abcdefg", "form": "abcdefx", "root": "abcdeyx", "n": 2, "n_near": 2, "form_n": 20}  # a tie of x and z
    assert rows["abcdefz"]["form"] is None and rows["abcdefz"]["root"] == "abcdefz" and rows["abcdefz"]["n_near"] == 2
    assert (rows["unrelated"]["n_near"], rows["unrelated"]["form_n"]) == (0, None)
    assert spelling.spelling_groups(df.limit(0)).count() == 0


def test_vocabulary_of_odd_rows(spark):
    long = "Ünïcödé" * 20  # 140 code points of more than 64 bytes
    texts = [(1, "Variant variant VARIANT ÀÈvariant"), (1, "Variant variant VARIANT ÀÈvariant"), (2, None), (3, ""), (None, "variant short x1y2 variants"),
             (4, f"{long} {long}"), (5, " ".join(["repeated"] * 5000))] + [(i, "slipping letters") for i in range(100, 400)]
    df = spark.createDataFrame(texts, "doc_id long, text string").select("*", F.lit(1).alias("word"), F.lit(2).alias("n"))
    expected = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if x.isascii() else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            expected[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    expected = {w: n for w, n in expected.items() if len(w) >= 7 and n >= 2}
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()} == expected
    assert expected["letters"] > 250 and len(expected) > 6
    assert spelling.vocabulary(df.limit(0)).count() == 0
