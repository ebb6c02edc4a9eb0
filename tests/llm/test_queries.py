"""Registered queries against their SQL, or by their contract where SQL cannot state them."""

import hashlib
import html
import re
import zlib

import duckdb
import pytest

from cohortweave.llm import queries
from cohortweave.llm.substring_dedup import repeats_of

TABLES = ("documents", "labels", "pages", "benchmark", "conversations")


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    result = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    left = sorted(map(repr, (tuple(r[n] for n in names) for r in df.collect())))
    assert left and left == sorted(map(repr, result.fetchall()))


def texts_of(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_secret_base_spans(spark, sf):
    rows = {r["doc_id"]: r for r in queries.op1_secret_scans(spark, sf).collect()}
    assign = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for doc_id, text in texts_of(spark, sf).items():
        spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text or "") if len(m[1]) >= 12]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 16]
        row = rows.pop(doc_id)
        assert row["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)))
        assert row["n_assign"] + row["n_access"] + row["n_hex"] == len(spans)
    assert not rows


def test_quality_statistics(spark, sf):
    rows = {r["doc_id"]: r for r in queries.op3_quality_rules(spark, sf).collect()}
    for doc_id, text in texts_of(spark, sf).items():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        dup = sum(x in lines[:i] for i, x in enumerate(lines))
        row = rows.pop(doc_id)
        found = [row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        assert found == [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)]
        assert row["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
        assert not (row["base_failed"] and row["kept"])
    assert not rows


def test_substring_dedup_equals_brute_force(spark, sf):
    texts = texts_of(spark, sf)
    expected = dict(zip(texts, repeats_of(texts.values())))
    for r in queries.op4_substring_dedup(spark, sf).collect():
        n, gone, kept = expected.pop(r["doc_id"])
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, gone, sha(kept))
    assert not expected


def test_main_text_is_the_article(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op5_html_extraction(spark, sf).collect():
        article = pages.pop(r["page_id"]).split("<article>")[1].split("</article>")[0]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", article))
        assert r["text"] == " ".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
        assert r["n_chars"] == len(r["text"])
    assert not pages


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    pairs = []
    for r in queries.op9_toxicity(spark, sf).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        if r["held_out"] and r["doc_id"] in labels:
            pairs.append((r["score"], labels[r["doc_id"]]))
    toxic = [s for s, y in pairs if y]
    clean = sorted(s for s, y in pairs if not y)
    wins = sum(sum(c < s for c in clean) for s in toxic) / len(toxic) / len(clean)
    assert wins > 0.97
    assert sum(s >= 0.7 for s in clean) <= 0.01 * len(clean) and sum(s >= 0.7 for s in toxic) > 0.5 * len(toxic)
