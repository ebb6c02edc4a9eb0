"""Personal data by the patterns as stated, and terms by a plain count of contexts."""

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortweave.llm import disclosure, queries
from tests.llm.test_queries import sha, texts_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = [int(x) for x in value if x.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


def plain_terms(texts):
    """(removed, generalised) terms."""
    words, near, entities = defaultdict(set), defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for i, text in enumerate(texts):
        tokens = [(m.start(), m.end(), re.sub("[A-Z]", lambda x: x[0].lower(), m[0])) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+", text or "")]
        for *_, w in tokens:
            words[w].add(i)
        spans = plain_spans(text)
        free = [t for t in tokens if not any(t[0] < b and a < t[1] for _, a, b in spans)]
        for kind, a, b in spans:
            entity = disclosure.entity(kind, text[a:b])
            entities[entity].add(i)
            at = sum(t[0] < a for t in free)
            context = tuple(t[2] for t in free[max(0, at - disclosure.CONTEXT) : at + disclosure.CONTEXT])
            for w in context:
                near[entity, w][context].add(i)
    bits = {}
    for (entity, w), contexts in near.items():
        if len(contexts) >= disclosure.LEAST_CONTEXTS:
            rest = math.log2(len(words[w]) / len(set().union(*contexts.values())))
            unknown = math.log2(len(texts) / len(entities[entity]))
            if rest <= disclosure.GENERALISE_BITS and unknown > 0 and unknown - rest >= disclosure.LEAST_SHARE * unknown:
                bits[w] = min(rest, bits.get(w, 99))
    return {w for w, b in bits.items() if b <= disclosure.REMOVE_BITS}, {w for w, b in bits.items() if b > disclosure.REMOVE_BITS}


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x@y@z.org, .%+-@a-b.c-d. @x.y", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3", "4111 1111-1111 1111 4111111111111112 1 2 3",
    "+1 (377) 555-0271 +12 +1 234567 +1+44 20 7946 0958, +123456789012345678 4111111111111111", "é4111111111111111 ü+1 377 555 0271", "",
])
def test_patterns(text):
    assert disclosure.personal_spans(text) == plain_spans(text)


def test_patterns_on_random_and_long_texts():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("a.@-+ 1239()é%") for _ in range(40))
        assert disclosure.personal_spans(text) == plain_spans(text)
    for long in ("a" * 300_000, "1" * 300_000, "+1 " * 100_000, "a@" * 150_000, "1." * 150_000, "@" + "a" * 300_000):
        disclosure.personal_spans(long)


def test_query(spark, sf):
    texts = texts_of(spark, sf)
    removed, generalised = plain_terms(list(texts.values()))
    for r in queries.op12_personal_data(spark, sf).collect():
        spans = plain_spans(texts.pop(r["doc_id"]))
        assert r["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        assert r["n_term"] == 0 or removed
        assert r["spans"].count(":") == 2 * (len(spans) + r["n_term"] + r["n_class"])
    assert not texts


def made_rows():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = []
    for i in range(400):
        head, tail = " ".join(word() for _ in range(9)), " ".join(word() for _ in range(9))
        if i < 12:
            texts.append(f"{head} Zorvax Quill the zq@mail.example owner {'Maple' if i < 5 else ''} {tail}")
        elif i < 20:
            texts.append(f"{head} maple the {tail}")
        else:
            texts.append(f"{head} the {tail} +1 377 555 {1000 + i}")
    texts += ["rarest word here other@mail.example beside it"] * 9  # copies are one context
    return [(i, t) for i, t in enumerate(texts)] + [(1, None), (None, ""), (2, "x" * 50_000 + " zorvax"), (1, texts[1])]


@pytest.mark.parametrize("terms_in_scan", [disclosure.TERMS_IN_SCAN, 0])
def test_terms_that_reveal_an_entity(spark, terms_in_scan):
    rows = made_rows()
    removed, generalised = plain_terms([t for _, t in rows])
    assert {"zorvax", "quill"} <= removed and "the" not in removed | generalised and "rarest" not in removed | generalised
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(7).alias("personal"), F.lit("k").alias("entity"))
    out = disclosure.sanitise(df, terms_in_scan=terms_in_scan).collect()
    assert len(out) == len(rows)
    for r in out:
        text, spans = r["text"], plain_spans(r["text"])
        for kind, of in (("term", removed), ("class", generalised)):
            spans += [
                (kind, m.start(), m.end()) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+", text or "")
                if m[0].lower() in of and not any(m.start() < b and a < m.end() for _, a, b in plain_spans(text))
            ]
        assert [tuple(s) for s in r["personal"]] == spans
        assert (r["clean_text"] is None) == (text is None) and r["entity"] == "k"
        if text and "Zorvax Quill" in text:
            assert "Zorvax" not in r["clean_text"] and "<email>" in r["clean_text"]


def test_generalised_terms_keep_their_class():
    assert disclosure.clean("Anna met 42 at x@y.z", [("email", 15, 20), ("class", 0, 4), ("class", 9, 11), ("term", 5, 8)]) == "<name>  <number> at <email>"


def test_empty_table(spark):
    assert disclosure.sanitise(spark.createDataFrame([], "doc_id long, text string")).count() == 0
