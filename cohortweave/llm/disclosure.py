"""Personal data: fixed patterns, and terms that give away what the patterns protect.

The patterns find the protected entities (addresses, numbers). The corpus tells what their contexts
reveal: of an entity c that stands in df(c) of N documents, IC(c) = log2(N / df(c)) bits are unknown, and a
term t takes PMI(c; t) = log2(N df(c, t) / (df(c) df(t))) of them away, where df(c, t) counts the documents
that have t near c. What a reader who knows t does not know of c is the rest, log2(df(t) / df(c, t)) bits.
Terms that leave too little are removed; those that leave a little more are replaced by their class.
Counts are groupings with partial aggregates; no context of an entity is ever brought together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm import by_value
from cohortweave.llm.words import LETTERS, blocks, find_words, hash_words
from cohortweave.sources.workspace import stored

# Kinds of personal data and their patterns. Possessive parts match the same texts in linear time.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Kinds of the terms: removed, or replaced by their class.
REMOVED, GENERALISED = "term", "class"
# Words on either side of an entity that are its context.
CONTEXT = 8
# A term is judged if it stands near the entity in so many different contexts; copies share theirs.
LEAST_CONTEXTS = 3
# Bits of the entity that a term may leave unknown at most to be removed, or to be replaced by its class.
REMOVE_BITS = 0.5
GENERALISE_BITS = 1.0
# And the share of the entity's information that it takes away at least.
LEAST_SHARE = 0.5
# Terms (16 bytes each) that are looked for in the scan; more meet the documents by a shuffle.
TERMS_IN_SCAN = 1_000_000

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Each @ with what may stand before it; no run of letters is read twice."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield "email", start, found.end()
        end = found.end() if found else at + 1
        at = text.find("@", end)


def personal_spans(text: str | None) -> list[Span]:
    """(kind, start, end) in code points, by kind as in KINDS and start; ends are exclusive."""
    if not text:
        return []
    spans = list(_emails(text))
    if "." in text:
        spans += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub("[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return spans


def entity(kind: str, value: str) -> str:
    """A protected entity whatever its spelling: addresses in lower case, numbers as digits."""
    if kind == "email":
        return f"{kind}:{value.lower()}"
    return f"{kind}:{value}" if kind == "ip" else f"{kind}:{re.sub('[^0-9]', '', value)}"


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _points(text: str, at: np.ndarray) -> np.ndarray:
    """Byte places of a text as code points."""
    lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(lead)])[at]


def _free_words(text: str, spans: list[Span]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end in code points of each word that no span touches."""
    words = find_words(pa.array([text]), lower=True, of=LETTERS)
    starts, ends, free = _points(text, words.starts), _points(text, words.ends), np.ones(len(words.starts), bool)
    for _, a, b in spans:
        free[np.searchsorted(ends, a, side="right") : np.searchsorted(starts, b)] = False
    return hash_words(words)[free], starts[free], ends[free]


def _contexts(size: int):
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document its entities, and the terms of their contexts with a hash of the context."""
        for rows in blocks(batches, "text"):
            entities, terms, contexts, docs = [], [], [], []
            for text in rows.column("text").to_pylist():
                spans = personal_spans(text)
                if not spans:
                    continue
                hashes, starts, _ = _free_words(text, spans)
                pairs = {}
                for kind, a, b in spans:
                    of, at = entity(kind, text[a:b]), int(np.searchsorted(starts, a))
                    context = hashes[max(0, at - size) : at + size].view(np.int64)
                    seen = xxhash.xxh3_64_intdigest(context.tobytes()) - (1 << 63)
                    pairs.setdefault((of, None), {0})
                    for term in context.tolist():
                        pairs.setdefault((of, term), set()).add(seen)
                for (of, term), seen in pairs.items():
                    # A document counts once, however many contexts it has.
                    for i, context in enumerate(seen):
                        entities.append(of)
                        terms.append(term)
                        contexts.append(context)
                        docs.append(int(i == 0))
            if entities:
                columns = [pa.array(entities, pa.string()), *(pa.array(x, pa.int64()) for x in (terms, contexts, docs))]
                yield pa.RecordBatch.from_arrays(columns, names=["entity", "term", "context", "docs"])

    return near


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are in a sorted array."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def _distinct_terms(rows: pa.RecordBatch, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of the different words of each text, those that are known if given."""
    words = find_words(rows.column("text"), lower=True, of=LETTERS)
    hashes, row = hash_words(words), words.row
    if known is not None:
        mine = _among(hashes, known)
        hashes, row = hashes[mine], row[mine]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return row[new], hashes[new]


def _document_counter(known: np.ndarray | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            terms, docs = np.unique(_distinct_terms(rows, known)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(terms), pa.array(docs, pa.int64())], names=["term", "docs"])

    return count


def _term_lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in blocks(batches, "text"):
        row, terms = _distinct_terms(rows, None)
        yield pa.RecordBatch.from_arrays([rows.column("same").take(pa.array(row)), _signed(terms)], names=["same", "term"])


def _known(terms: DataFrame, limit: int) -> np.ndarray | None:
    """The terms, sorted, if they are few enough to go into the scan."""
    if terms.count() > limit:
        return None
    found = terms.select("term").toArrow().column("term")
    return np.sort(found.to_numpy().astype(np.int64).view(np.uint64))


def disclosures(
    docs: DataFrame, *, text: str = "text", context: int = CONTEXT, least_contexts: int = LEAST_CONTEXTS, remove_bits: float = REMOVE_BITS,
    generalise_bits: float = GENERALISE_BITS, least_share: float = LEAST_SHARE, terms_in_scan: int = TERMS_IN_SCAN,
) -> DataFrame:
    """(term, removed, bits): hashes of the terms that give an entity away, with what they leave unknown at least.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lowered, that no pattern
    touches. A pair counts if it has `least_contexts` different contexts, leaves at most
    `generalise_bits` of the entity and takes `least_share` of its information. Repeated rows count as
    documents, but their contexts as one.
    """
    texts = docs.select(F.col(text).alias("text"))
    near = stored(texts.mapInArrow(_contexts(context), "entity string, term long, context long, docs long"), "contexts")
    entities = near.filter("term IS NULL").groupBy("entity").agg(F.sum("docs").alias("entity_docs"))
    seen = near.filter("term IS NOT NULL").groupBy("entity", "term", "context").agg(F.sum("docs").alias("docs"))
    pairs = seen.groupBy("entity", "term").agg(F.sum("docs").alias("pair_docs"), F.count("*").alias("contexts"))
    pairs = stored(pairs.filter(F.col("contexts") >= least_contexts), "context-terms")
    terms = pairs.select("term").distinct()
    counted = texts.mapInArrow(_document_counter(_known(terms, terms_in_scan)), "term long, docs long")
    term_docs = counted.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("docs").alias("term_docs"))
    n = docs.count()
    unknown = F.log2(F.lit(n) / F.col("entity_docs"))
    rest = F.log2(F.col("term_docs") / F.col("pair_docs"))
    judged = pairs.join(term_docs, "term").join(entities, "entity").select("term", rest.alias("bits"), unknown.alias("unknown"))
    told = judged.filter((F.col("bits") <= generalise_bits) & (F.col("unknown") > 0) & (F.col("unknown") - F.col("bits") >= least_share * F.col("unknown")))
    least = told.groupBy("term").agg(F.min("bits").alias("bits"))
    return least.select("term", (F.col("bits") <= remove_bits).alias("removed"), "bits")


def _class(word: str) -> str:
    return "<number>" if word.isdecimal() else "<name>" if word[0].isupper() else "<word>"


def clean(text: str, spans: list[Span]) -> str:
    """The text without the spans: patterns give way to their kind, terms to nothing or to their class."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            put = "" if kind == REMOVED else _class(text[a:b]) if kind == GENERALISED else f"<{kind}>"
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _marker(text: str, names: list[str], known: Callable[[pa.RecordBatch, int], tuple[np.ndarray, np.ndarray]]):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, text):
            found, cleaned = [], []
            words = find_words(rows.column(text), lower=True, of=LETTERS)
            hashes = hash_words(words)
            for i, t in enumerate(rows.column(text).to_pylist()):
                spans = personal_spans(t)
                removed, generalised = known(rows, i)
                own = hashes[words.first[i] : words.first[i + 1]]
                if len(own) and (_among(own, removed).any() or _among(own, generalised).any()):
                    free, starts, ends = _free_words(t, spans)
                    for kind, which in ((REMOVED, removed), (GENERALISED, generalised)):
                        at = np.flatnonzero(_among(free, which))
                        spans = spans + [(kind, int(a), int(b)) for a, b in zip(starts[at], ends[at])]
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                cleaned.append(clean(t, spans) if spans else t)
            columns = [rows.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, span), pa.array(cleaned, pa.string())], names=[*names, "personal", "clean_text"])

    return mark


def sanitise(docs: DataFrame, *, text: str = "text", terms_in_scan: int = TERMS_IN_SCAN, **how) -> DataFrame:
    """The documents with `personal`, an array of (kind, start, end), and `clean_text` without these spans.

    Patterns come first, by kind and start, then terms to remove and terms to generalise. A null text
    has no spans and stays null. Other columns pass through; one named like an added one is replaced.
    Terms beyond `terms_in_scan` meet the documents by a join on the text's hash instead.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("personal", "clean_text")])
    names = docs.columns
    terms = stored(disclosures(docs, text=text, terms_in_scan=terms_in_scan, **how), "disclosures")
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("personal", T.ArrayType(span)), T.StructField("clean_text", T.StringType())])
    removed = _known(terms.filter("removed"), terms_in_scan)
    generalised = _known(terms.filter("NOT removed"), terms_in_scan)
    if removed is not None and generalised is not None:
        return docs.mapInArrow(_marker(text, names, lambda rows, i: (removed, generalised)), schema)
    same = F.xxhash64(F.col(f"`{text}`"))
    listed = docs.select(F.col(f"`{text}`").alias("text"), same.alias("same")).mapInArrow(_term_lister, "same long, term long")
    of_text = listed.join(terms, "term").groupBy("same").agg(
        F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("_removed"),
        F.collect_set(F.when(~F.col("removed"), F.col("term"))).alias("_generalised"),
    )  # at most the words of one text

    def own(rows: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.sort(np.array(rows.column(c)[i].as_py() or [], np.int64).view(np.uint64)) for c in ("_removed", "_generalised"))

    joined = docs.withColumn("_same", same).join(of_text.withColumnRenamed("same", "_same"), "_same", "left")
    return joined.mapInArrow(_marker(text, names, own), schema)


by_value(__name__)
