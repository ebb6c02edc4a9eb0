"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: a rule is grown condition by condition for the largest gain, pruned on rows
that it was not grown on, and taken if it is precise there; the rows it covers are set aside and the
next one is learned. The rules are few thresholds on statistics and run as one Spark expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.llm import by_value
from cohortweave.llm.substring_dedup import covered_words
from cohortweave.llm.toxicity import held_out
from cohortweave.llm.words import blocks, find_words, hash_words, inside_row, joined, mixed, rolling

# Labelled rows that rules are learned from at most: those whose ids hash lowest, each text once.
MAX_LABELLED = 20_000
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

_BASE = 0xD1342543DE82EF95
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE_CHARS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_distinct")
# Statistics that rules may test, as expressions of the counts.
MEASURES = {
    "words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(n_letters, 1)",
    "distinct_word_share": "n_distinct / greatest(n_words, 1)",
}


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _table(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), list(chars.encode()))


def _dup_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(_SPACE_CHARS):
            seen.add(line)
    return n


def counts(texts: pa.Array) -> list[np.ndarray]:
    """The COUNTS of each text."""
    data, offsets = joined(texts)
    size = int(offsets[-1])
    data = data[:size]
    words = find_words(texts)
    begins_char = (data & 0xC0) != 0x80
    in_word = ~_table(_SPACE_CHARS)[data]
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    hashes = hash_words(words)

    salt = words.row.astype(np.uint64) * _ODD
    at = np.flatnonzero(inside_row(words, 3))
    value = mixed(rolling(hashes, 3, _BASE)[at] + salt[at])
    order = np.argsort(value, kind="stable")
    again = np.zeros(len(value), bool)
    equal = value[order[1:]] == value[order[:-1]]
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    repeated = covered_words(at[again], 3, len(hashes))

    keys = np.sort(mixed(hashes + salt))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    order = np.argsort(mixed(hashes + salt), kind="stable")
    distinct = np.zeros(len(keys), bool)
    distinct[order] = first

    lines = texts.to_pylist()
    return [
        words.per_row, _per_row(begins_char & in_word, offsets), _per_row(_table(SYMBOLS)[data], offsets),
        np.array([_dup_lines(t) if t else 0 for t in lines], np.int64), _per_row(repeated, words.first),
        np.array([t.count("\n") + 1 if t else 0 for t in lines], np.int64), _per_row(upper, offsets),
        _per_row(upper | lower, offsets), _per_row(distinct, words.first),
    ]


def _counter(text: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, text):
            kept = [n for n in rows.schema.names if n != text]
            columns = [*(rows.column(n) for n in kept), *(pa.array(c, pa.int64()) for c in counts(rows.column(text)))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *COUNTS])

    return count


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents without their text, with COUNTS; a null text has no words and no lines.

    Words are `[^\\x20\\x09-\\x0D]+`; the whole text is counted. Columns named like a count are replaced.
    """
    kept = [c for c in docs.columns if c not in COUNTS]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
    return docs.mapInArrow(_counter(text), ", ".join([*fields, *(f"{c} long" for c in COUNTS)]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"({MEASURES[self.measure]}) {'>=' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    """A conjunction that marks a document as bad."""

    conditions: tuple[Condition, ...]
    precision: float


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = field(default=())

    def verdict(self) -> Column:
        """Whether a document is kept: the first rule that covers it decides, else it is."""
        column = F
        for rule in self.rules:
            column = column.when(F.expr(" AND ".join(c.sql() for c in rule.conditions)), F.lit(False))
        return F.lit(True) if column is F else column.otherwise(F.lit(True))


@dataclass(frozen=True)
class Covering:
    """Limits of learning: rules, conditions of a rule, tried thresholds, least precision and cover."""

    max_rules: int = 12
    max_conditions: int = 3
    thresholds: int = 64
    precision: float = 0.95
    cover: int = 3
    seed: int = 11


def _covers(condition: Condition, x: dict[str, np.ndarray]) -> np.ndarray:
    values = x[condition.measure]
    return values >= condition.threshold if condition.above else values <= condition.threshold


def _all(conditions: tuple[Condition, ...], x: dict[str, np.ndarray]) -> np.ndarray:
    covered = np.ones(len(next(iter(x.values()))), bool)
    for c in conditions:
        covered &= _covers(c, x)
    return covered


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, how: Covering) -> tuple[Condition, ...]:
    rule: tuple[Condition, ...] = ()
    covered = np.ones(len(bad), bool)
    while len(rule) < how.max_conditions and bad[covered].sum() < covered.sum():
        p, n = bad[covered].sum(), covered.sum()
        best, best_gain = None, 1e-9
        for name, values in x.items():
            cuts = np.unique(np.quantile(values[covered & bad], np.linspace(0, 1, how.thresholds)))
            for cut in cuts.tolist():
                for above in (True, False):
                    c = Condition(name, above, cut)
                    now = covered & _covers(c, x)
                    p1, n1 = bad[now].sum(), now.sum()
                    if p1 >= how.cover:
                        gain = p1 * (math.log2(p1 / n1) - math.log2(p / n))
                        if gain > best_gain:
                            best, best_gain = c, gain
        if best is None:
            break
        rule += (best,)
        covered &= _covers(best, x)
    return rule


def learn(x: dict[str, np.ndarray], bad: np.ndarray, how: Covering = Covering()) -> DecisionList:
    """Ordered rules for the bad rows; a third of the rows is kept apart for pruning."""
    rules: list[Rule] = []
    random = np.random.default_rng(how.seed)
    left = np.ones(len(bad), bool)
    while len(rules) < how.max_rules and bad[left].sum() >= how.cover:
        rows = random.permutation(np.flatnonzero(left))
        grow, prune = rows[len(rows) // 3 :], rows[: len(rows) // 3]
        if not bad[grow].any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], how)
        kept_apart = {k: v[prune] for k, v in x.items()}

        def worth(r: tuple[Condition, ...]) -> float:
            now = _all(r, kept_apart)
            return (2 * bad[prune][now].sum() - now.sum()) / max(1, now.sum())

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        covered = _all(rule, x) & left
        precision = bad[covered].mean() if covered.any() else 0.0
        apart = _all(rule, kept_apart)
        if not rule or precision < how.precision or (apart.any() and bad[prune][apart].mean() < how.precision):
            break
        rules.append(Rule(rule, float(precision)))
        left &= ~covered
    return DecisionList(tuple(rules))


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", how: Covering = Covering(), max_labelled: int = MAX_LABELLED
) -> DecisionList:
    """Learn from labelled documents outside the held-out third that pass the base rules.

    At most `max_labelled` of them are used. Rows without id or label are not; an id with several
    labels counts as the lowest, an id with several texts as its first in order.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    texts = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # at most max_labelled rows
    )
    measured = statistics(texts).filter(~base_failed()).selectExpr("doc_id", "label", *(f"{e} AS {m}" for m, e in MEASURES.items()))
    rows = measured.orderBy("doc_id").toPandas()  # a few numbers of each chosen row
    if rows.empty:
        return DecisionList()
    return learn({m: rows[m].to_numpy(float) for m in MEASURES}, (rows["label"] == 0).to_numpy(), how)


by_value(__name__)
