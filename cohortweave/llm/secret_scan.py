"""Secrets in texts: fixed patterns, and literals assigned to names that sound secret.

An assignment-aware lexer reads name-literal pairs of source and configuration syntax (`name = "x"`,
`name: x`, `NAME=x`, `"name": "x"`, `name := 'a' + 'b'`, `name: type = "x"`, `["name"] = "x"`), follows names that stand for literals read
before, and scores each literal by the name it ends up in.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm import by_value
from cohortweave.llm.words import blocks

KINDS = ("assign", "access", "hex", "literal")
SECRET_SCORE = 0.6
REPLACEMENT = "[SECRET]"

# Fixed patterns; the number is the least length of group 2 or of the match.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs; shorter ones fail

_QUOTED = r'"(?:[^"\\\n]|\\.)*+"|' + r"'(?:[^'\\\n]|\\.)*+'"
_TERM = rf"(?:{_QUOTED}|\$\{{?[A-Za-z_][A-Za-z0-9_]*+\}}?|[A-Za-z0-9+/_.~-]++=*+)"
# A declared type: a name with arguments in brackets, alternatives after |, and the marks of references and optional ones.
_ONE_TYPE = (
    r"[&*]?(?:'[a-z]++[ \t]+)?(?:mut[ \t]+)?[A-Za-z_][A-Za-z0-9_.]*+"
    r"(?:\[(?:[^\[\]\n=]|\[[^\[\]\n=]*+\])*+\]|<[^<>\n=]*+>)*+[?!]?"
)
_TYPE = rf"{_ONE_TYPE}(?:[ \t]*\|[ \t]*{_ONE_TYPE})*+"
_PAIR = re.compile(
    r"(?<![A-Za-z0-9_$.-])([A-Za-z_$][A-Za-z0-9_$.-]*+)[\"']?(?:[ \t]*\])?[ \t]*"
    rf"(?:\??:[ \t]*({_TYPE})[ \t]*=(?![=>])|:=|=>|[:=])[ \t]*({_TERM})"
)
_MORE = re.compile(rf"[ \t]*\+[ \t]*({_TERM})")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# How strongly a part of a name speaks for a secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "private": 0.7, "auth": 0.7, "key": 0.7, "access": 0.65, "salt": 0.65,
}
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|change_?me|example.*|your.*|todo|placeholder.*|<.*>)$")


_PLACEHOLDER_HEAD = re.compile(r"(?i)example|your|placeholder")
# Characters that are kept of a literal to see whether it is a placeholder: all of a short one, the first of others.
SHORT, HEAD = 64, 16


def name_weight(name: str) -> float:
    parts = [p.lower() for p in _PART.findall(name)]
    return max((NAME_WEIGHTS.get(p, 0.0) for p in [*parts, *(a + b for a, b in zip(parts, parts[1:]))]), default=0.0)


@dataclass(frozen=True)
class Value:
    """What is known of a literal put together of others: enough to weigh it, whatever its length."""

    counts: Counter
    length: int = 0
    head: str = ""  # the first characters
    last: str = ""
    short: str | None = ""  # the whole text up to SHORT characters

    @classmethod
    def of(cls, text: str) -> Value:
        return cls(Counter(text), len(text), text[:HEAD], text[-1:], text if len(text) <= SHORT else None)

    def __add__(self, other: Value) -> Value:
        whole = None if self.short is None or other.short is None else self.short + other.short
        return Value(
            self.counts + other.counts, self.length + other.length, (self.head + other.head)[:HEAD], other.last or self.last,
            whole if whole is not None and len(whole) <= SHORT else None,
        )

    def is_placeholder(self) -> bool:
        if self.short is not None:
            return bool(_PLACEHOLDER.match(self.short))
        one_kind = set(self.counts) <= {"x", "X"} or set(self.counts) in ({"*"}, {"."})
        return one_kind or bool(_PLACEHOLDER_HEAD.match(self.head)) or (self.head[0] == "<" and self.last == ">")


def literal_weight(literal: str | Value) -> float:
    """How much a literal looks like a secret: long, of mixed characters, no placeholder and no prose."""
    value = Value.of(literal) if isinstance(literal, str) else literal
    n, counts = value.length, value.counts
    if n < 8 or value.is_placeholder() or " " in counts:
        return 0.0
    entropy = -sum(share * math.log2(share) for k in counts.values() if (share := k / n))
    mixed = any(c.isdigit() for c in counts) + any(c.isalpha() for c in counts) + any(not c.isalnum() for c in counts)
    return (1.0 if n >= 12 else n / 12) * min(1.0, entropy / 3) * (1.0 if mixed > 1 else 0.5)


def assigned_literals(text: str) -> Iterator[tuple[float, int, int]]:
    """(score, start, end) of each literal, scored by the most secret name that it reaches.

    A name is a node with its own literals and the earlier nodes that it is made of, so long chains and
    sums of constants take time in proportion to the text; scores go back along them at the end.
    """
    known: dict[str, int] = {}
    values: list[Value] = []
    scores: list[float] = []
    literals: list[list[tuple[int, int]]] = []
    made_of: list[set[int]] = []
    at = 0
    while found := _PAIR.search(text, at):
        terms, end = [(found[3], found.start(3), found.end(3))], found.end(3)
        while more := _MORE.match(text, end):
            terms.append((more[1], more.start(1), more.end(1)))
            end = more.end(1)
        at = end
        value, own, parts = Value.of(""), [], set()
        for term, start, stop in terms:
            if term[0] in "\"'":
                value = value + Value.of(term[1:-1])
                own.append((start + 1, stop - 1))
            elif (name := term.strip("${}")) in known:  # a constant: its literals count where they were written
                value = value + values[known[name]]
                parts.add(known[name])
            elif term[0] != "$":
                value = value + Value.of(term)
                own.append((start, stop))
        if own or parts:
            known[found[1]] = len(values)
            # What stands where a type does may be the name itself, as in `Cookie: auth_key=x`.
            scores.append(max(name_weight(found[1]), name_weight(found[2] or "")) * literal_weight(value))
            values.append(value)
            literals.append(own)
            made_of.append(parts)
    for node in reversed(range(len(values))):
        for part in made_of[node]:
            scores[part] = max(scores[part], scores[node])
        yield from ((scores[node], start, stop) for start, stop in literals[node])


def find_secrets(text: str | None, secret_score: float = SECRET_SCORE) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then in the order of KINDS; ends are exclusive."""
    if not text:
        return []
    spans = []
    pairs = "=" in text or ":" in text
    if pairs:
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if pairs:
        new = {(start, end) for score, start, end in assigned_literals(text) if score >= secret_score}
        spans += [("literal", a, b) for a, b in new if not any(s <= a and b <= e for _, s, e in spans)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every stretch of overlapping spans replaced."""
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], REPLACEMENT]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scanner(text: str, secret_score: float, redacted: bool, schema: pa.Schema):
    def scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, text):
            texts = rows.column(text).to_pylist()
            found = [find_secrets(t, secret_score) for t in texts]
            columns = list(rows.columns)
            if redacted:
                columns[rows.schema.names.index(text)] = pa.array([redact(t, s) for t, s in zip(texts, found)], pa.string())
            spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found], schema.field("secrets").type)
            yield pa.RecordBatch.from_arrays([*columns, spans], names=schema.names)

    return scan_rows


def scan(docs: DataFrame, text: str = "text", *, secret_score: float = SECRET_SCORE, redacted: bool = False) -> DataFrame:
    """The documents with `secrets`: an array of (kind, start, end); `redacted` also replaces them.

    Kinds assign, access and hex are the fixed patterns over the whole text; literal is what the
    lexer adds outside them. Time and memory follow the length of a text, however its constants are put
    together. Null and empty texts have none. Other columns pass through; one named
    `secrets` is replaced.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "secrets"])
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("secrets", T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = pa.schema([*(pa.field(c, pa.null()) for c in docs.columns), pa.field("secrets", arrow)])
    return docs.mapInArrow(_scanner(text, secret_score, redacted, names), schema)


by_value(__name__)
