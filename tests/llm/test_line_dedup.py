import hashlib

import pyarrow as pa

from cohortweave.llm import queries
from cohortweave.llm.line_dedup import NEAR_WORDS, dedup_lines, find_lines


def one_edit(a: list[str], b: list[str]) -> bool:
    """Whether replacing, adding or deleting one word makes the lists equal; they differ."""
    if abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[p + 1 :] == b[p + 1 :]
    a, b = sorted((a, b), key=len)
    return a[p:] == b[p + 1 :]


def brute(docs: list[tuple]) -> list[tuple]:
    """(doc_id, kept text, number of removed lines)."""
    seen: list[list[str]] = []
    exact: set[str] = set()
    out = []
    for doc_id, text in sorted(docs):
        kept = []
        for raw in text.split("\n"):
            line = raw.replace("\t", " ").strip(" ")
            words = line.split(" ")
            gone = bool(line.strip("\r\x0b\x0c ")) and line in exact
            if len(words) >= NEAR_WORDS:
                gone = gone or any(one_edit(words, s) for s in seen if abs(len(s) - len(words)) < 2)
                if line not in exact:
                    seen.append(words)
            exact.add(line)
            if not gone:
                kept.append(raw)
        out.append((doc_id, "\n".join(kept), len(text.split("\n")) - len(kept)))
    return out


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in dedup_lines(df).orderBy("doc_id").collect()]
    assert got == brute(docs)
    return got


def test_small_cases(spark):
    a = "one two three four five six seven eight nine ten"
    docs = [
        (1, a + "\nshort line\n" + a),
        (2, a.replace("three", "3") + "\nshort line"),
        (3, "zero " + a),
        (4, a.replace(" ten", "")),
        (5, "x " + a.replace(" ten", "")),
        (6, "one two three four 5 six seven 8 nine ten"),
        (7, ""),
        (8, "one two three four five"),
        (9, "  one two three four five \n\n\n"),
        (10, a.replace("seven", "7").replace("three", "3")),
    ]
    got = check(spark, docs)
    assert [r[2] for r in got] == [1, 2, 1, 1, 1, 0, 0, 0, 1, 1]


def test_given_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert any(n for _, _, n in check(spark, [tuple(r) for r in rows]))


def test_nulls_ties_extra_columns_and_empty_table(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(None, a, 1), (1, a, 2), (1, a, 2), (2, None, 3), (3, a + " " + "w " * 3000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed_lines int").selectExpr("*", "1 AS h1", "'x' AS line")
    got = {(r["doc_id"], r["text"], r["n_removed_lines"], r["line"]) for r in dedup_lines(df).collect()}
    assert got == {(None, a, 0, "x"), (1, "", 1, "x"), (2, None, 0, "x"), (3, rows[4][1], 0, "x")}
    assert dedup_lines(df).count() == 5
    assert dedup_lines(df.limit(0)).count() == 0


def test_short_lines(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = [
        (1, "short line\nshort line\n\n\n \t\n"), (2, "short line\nshort lines\n一行没有空格的文字"), (3, "一行没有空格的文字\none\ttwo three"),
        (4, "one two three\none two three four five"), (5, "one two 3 four five\ntwo three four five\none two three four five six"),
        (6, "a b c d e f g h i"), (7, "a b c d e f g h i j\na b c d x f g h i"), (8, ten), (9, ten.replace("five ", "")), (10, "\r\n\r"),
        (11, "x a b c d e f g h i j"), (12, "a b C D e"), (13, "a b c D e\na B C D e\nA B c D e"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in dedup_lines(df).orderBy("doc_id").collect()]
    assert got == brute(docs)
    assert [r[2] for r in got] == [1, 1, 1, 1, 2, 0, 2, 0, 1, 0, 1, 0, 2]


def test_query_removes_short_lines(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = {(d, n, hashlib.sha256(text.encode()).hexdigest()) for d, text, n in brute(rows)}
    assert {tuple(r) for r in queries.op6_line_dedup(spark, sf).collect()} == expected


def test_lines_of_a_block():
    texts = ["a b\n\n \tc\td \n", None, "", "\n\nx", "\r\n \x0b", "é  f\n"]
    lines = find_lines(pa.array(texts))
    found = [(int(r), int(n), lines.data[a:b].tobytes().decode()) for r, n, a, b in zip(lines.row, lines.no, lines.starts, lines.ends)]
    assert found == [(0, 0, "a b"), (0, 2, "c d"), (3, 2, "x"), (5, 0, "é  f")]


def test_repeated_and_missing_ids(spark):
    """Documents of one id are told apart by their texts, also where they have none."""
    a = "one two three four five six seven eight nine ten"
    rows = [(1, a + "\nx"), (1, a + "\ny"), (None, "same line\nu"), (None, "same line\nv"), (2, "same line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in dedup_lines(df).collect())
    assert sum(a in t for _, t in texts) == 1 and sum("same line" in t for _, t in texts) == 1
    named = df.filter("doc_id IS NOT NULL").selectExpr("concat('d', doc_id) AS doc_id", "text")
    assert dedup_lines(named).agg({"n_removed_lines": "sum"}).first()[0] == 1
