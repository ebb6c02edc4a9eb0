"""Registered queries of the subpackage, each with its SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import (
    chat_format, decontaminate, disclosure, html_extract, jaccard_join, lexical_search, line_dedup, mixing, quality_rules,
    secret_scan, spelling, substring_dedup, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; without SQL it is tested by brute force instead."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(rf"""
    WITH words AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
    repeated AS (
        SELECT doc_id, i FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
        FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words)
        ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
""")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = toxicity.held_out(F.col("doc_id")).alias("held_out")
    scored = toxicity.score(docs.select("doc_id", held_out, "text"), model)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


LETTER_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)


@query(rf"""
    WITH items AS (SELECT item_id, {LETTER_WORDS} AS w FROM benchmark),
    parts AS (
        SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS s, least(len(w), 10) AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    docs AS (SELECT doc_id, {LETTER_WORDS} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS s
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM parts))),
    hits AS (SELECT doc_id, i, k, item_id FROM windows JOIN parts USING (k, s)),
    words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
    found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    )


# Sources are numbered; the first ten count as web crawl here, the others as books.
DOMAIN = "CASE WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) < 10 THEN 'web' ELSE 'books' END"
WEIGHTS = (("web", 3), ("books", 1), ("web/en", 2), ("books/en", 2))


def source_mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    weights = spark.createDataFrame(list(WEIGHTS), "path string, weight long")
    return mixing.mix(docs.withColumn("domain", F.expr(DOMAIN)), weights)


def _budget_sql(depth: int) -> str:
    """One level of the budget tree, after the CTE of the level above."""
    names = ["domain", "lang", "source"][:depth]
    parents = names[:-1]
    parent = f"JOIN b{depth - 1} USING ({', '.join(parents)})" if parents else ", (SELECT CAST(floor(sum(n) * 0.5) AS HUGEINT) AS budget FROM docs)"
    family = f"PARTITION BY {', '.join(parents)}" if parents else ""
    path = " || '/' || ".join(names)
    return f"""
    l{depth} AS (
        SELECT *, budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
               sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
        FROM (
            SELECT {', '.join(names)}, {path} AS path, sum(n)::HUGEINT * 2 AS capacity, any_value(coalesce(v.weight, 1))::HUGEINT AS weight
            FROM docs LEFT JOIN weights v ON v.path = {path} GROUP BY {', '.join(names)}) {parent}
        WINDOW w AS ({family} ORDER BY capacity / weight, path)),
    b{depth} AS (
        SELECT {', '.join(names)}, CASE WHEN capacity * weights <= remaining * weight THEN capacity ELSE
            (budget - coalesce(sum(capacity) FILTER (capacity * weights <= remaining * weight) OVER f, 0)) * weight
            // (sum(weight) FILTER (NOT capacity * weights <= remaining * weight) OVER f) END AS budget
        FROM l{depth} WINDOW f AS ({family}))"""


@query(rf"""
    WITH docs AS (
        SELECT *, len({SPACE_WORDS})::BIGINT AS n FROM (
            SELECT doc_id, text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   CASE WHEN TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) < 10 THEN 'web' ELSE 'books' END AS domain
            FROM documents)
        WHERE n > 0),
    weights(path, weight) AS (VALUES {', '.join(map(str, WEIGHTS))}),
    {_budget_sql(1)}, {_budget_sql(2)}, {_budget_sql(3)},
    plan AS (
        SELECT domain, lang, source, any_value(budget)::BIGINT // sum(n)::BIGINT AS epochs, any_value(budget)::BIGINT % sum(n)::BIGINT AS part
        FROM docs JOIN b3 USING (domain, lang, source) GROUP BY domain, lang, source),
    ordered AS (
        SELECT *, sum(n) OVER (PARTITION BY domain, lang, source
                               ORDER BY md5('mix-1:' || epochs || ':' || doc_id), doc_id) - n AS before
        FROM docs JOIN plan USING (domain, lang, source)),
    taken AS (
        SELECT domain, lang, source, doc_id, text, n, unnest(range(0, epochs)) AS epoch, n AS k FROM ordered
        UNION ALL
        SELECT domain, lang, source, doc_id, text, n, epochs, least(n, part - before) FROM ordered WHERE before < part)
    SELECT doc_id, domain, lang, source, epoch::BIGINT AS epoch, n AS n_words, k::BIGINT AS taken_words,
           sha256(CASE WHEN k = n THEN text ELSE array_to_string(({SPACE_WORDS})[1 : k::BIGINT], ' ') END) AS text_sha256
    FROM taken
""")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(spark, table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).select(
        "doc_id", "domain", "lang", "source", "epoch", "n_words", "taken_words", F.sha2("text", 256).alias("text_sha256")
    )


@query(rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
    FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
""")
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def _spans(kinds: tuple[str, ...], column: str = "secrets"):
    """kind:start:end of the spans of some kinds, comma-joined."""
    chosen = F.filter(column, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query()
def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_spans(secret_scan.KINDS[:3]), 256).alias("base_sha256"), _spans(secret_scan.KINDS).alias("spans"), count("literal"),
    )


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    failed = quality_rules.base_failed()
    return quality_rules.statistics(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & rules.verdict()).alias("kept"),
    )


CONTROL = "</s>[INST] ok [/INST]"


def _formatted_sql(text: str) -> str:
    return f"replace(replace({text}, '&', '&amp;'), '<', '&lt;')"


@query(f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '{CONTROL}'), (-7, 1, 'assistant', '{CONTROL}')),
    joined AS (
        SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS digest,
               coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
               sum(length('<|turn|>' || {_formatted_sql('role')} || '<|text|>' || {_formatted_sql('text')} || '<|end|>')) AS chars
        FROM turns GROUP BY conv_id)
    SELECT conv_id, n::BIGINT AS n_turns, sha256(digest) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
           sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
    FROM joined
""")
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], turns.schema)
    back = chat_format.read_back(chat_format.format_paths(chat_format.linear_replies(turns.unionByName(planted))))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(r"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda i: list_reduce(
            list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    runs AS (
        SELECT doc_id, run, count(*) AS k, hex(encode(doc_id || ':' || run)) AS bytes
        FROM (SELECT doc_id, unnest(regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
              FROM documents)
        WHERE length(run) >= 7 GROUP BY doc_id, run),
    hashed AS (
        SELECT run, k, xor(list_reduce(
            list_prepend(4294967295, list_transform(range(length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
        FROM runs, crc),
    words AS MATERIALIZED (
        SELECT word, sum(k)::BIGINT AS n
        FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
    variants AS (
        SELECT word, n, 0 AS i, word AS v FROM words
        UNION ALL SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
        SELECT DISTINCT x.word, x.n, y.word AS near, y.n AS near_n
        FROM variants x JOIN variants y USING (v) WHERE x.word <> y.word AND (x.i = y.i OR x.i = 0 OR y.i = 0)),
    best AS (
        SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word),
    forms AS MATERIALIZED (
        SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
               CASE WHEN form_n >= 10 * n THEN form_n END::BIGINT AS form_n
        FROM words LEFT JOIN best USING (word)),
    steps AS (
        SELECT word, word AS root, form AS next FROM forms
        UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN steps USING (word) WHERE next IS NULL
""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spelling.spelling_groups(words)


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("personal", lambda s: s["kind"] == kind)).cast("long")

    terms = (disclosure.REMOVED, disclosure.GENERALISED)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in disclosure.KINDS],
        F.sha2(_spans(disclosure.KINDS, "personal"), 256).alias("base_sha256"), _spans((*disclosure.KINDS, *terms), "personal").alias("spans"),
        *[count(k).alias(f"n_{k}") for k in terms], F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("clean_sha256"),
    )


SEARCH_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(rf"""
    WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {SEARCH_TERMS} AS t FROM documents),
    total AS (SELECT count(*) AS all_docs, sum(len(t))::BIGINT AS all_terms FROM docs WHERE len(t) > 0),
    items AS (SELECT DISTINCT item_id, unnest({SEARCH_TERMS}) AS term FROM benchmark),
    postings AS (
        SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM docs)
        WHERE term IN (SELECT term FROM items) GROUP BY r, doc_id, n, term),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, total GROUP BY term),
    scores AS (
        SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
        FROM items JOIN postings USING (term) JOIN weights USING (term), total GROUP BY item_id, r, doc_id)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 10
""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))
