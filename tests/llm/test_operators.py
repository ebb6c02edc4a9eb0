"""Rules of single operators, and nulls, empty tables, long texts, ties and clashing columns."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortweave.llm import (
    chat_format, decontaminate, html_extract, jaccard_join, mixing, quality_rules, secret_scan, substring_dedup, toxicity,
)

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a null id, equal rows, a very long text, and columns named like outputs."""
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x y z a b c"), (4, LONG), (5, " \n\t "), (6, "Ünï çödé w")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ("score", "n_words", "secrets", "n_removed", "kept_text", "hits", "node", "epoch", "domain", "lang", "source", "bucket")
    return df.select("*", *[F.lit("kept").alias(c) for c in clash])


def test_secret_lexer():
    text = 'KEY = "abCD1234efGH5678"\npassword: KEY\nexport DB_PASSWD=hunter2hunter2\ncolor = "abCD1234efGH9999"\ntokenizer: name\n'
    found = secret_scan.find_secrets(text)
    assert ("literal", 7, 23) in found  # the constant that a password is set to
    assert any(k == "assign" and text[a:b] == "PASSWD=hunter2hunter2" for k, a, b in found)
    assert not any("9999" in text[a:b] for _, a, b in found)
    joined = 'client_secret = "ab12CD" + "34efGH99"'
    assert [joined[a:b] for k, a, b in secret_scan.find_secrets(joined) if k == "literal"] == ["ab12CD", "34efGH99"]
    assert secret_scan.redact(text, found).count(secret_scan.REPLACEMENT) == 2
    assert secret_scan.find_secrets('password = "changeme"') == [] and secret_scan.find_secrets(None) == []
    assert secret_scan.find_secrets("ﬁ AKIAABCDEFGHIJ1234 0123456789abcdef") == [("access", 2, 20), ("hex", 21, 37)]


@pytest.mark.parametrize("text", [
    "spring.security.oauth2.client.registration." + "provider." * 9 + "credentials.private-key=@",
    'password: str = "@"', 'const apiKey: string = "@"', "let db_password: &'static str = \"@\"", 'val token: String? = "@"',
    'key: Optional[list[str]] = "@"', 'os.environ["DB_PASSWORD"] = "@"', "conf['db'][ 'passwd' ] = '@'",
    'salt = "@"', 'access: "@"', "Cookie: auth_key=@",
])
def test_secret_names(text):
    text = text.replace("@", "q7Rk2pZx9vLm4TsW")
    assert "q7Rk2pZx9vLm4TsW" in [text[a:b] for k, a, b in secret_scan.find_secrets(text) if k == "literal"]


def test_secret_constant_keeps_all_its_parts():
    text = 'a = "q7Rk2pZx" + "9vLm4TsW"\nb = a + "Yd5N"\npassword = b\n'
    assert [text[a:b] for _, a, b in secret_scan.find_secrets(text)] == ["q7Rk2pZx", "9vLm4TsW", "Yd5N"]
    assert secret_scan.find_secrets("password == abcd1234efgh; x: name = colour1234567\n") == []


def test_secret_constants_take_linear_time():
    start = time.perf_counter()
    doubled = 'a = "q7Rk2pZx9vLm"\n' + "a = a + a\n" * 10_000 + "password = a\n"
    assert [doubled[x:y] for _, x, y in secret_scan.find_secrets(doubled)] == ["q7Rk2pZx9vLm"]
    grown = 'a = "q7Rk2pZx9vLm"\n' + "".join(f'a = a + "{i * 40503 % 65536:04x}"\n' for i in range(8_000)) + "token_ = a\n"
    assert len(secret_scan.find_secrets(grown)) == 8_001
    assert time.perf_counter() - start < 6
    for text in ("x" * 70, "*" * 70, "example" + "1a" * 40, "<" + "a1" * 40 + ">", "q7Rk2pZx" * 12, "your-" + "q7" * 40):
        whole, parts = secret_scan.literal_weight(text), secret_scan.Value.of(text[:40]) + secret_scan.Value.of(text[40:])
        assert secret_scan.literal_weight(parts) == whole and (whole > 0) == text.startswith("q7")


def test_scan_odd_rows(spark, odd):
    out = secret_scan.scan(odd, redacted=True)
    assert out.count() == 8 and out.filter(F.size("secrets") > 0).count() == 0
    assert out.filter("text IS NULL").count() == 1
    assert secret_scan.scan(odd.limit(0)).count() == 0


def test_decision_list_learns_thresholds():
    rng = np.random.default_rng(0)
    x = {m: rng.random(900) for m in quality_rules.MEASURES}
    bad = (x["symbols_per_word"] > 0.7) | ((x["upper_share"] > 0.6) & (x["words"] < 0.5))
    rules = quality_rules.learn(x, bad)
    covered = np.zeros(900, bool)
    for rule in rules.rules:
        covered |= quality_rules._all(rule.conditions, x)
    assert (covered == bad).mean() > 0.97 and not quality_rules.learn(x, np.zeros(900, bool)).rules


def test_statistics_odd_rows(spark, odd):
    out = quality_rules.statistics(odd).select("doc_id", *quality_rules.COUNTS)
    counts = {(r["doc_id"], r["n_words"], r["word_chars"]) for r in out.collect()}
    assert counts == {(1, 3, 3), (2, 0, 0), (3, 0, 0), (None, 6, 6), (4, 30_000, len(LONG) - 29_999), (5, 0, 0), (6, 3, 8)}
    assert quality_rules.statistics(odd.limit(0)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.fit(odd.select("doc_id", "text"), labels).rules == ()


def test_repeats_odd_rows(spark, odd):
    out = substring_dedup.remove_repeats(odd, width=3)
    rows = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_text"][:9]) for r in out.collect())
    assert rows == [(0, 6, 3, "x y z"), (1, 3, 3, ""), (1, 3, 3, ""), (2, 0, 0, ""), (3, 0, 0, ""), (4, 30_000, 0, LONG[:9]), (5, 0, 0, ""), (6, 3, 0, "Ünï çödé ")]
    assert {r[0] for r in out.select("score").distinct().collect()} == {"kept"}
    assert substring_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_overlapping_repeats_within_one_text(spark):
    df = spark.createDataFrame([(1, "a a a a b"), (2, "c d e c d e f")], "doc_id long, text string")
    rows = [tuple(r)[2:] for r in substring_dedup.remove_repeats(df, width=3).orderBy("doc_id").collect()]
    assert rows == substring_dedup.repeats_of(["a a a a b", "c d e c d e f"], 3) == [(5, 4, "b"), (7, 6, "f")]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><div class="main-menu"><a>Home</a></div>
<header><h1>Site</h1></header><div id=content><h2>Title &amp; more</h2><p>First <b>bo</b>ld
  text.<p>Second&nbsp;one<br>three</div><aside>Side</aside><div class='comments'><p>Nice!</p></div>
<form><input><label>Mail</label></form><script>var x = "<p>no</p>";</script><!-- <p>not</p> --><p hidden>secret</p>
<p>Shared line</p><footer>&copy; me</footer>"""


def test_main_text_of_plain_layouts():
    assert html_extract.main_text(PAGE) == "Title & more First bold text. Second one three Shared line"
    assert html_extract.main_text("<p>a < b <3 &lt;c&gt; <unknown>d") == "a < b <3 <c> d"
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<article></article>") == ""
    assert html_extract.main_text("<body><p>out</p><article><p>in<article><p>too") == "in too"


def test_article_text_is_not_cut():
    text = html_extract.main_text
    for drawing in ("<svg viewBox='0 0 1 1'/>", "<svg><path d=''/></svg>", "<svg>", "<svg/><object data='x'/>"):
        assert text(f"<article><p>a{drawing} b</p><p>c</p></article>") == "a b c"
    assert text("<article><svg/><p>a</p><svg><text>no</text></svg><p>b</article>") == "a b"
    assert text("<article>if <math><mi>x</mi><mspace/><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> then") == "if x=2 then"
    assert text('<article class="post has-sidebar"><section id="related-work">a</section><p class="notice">b<div class="share-prices">c</div>') == "a b c"
    assert text('<div role="main" class="page-widget"><p>a</div>') == "a"
    assert text('<div class="has-sidebar"><p>a</p><div class="share-prices">b</div><div class="comment-list">no</div></div>') == "a b"
    assert text('<div class="sidebar"><article><p>a b c d</article></div><p>e') == "a b c d"


def test_template_text_is_left_out(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.replace("First", f"Nr {i}")) for i in range(5)] + [(9, None, None), (9, "x", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("template", F.lit(1))
    out = sorted((r["page_id"], r["text"]) for r in html_extract.extract_text(df).collect())
    assert out[0] == (0, "Nr 0 bold text.") and len(out) == 7
    assert out[5][1] == "" and out[6][1].endswith("Shared line")
    assert html_extract.extract_text(df.limit(0)).count() == 0


def test_template_text_is_left_out_of_articles(spark):
    html = "<nav>Menu</nav><article><h1>Nr {}</h1><p>Same <b>words</b></p><p>Body {} <b>words</b></p></article>"
    rows = [(i, f"http://h.example/{i}", html.format(i, i)) for i in range(4)]
    rows += [(i, f"http://copies.example/{i}", html.format(0, 0)) for i in range(4, 8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = [r["text"] for r in html_extract.extract_text(df).orderBy("page_id").collect()]
    assert out == [f"Nr {i} Body {i} words" for i in range(4)] + ["Nr 0 Same words Body 0 words"] * 4


def extracted(spark, pages):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html_extract.extract_text(df).orderBy("page_id").collect()]


def test_text_is_of_the_template_in_one_slot_and_content_in_another(spark):
    pages = [f"<h1>Nr {i}</h1><p>Follow us</p><h2>Body</h2><p>Text {i}</p>{'<p>Follow us</p>' * i}" for i in range(4)]
    assert extracted(spark, pages) == [" ".join([f"Nr {i}", f"Text {i}", *["Follow us"] * i]) for i in range(4)]


def test_slots_nest_in_classes():
    places = html_extract._places([["a", "z"], ["b", "c", "d"]])
    assert html_extract.slots_of("axbycxdbcdxzx", places) == [0, *"aabacaaaaa", 0, 0]
    # An instance ends where its class begins again, and with the slot that holds it.
    assert html_extract.slots_of("abxbxzxax", places) == [0, *"abab", 0, 0, 0, "a"]


def test_roles_out_of_order_leave_their_class():
    wrong = html_extract.out_of_order
    assert wrong([1, 9, 2, 3, 4], [[1, 2, 3, 4]]) == wrong([5, 6, 5, 6], [[5, 6]]) == wrong([], [[1, 2]]) == set()
    assert wrong([4, 1, 2, 3], [[1, 2, 3, 4]]) == {4} and wrong([1, 3, 2, 4], [[1, 2, 3, 4]]) in ({2}, {3})
    assert wrong([5, 5, 6, 6], [[5, 6]]) == {5, 6}


def test_parts_of_some_pages_are_content_and_moved_ones_are_not(spark):
    menu = ["<li>Home</li>", "<li>Shop</li>", "<li>Help</li>"]
    pages = [f"<div><ul>{''.join(menu[i % 3:] + menu[:i % 3])}</ul><h1>Nr {i}</h1>{'<h2>Sale</h2><h3>Now</h3>' if i < 3 else ''}</div>" for i in range(5)]
    assert extracted(spark, pages) == [f"Nr {i}{' Sale Now' if i < 3 else ''}" for i in range(5)]


def test_a_name_is_overruled_by_the_other_pages_of_its_slot(spark):
    page = "<h1>Title of the page {}</h1><div{}>Story {}</div>"
    pages = [page.format(i, ' class="widget"' if i == 3 else "", i) for i in range(4)]
    assert extracted(spark, pages)[3] == "Title of the page 3 Story 3"
    both = [page.format(i, "", i) + ('<div class="comments">Nice</div>' if i > 1 else "") for i in range(4)]
    assert extracted(spark, both) == [f"Title of the page {i} Story {i}" for i in range(4)]


def test_reply_tree_takes_the_best_branch(spark):
    rows = [
        ("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "<|end|>&lt;", 0.9),
        ("t", 4, 3, "user", "more", 0.5), ("t", 5, 4, "assistant", "x", 0.2), ("t", 6, 4, "assistant", "y", 0.3),
        ("t", 7, 99, "user", "orphan", 0.0), ("loop", 1, 2, "user", "a", 0.0), ("loop", 2, 1, "user", "b", 0.0),
        (None, 1, None, "assistant", "", 0.0),
    ]
    df = spark.createDataFrame(rows, "tree string, id long, parent long, role string, text string, score double")
    back = chat_format.read_back(chat_format.format_paths(df)).collect()
    found = {(r["tree"], r["root"]): ([tuple(t) for t in r["turns"]], r["loss_text"]) for r in back}
    assert found == {
        ("t", 1): ([("user", "q"), ("assistant", "<|end|>&lt;"), ("user", "more"), ("assistant", "y")], "<|end|>&lt;y"),
        ("t", 7): ([("user", "orphan")], ""), (None, 1): ([("assistant", "")], ""),
    }
    assert chat_format.format_paths(df.limit(0)).count() == 0


def test_long_chains_and_odd_turns(spark):
    turns = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(70)] + [(2, 0, None, None), (2, 0, "a", "b"), (None, None, "user", "z")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    back = chat_format.read_back(chat_format.format_paths(chat_format.linear_replies(df))).collect()
    found = {r["tree"]: [tuple(t) for t in r["turns"]] for r in back}
    assert found[1] == [t[2:] for t in turns[:70]] and found[2] == [("", ""), ("a", "b")] and found[None] == [("user", "z")]


def brute_components(rows):
    sets = {}
    for doc_id, text in rows:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {d: d for d in sets}
    ids = sorted(sets)
    linked = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return sorted((d, len(sets[d]), label[d]) for d in ids)


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"v{i}" for i in range(400)]
    rows, i = [], 0
    passage = list(rng.choice(vocabulary, 60))
    for family in range(12):
        base = list(rng.choice(vocabulary, rng.integers(40, 160)))
        for copy in range(rng.integers(1, 14)):
            words = list(base)
            for _ in range(rng.integers(0, 6)):
                words[rng.integers(len(words))] = f"e{rng.integers(10_000)}"
            rows.append((i, " ".join(words + (passage if copy % 5 == 4 else []))))
            i += 1
    rows += [(900, "short One"), (901, "short one"), (902, "short"), (903, ""), (904, None), (905, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1))
    got = sorted(tuple(r) for r in jaccard_join.near_duplicates(df).collect())
    assert got == brute_components(rows)
    kept = {r["doc_id"] for r in jaccard_join.keep_one(df).collect()}
    assert kept == {c for _, _, c in got}


def test_components_odd_rows(spark, odd):
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(odd).collect())
    assert got == [(0, 2, None), (1, 1, 1), (1, 1, 1), (2, 0, 2), (3, 0, 3), (4, 29_996, 4), (5, 0, 5), (6, 1, 6)]
    assert jaccard_join.near_duplicates(odd.limit(0)).count() == 0


def test_components_of_repeated_missing_and_text_ids(spark):
    """Rows of one id are told apart by their texts; copies without id leave one."""
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, "c " * 9 + "d e f g"), (None, "c " * 9 + "d e f g"), (None, None), (9, a), (9, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"] or 0), r["component_id"]) for r in jaccard_join.near_duplicates(df).collect())
    assert found == [(0, None), (0, None), (0, None), (1, 1), (1, 1), (2, 1), (3, 1), (9, 1), (9, 1)]
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in jaccard_join.keep_one(df).collect())
    assert kept == [(0, ""), (0, "c " * 9 + "d e f g"), (1, a), (1, b)]
    again = spark.createDataFrame([(5, a), (5, a), (5, a), (6, "x y z")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in jaccard_join.keep_one(again).collect()) == [5, 6]
    named = df.selectExpr("'d' || doc_id AS doc_id", "text", "1 AS row_hash", "2 AS component")
    assert {r["component_id"] for r in jaccard_join.near_duplicates(named).collect()} == {None, "d1"}


def test_toxicity_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    out = toxicity.score(odd, model)
    assert out.count() == 8 and out.filter("score BETWEEN 0 AND 1").count() == 8
    nothing = toxicity.fit(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score(odd, nothing).collect()} == {0.5}
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_decontamination(spark, odd):
    bench = spark.createDataFrame([("i1", "B c"), ("i2", None), ("i3", "!"), ("i4", "x Y z a b c d e f g h i"), ("i5", "b-c")], "item_id string, text string")
    found = decontaminate.contamination(odd, bench)
    rows = sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in found.collect())
    assert rows == [(0, 6, 2, ["i1", "i5"]), (1, 3, 2, ["i1", "i5"]), (1, 3, 2, ["i1", "i5"]), (2, 0, 0, []), (3, 0, 0, []),
                    (4, 30_000, 0, []), (5, 0, 0, []), (6, 3, 0, [])]
    clean = decontaminate.decontaminate(odd, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4, 5, 6] and clean.columns == odd.columns
    text = "One, TWO three - four five six seven eight nine ten; eleven? Twelve."
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    item = spark.createDataFrame([("q", "two three four five six seven eight nine ten eleven")], "item_id string, text string")
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, item, remove="spans").collect()}
    assert cut == {1: "One, Twelve.", 2: None}
    empty = decontaminate.contamination(docs, item.limit(0))
    assert {r["n_hit"] for r in empty.collect()} == {0} and decontaminate.contamination(docs.limit(0), item).count() == 0


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "z", 1000)], "l1 string, l2 string, tokens long")
    out = {(r["l1"], r["l2"]): r["budget"] for r in mixing.budgets(leaves, None, 180, ["l1", "l2"], 1).collect()}
    assert out == {("a", "x"): 10, ("a", "y"): 80, ("b", "z"): 90}
    out = {(r["l1"], r["l2"]): r["budget"] for r in mixing.budgets(leaves, None, 600, ["l1", "l2"], 1).collect()}
    assert out == {("a", "x"): 10, ("a", "y"): 100, ("b", "z"): 490}


def test_mix_odd_rows(spark, odd):
    out = mixing.mix(odd, share=0.5, max_epochs=3)
    taken = out.groupBy("doc_id").agg(F.sum("taken_words").alias("n")).collect()
    assert sum(r["n"] for r in taken) == int(0.5 * 30_015) and set(out.columns) == {*odd.columns, "taken_words"}
    assert mixing.mix(odd.limit(0)).count() == 0
    all_of_it = mixing.mix(odd, share=2.0, max_epochs=2)
    assert sorted((r["doc_id"] or 0, r["epoch"]) for r in all_of_it.collect()) == sorted((d, e) for d in (0, 1, 1, 4, 6) for e in (0, 1))


def test_distinct_values():
    from cohortweave.llm.words import distinct

    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 500):
        values = rng.integers(0, 90, n).astype(np.uint64)
        assert distinct(values).tolist() == sorted(set(values.tolist()))


def test_pairs_are_measured_across_batches():
    import zstandard

    from cohortweave.llm.jaccard_join import _measurer

    texts = {1: "a b c d e f g", 2: "a b c d e f g h", 3: "x y z x y z", 9: "a b c d e f g"}
    rows = [(1, 0, 1), (1, 0, 1), (1, 0, 2), (1, 0, 2), (1, 0, 3), (1, 1, 1), (1, 1, 9), (3, 0, 3), (3, 0, 1)]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(x) for x in zip(*[(*r, zstandard.compress(texts[r[2]].encode())) for r in rows[i : i + 4]])],
            names=["pivot", "part", "node", "packed"],
        ) for i in range(0, len(rows), 4)
    ]
    found = [tuple(r.values()) for b in _measurer(75)(iter(batches)) for r in b.to_pylist()]
    assert found == [(1, 2, 0.25, True), (1, 3, 1.0, False), (1, 9, 0.0, True), (3, 1, 1.0, False)]


def test_toxicity_works_on_small_blocks(monkeypatch):
    from cohortweave.llm import toxicity
    from cohortweave.llm.words import SMALL_BLOCK_BYTES, find_words

    seen = []
    monkeypatch.setattr(toxicity, "find_words", lambda texts, **how: seen.append(sum(map(len, texts.to_pylist()))) or find_words(texts, **how))
    batch = pa.RecordBatch.from_arrays([pa.array(["some words " * 4_000] * 100), pa.array([0, 1] * 50)], names=["text", "label"])
    list(toxicity._trainer(toxicity.Ftrl(epochs=1), 20)([batch]))
    list(toxicity._scorer(toxicity.Model(0.0, np.zeros(0, np.int32), np.zeros(0)), "text")([batch]))
    assert sum(seen) == 2 * 100 * 44_000 and max(seen) <= SMALL_BLOCK_BYTES


def test_pairs_are_computed_once_for_their_measures(spark):
    import zstandard

    seen = spark.sparkContext.accumulator(0)

    def counted(n):
        seen.add(1)
        return n

    names = {1: "a b c d e f g h i j", 2: "a b c d e f g h i", 3: "k l m n o p"}
    texts = spark.createDataFrame([(k, bytearray(zstandard.compress(t.encode()))) for k, t in names.items()], "node long, packed binary")
    pairs = spark.createDataFrame([(1, 2, 5), (1, 3, 2)], "pivot long, node long, n long")
    pairs = pairs.select("pivot", "node", F.udf(counted, "long")("n").alias("n"))
    found = {r["node"]: r["linked"] for r in jaccard_join._measured(pairs, texts, 80, 2).collect()}
    assert found == {2: True, 3: False}
    assert seen.value == 2


def test_components_grow_from_known_ones_in_few_tasks(spark):
    from cohortweave.llm.components import components
    from cohortweave.sources.workspace import stored

    links = spark.createDataFrame([(3, 2), (2, 1), (3, 4), (8, 9), (9, 8)], "a long, b long")
    known = spark.createDataFrame([(2, 2), (3, 2), (4, 2)], "node long, component long")
    expected = {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}
    for before in (None, known):
        assert {r["node"]: r["component"] for r in components(links, known=before).collect()} == expected
    many = spark.range(0, 1_000, numPartitions=200)
    table = stored(many, "narrow", 1_000)
    assert table.count() == 1_000 and len(table.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism


def test_scoring_needs_little_memory_beside_its_batch():
    import tracemalloc

    batch = pa.RecordBatch.from_pydict({"text": [" ".join(f"w{i}" for i in range(400))] * 2_000})
    model = toxicity.Model(0.1, np.arange(1 << 10, dtype=np.int32), np.ones(1 << 10), 16)
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in toxicity._scorer(model, "text")(iter([batch]))) == 2_000
        assert tracemalloc.get_traced_memory()[1] < 40_000_000
    finally:
        tracemalloc.stop()
