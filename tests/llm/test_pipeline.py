"""The corpus pipeline: each stage against a plain version of its rule, on its own input."""

import corpus_pipeline
from cohortweave.llm import toxicity
from cohortweave.llm.queries import table

from .test_line_dedup import brute as brute_lines
from .test_operators import brute_components


def test_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    columns, inputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "mixing":
            assert docs.columns == columns
    before = table(spark, sf, "documents")
    model = toxicity.fit(before, table(spark, sf, "labels"))
    clean = {r["doc_id"] for r in toxicity.score(before, model).collect() if r["score"] < toxicity.THRESHOLD}
    assert set(inputs["line_dedup"]) == clean

    lines = brute_lines([(d, r["text"]) for d, r in inputs["line_dedup"].items()])
    assert {d: r["text"] for d, r in inputs["ngram_jaccard_join"].items()} == {
        d: text for d, text, n in lines if n == 0 or text.strip(" ")
    }
    groups = brute_components([(d, r["text"]) for d, r in inputs["ngram_jaccard_join"].items()])
    assert set(inputs["decontamination"]) == {c for _, _, c in groups}
    assert set(inputs["mixing"]) <= set(inputs["decontamination"])
    mixed = docs.collect()
    assert mixed and {r["doc_id"] for r in mixed} <= set(inputs["mixing"])
    assert corpus_pipeline.ORACLE_SQL is None
