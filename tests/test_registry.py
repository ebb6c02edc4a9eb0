"""Harmonization, search, lookups and validation on hand-written registries."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import variables
from cohortweave.operators.harmonize import harmonize
from cohortweave.operators.modalities import TAGGERS, harmonize_modality, register

MAPPING = "original_variable_name string, standard_name string"


def test_harmonize_renames_prefixes_and_merges(spark):
    registry = spark.createDataFrame(
        [("hr", "Heart Rate"), ("pulse", "Heart Rate"), ("same", "same"), (None, "lonely"), ("blank", "")], MAPPING
    )
    df = spark.createDataFrame(
        [(1, None, 9, "x", 2, "s", "p")],
        "`my.col` int, hr int, pulse int, same string, lonely int, visit_session string, blank string",
    )
    out = df.transform(harmonize(registry))
    assert out.columns == ["nonstandard_my.col", "Heart Rate", "same", "lonely", "visit_session", "blank"]
    assert out.first()["Heart Rate"] == 9


def test_harmonize_is_one_projection(spark):
    registry = spark.createDataFrame([("id", "Identifier")], MAPPING)
    plan = spark.range(3).transform(harmonize(registry))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_last_registry_row_decides(spark):
    registry = spark.createDataFrame([("a", "first", 1), ("a", "second", 2)], MAPPING + ", seq int")
    assert spark.createDataFrame([(1,)], "a int").transform(harmonize(registry, "seq")).columns == ["second"]


@pytest.mark.parametrize(
    ("plugin", "ddl", "row", "modality"),
    [
        ("omics", "rsid string, protein_id string", ("r", "p"), "genomics"),
        ("omics", "protein_id string", ("p",), "proteomics"),
        ("omics", "metabolite_name string", ("m",), "metabolomics"),
        ("assessments", "gad7_total int", (3,), "clinical_survey_psychometrics"),
        ("assessments", "mood int", (3,), "clinical_survey_general"),
        ("biospecimens", "specimen_type string", ("Whole BLOOD",), "biospecimen_blood"),
        ("biospecimens", "specimen_type string", (None,), "biospecimen_unknown"),
        ("biospecimens", "value int", (1,), "biospecimen_unspecified"),
        ("wearables", "device_brand string", ("apple",), "digital_biomarker_wearable"),
        ("nlp", "clinical_note string", ("Anxiety and INSOMNIA",), "unstructured_clinical_nlp"),
    ],
)
def test_modality_tags(spark, plugin, ddl, row, modality):
    registry = spark.createDataFrame([], MAPPING)
    out = harmonize_modality(spark.createDataFrame([row], ddl), plugin, registry).first()
    assert out["modality_category"] == modality


def test_untagged_omics_have_no_modality(spark):
    out = spark.createDataFrame([(1,)], "other int").transform(TAGGERS["omics"])
    assert "modality_category" not in out.columns


def test_notes_and_telemetry(spark):
    notes = spark.createDataFrame([("Anxiety, then INSOMNIA",), ("fine",), (None,)], "clinical_note string")
    codes = [r["extracted_snomed"] for r in notes.transform(TAGGERS["nlp"]).collect()]
    assert codes == ["SNOMED:193462001;SNOMED:197480006", "NONE", "NONE"]
    rows = [([60.0, 70.0], ["deep", "rem", "light", "wake"]), ([], []), (None, None)]
    telemetry = spark.createDataFrame(rows, "heart_rate_array array<double>, sleep_stages_array array<string>")
    out = [(r["mean_hr"], r["sleep_efficiency"]) for r in telemetry.transform(TAGGERS["wearables"]).collect()]
    assert out == [(65.0, 50.0), (None, None), (None, None)]


def test_plugins_can_be_added(spark):
    register("imaging", lambda df: df.withColumn("modality_category", F.lit("mri")))
    registry = spark.createDataFrame([], MAPPING)
    assert harmonize_modality(spark.range(1), "imaging", registry).first()["modality_category"] == "mri"
    with pytest.raises(ValueError):
        harmonize_modality(spark.range(1), "unheard_of", registry)
    del TAGGERS["imaging"]


NAMES = ["heart_rate", "heart_rate_max", "heart_rate", "hart_rate", "respiratory_rate", "bmi", "nothing", "rate_heart", None]


def test_search(spark):
    df = spark.createDataFrame([(n, f"o{i % 4}") for i, n in enumerate(NAMES)], "standard_name string, original_variable_name string")

    def found(*args, **kwargs):
        return {r[0] for r in variables.search_variables(df, *args, **kwargs).collect()}

    assert found() == {"o0", "o1", "o2", "o3"}
    assert found("BM|noth") == {"o1", "o2"}
    assert found("hearrt_rate", fuzzy=False) == set()
    assert found("hearrt_rate", output_column="standard_name") == {"heart_rate", "hart_rate", "heart_rate_max"}


def test_code_lookup_takes_the_first(spark):
    registry = spark.createDataFrame([("1-1", "b"), ("1-1", "a"), (None, "z")], "loinc_code string, standard_name string")
    df = spark.createDataFrame([("1-1",), ("2-2",), (None,)], "code string")
    out = {r["code"]: r["standard_name"] for r in variables.standard_names_by_code(df, registry, "code").collect()}
    assert out == {"1-1": "a", "2-2": None, None: None}


def test_levels(spark):
    rows = [
        ("sex", "['1=male', '2 = female']"), ("bad", "not json"), ("none", "[]"), ("null", None), ("mix", '["a", "k=v=w"]'),
    ]
    df = spark.createDataFrame(rows, "standard_name string, levels string")
    out = sorted(tuple(r) for r in variables.categorical_levels(df).collect())
    assert out == [("mix", "k", "v=w"), ("sex", "1", "male"), ("sex", "2", "female")]


def test_violations(spark):
    columns = "original_variable_name string, loinc_code string, omop_concept_id string, datatype string"
    rows = [
        ("ok", "12345-6", "42", "ratio"), ("blank", "", None, "pii_note"), ("code", "12345678-1", "0", "nominal"),
        ("omop", None, "4.5", "nominal"), ("type", None, None, "words"), (None, None, None, None),
    ]
    out = [r["message"] for r in variables.registry_violations(spark.createDataFrame(rows, columns)).collect()]
    assert sorted(out) == sorted([
        "SCHEMA ERROR: Missing columns: standard_name, sdtm_variable, modality, vocabulary",
        "DATA ERROR [code]: Invalid LOINC format '12345678-1'",
        "DATA ERROR [omop]: OMOP Concept ID '4.5' must be an integer",
        "DATA ERROR [type]: Invalid datatype 'words'",
        "DATA ERROR [nan]: Invalid datatype 'nan'",
    ])


def brute_matches(names, keywords, n, cutoff):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rows = Counter(filter(None, names))
    found = set()
    for keyword in set(filter(None, keywords)):
        scored = [(1.0 - edits(a, keyword) / max(len(a), len(keyword)), a) for a in rows]
        best = sorted((x for x in scored if x[0] >= cutoff), reverse=True)[:n]
        found |= {(keyword, name, rows[name], score) for score, name in best}
    return found


@pytest.mark.parametrize("cutoff", [0.2, 0.5, 0.6, 0.75, 0.9, 1.0])
def test_close_matches_of_many_keywords(spark, monkeypatch, cutoff):
    pick = random.Random(int(cutoff * 100))
    texts = ["".join(pick.choices("abé", k=pick.randint(1, 9))) for _ in range(120)] + ["a" * 40, "a" * 39 + "b", "", None]
    keywords = texts[::3] + ["aab", "aab", "zzz", "a" * 41, None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    asked = spark.createDataFrame([(k,) for k in keywords], "word string")
    expected = brute_matches(texts, keywords, 5, cutoff)
    found = [tuple(r) for r in variables.close_matches_of(df, "name", asked, "word", cutoff=cutoff).collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    joined = variables.lookup_join
    monkeypatch.setattr(variables, "lookup_join", lambda *a, **k: joined(*a, max_rows=0, salts=4, **k))
    assert {tuple(r) for r in variables.close_matches_of(df, "name", asked, "word", cutoff=cutoff).collect()} == expected


def test_close_matches_of_agrees_with_one_keyword(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "standard_name string")
    asked = spark.createDataFrame([("hearrt_rate",)], "keyword string")
    one = {tuple(r) for r in variables.close_matches(df, "standard_name", "hearrt_rate").collect()}
    assert one == {tuple(r)[1:] for r in variables.close_matches_of(df, "standard_name", asked).collect()}
    with pytest.raises(ValueError):
        variables.close_matches_of(df, "standard_name", asked, cutoff=0)
    assert variables.close_matches_of(df.limit(0), "standard_name", asked).collect() == []
    assert variables.close_matches_of(df, "standard_name", asked.limit(0)).collect() == []


def test_lookup_join_that_reads_its_rows_once(spark):
    from pyspark.sql import functions as F

    from cohortweave.operators.lookups import lookup_join

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 1, "hot").when(F.col("id") % 3 == 2, F.col("id").cast("string")).alias("k"))
    lookup = spark.createDataFrame([(None, "none"), ("hot", "H"), ("5", "F"), ("7", "S")], "k string, v string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        for null_safe in (False, True):
            wanted = lookup_join(rows, lookup, ["k"], how=how, null_safe=null_safe)
            before = read.value
            found = lookup_join(rows.mapInArrow(counted, rows.schema), lookup, ["k"], how=how, null_safe=null_safe, max_rows=1, once=True)
            assert sorted(found.collect(), key=str) == sorted(wanted.collect(), key=str)
            assert read.value - before == 3000
