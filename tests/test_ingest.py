"""From raw files on disk to the cohort and questions about it."""

import datetime
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortweave.operators import status
from cohortweave.plans.explorer import CohortExplorer
from cohortweave.plans.gold import build_gold
from cohortweave.plans.ingest import harmonize_files, ingest, plan_scans, read_silver, silver_files
from cohortweave.plans.query import query_gold
from cohortweave.sources import bronze, tables
from cohortweave.sources.manifest import discover, list_bronze, list_files, tier_inventory
from cohortweave.streaming.incremental import ingest_new_files

AS_OF = datetime.date(2024, 1, 1)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("data") / "bronze"

    def put(path, text):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)

    put("genomics/sub-01_ses-01_g.csv", "participant_id,visit_session,rsid,genotype\nsub-01,ses-01,rs1,AA\nsub-01,ses-01,rs2,n/a\n")
    put("genomics/sub-02_ses-01_g.csv", "participant_id,visit_session,rsid,genotype\nsub-02,ses-01,rs9,GG\n")
    put("assessments/sub-01_ses-01_a.csv", "phq9_total,gad7_total\n12,NA\n")
    put("assessments/sub-02_ses-02_a.csv", "participant_id,visit_session,mood\nsub-02,ses-02,3\n")
    put("ehr_notes/sub-01_n.csv", 'clinical_note\n"Anxiety,\nand insomnia"\n')
    put("wearables/sub-01_ses-01_w.json", json.dumps({"device_brand": "Apple", "heart_rate_array": [60, 62], "sleep_stages_array": ["rem", "light"]}))
    put("ehr/sub-02_ses-01.json", json.dumps({"resourceType": "Bundle", "entry": [
        {"resource": {"resourceType": "Patient", "id": "x", "birthDate": "1920-01-01", "name": [{"family": "Lee"}]}},
        {"resource": {"resourceType": "Observation", "code": {"text": "Heart_Rate"}, "valueQuantity": {"value": 70}}}]}))
    put("ehr/broken.json", "{not json")
    put("imaging/sub-01_t1.nii.gz", "x")
    put("pharmacy/sub-03.csv", "a\n1\n")
    (root / "proteomics").mkdir()
    proteins = pd.DataFrame({"participant_id": ["sub-03"], "protein_id": ["P1"], "abundance": [1.5]})
    proteins.to_parquet(root / "proteomics" / "sub-03_ses-07_p.parquet")
    return str(root)


@pytest.fixture(scope="module")
def registry(spark):
    rows = [("phq9_total", "PHQ-9 Total Score", None), ("device_brand", "Device Brand", None), ("genotype", "genotype", None)]
    return spark.createDataFrame(rows, "original_variable_name string, standard_name string, loinc_code string")


@pytest.fixture(scope="module")
def silver(spark, raw, registry, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("tiers") / "silver")
    report = ingest(spark, raw, target, registry, as_of=AS_OF)
    assert report.errors == {} and report.status == "processed"
    return target


def test_manifest(spark, raw):
    files = {r["relative_path"]: r for r in discover(spark, raw).collect()}
    routed = {path: r["plugin"] for path, r in files.items()}
    assert routed == {
        "genomics/sub-01_ses-01_g.csv": "omics", "genomics/sub-02_ses-01_g.csv": "omics",
        "assessments/sub-01_ses-01_a.csv": "assessments", "assessments/sub-02_ses-02_a.csv": "assessments",
        "ehr_notes/sub-01_n.csv": "nlp", "wearables/sub-01_ses-01_w.json": "wearables",
        "proteomics/sub-03_ses-07_p.parquet": "omics", "ehr/sub-02_ses-01.json": "ehr", "ehr/broken.json": None, "imaging/sub-01_t1.nii.gz": None, "pharmacy/sub-03.csv": None,
    }
    assert files["imaging/sub-01_t1.nii.gz"]["message"] == "No plugin mapped for .nii.gz in imaging/"
    assert files["ehr/broken.json"]["subject_id"] == "sub-unknown" and files["ehr/broken.json"]["status"] == "skipped"
    assert files["wearables/sub-01_ses-01_w.json"]["session_id"] == "ses-01"


def test_silver_rows(spark, silver):
    rows = [r.asDict() for r in read_silver(spark, silver).collect()]
    by_modality = {}
    for r in rows:
        by_modality.setdefault(r["modality_category"], []).append(r)
    assert {m: len(v) for m, v in by_modality.items()} == {
        "genomics": 3, "proteomics": 1, "clinical_survey_psychometrics": 1, "clinical_survey_general": 1,
        "unstructured_clinical_nlp": 1, "digital_biomarker_wearable": 1, "demographics": 1, "vital_signs": 1,
    }
    survey = by_modality["clinical_survey_psychometrics"][0]
    assert (survey["PHQ-9 Total Score"], survey["participant_id"], survey["visit_session"]) == (12, "sub-01", "ses-01")
    note = by_modality["unstructured_clinical_nlp"][0]
    assert note["nonstandard_extracted_snomed"] == "SNOMED:193462001;SNOMED:197480006"
    assert (note["participant_id"], note["visit_session"]) == ("sub-01", "ses-01")
    assert by_modality["digital_biomarker_wearable"][0]["nonstandard_sleep_efficiency"] == 50.0
    assert sorted(r["genotype"] or "-" for r in by_modality["genomics"]) == ["-", "AA", "GG"]
    assert by_modality["proteomics"][0]["visit_session"] == "ses-07"
    assert by_modality["demographics"][0]["nonstandard_participant_age"] == 104


def test_status_and_repeated_subject_ingest(spark, raw, registry, silver):
    manifest = discover(spark, raw)
    marked = status.mark_processed(manifest, silver_files(read_silver(spark, silver), raw))
    totals = status.status_counts(marked).filter("subject_id IS NULL").first()
    assert totals["processed"] == totals["processable"] > 0 and totals["pending"] == 0
    before = read_silver(spark, silver).count()
    again = ingest(spark, raw, silver, registry, subject="sub-01", as_of=AS_OF)
    assert again.status == "no_processable_clinical_files"
    assert read_silver(spark, silver).count() == before


def test_subject_and_dry_run(spark, raw, registry, tmp_path):
    target = str(tmp_path / "silver")
    dry = ingest(spark, raw, target, registry, subject="sub-01", dry_run=True)
    assert dry.status == "dry_run" and read_silver(spark, target) is None
    assert dry.summary.first()["total_files"] == 5
    ingest(spark, raw, target, registry, subject="sub-01", as_of=AS_OF)
    assert {r[0] for r in read_silver(spark, target).select("participant_id").distinct().collect()} == {"sub-01"}
    ingest(spark, raw, target, registry, subject="sub-02", as_of=AS_OF)
    assert {r[0] for r in read_silver(spark, target).select("participant_id").distinct().collect()} == {"sub-01", "sub-02"}


@pytest.mark.parametrize("plugin", ["omics", "assessments", "nlp", "ehr", "wearables"])
def test_rows_do_not_depend_on_the_files_per_read(spark, raw, registry, plugin):
    manifest = discover(spark, raw).filter("subject_id <> 'sub-02'") if plugin != "ehr" else discover(spark, raw)
    one, _ = harmonize_files(spark, plugin, plan_scans(manifest, plugin), registry, AS_OF)
    many, _ = harmonize_files(spark, plugin, plan_scans(manifest, plugin, files_per_read=1), registry, AS_OF)
    compared = [n for n in one.columns if n != "_source"]
    assert sorted(map(str, one.select(*[F.col(f"`{n}`") for n in compared]).collect())) == sorted(
        map(str, many.select(*[F.col(f"`{n}`") for n in compared]).collect()))


def test_subjects_whose_types_differ_are_read_together(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "assessments"
    root.mkdir(parents=True)
    (root / "sub-01_a.csv").write_text("mood,code\n3,7\n")
    (root / "sub-02_a.csv").write_text("mood,code\n2.5,x\n")
    silver = str(tmp_path / "silver")
    for subject in ("sub-01", "sub-02"):
        assert ingest(spark, f"file://{tmp_path}/bronze", silver, registry, subject=subject).errors == {}
    rows = read_silver(spark, silver).orderBy("participant_id").collect()
    assert [(r["nonstandard_mood"], r["nonstandard_code"]) for r in rows] == [(3.0, "7"), (2.5, "x")]


def test_records_that_do_not_fit_are_reported(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "assessments"
    root.mkdir(parents=True)
    (root / "sub-01_a.csv").write_text('mood,note\n3,"two\nlines"\n4,a,b\n5\n')
    report = ingest(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), registry)
    assert report.errors == {}
    assert sorted((r["nonstandard_mood"], r["nonstandard_note"]) for r in report.silver["assessments"].fillna("-").collect()) == [
        (3, "two\nlines"), (5, "-")]
    (bad,) = report.bad_records.collect()
    assert (bad["plugin"], bad["record"]) == ("assessments", "4,a,b") and bad["file"].endswith("sub-01_a.csv")


def test_each_row_of_a_mixed_folder_has_its_own_kind(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "omics"
    root.mkdir(parents=True)
    pd.DataFrame({"rsid": ["rs1"], "genotype": ["AA"]}).to_parquet(root / "sub-01_g.parquet")
    pd.DataFrame({"protein_id": ["P1"], "abundance": [1.5]}).to_parquet(root / "sub-01_p.parquet")
    report = ingest(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), registry)
    kinds = {(r["nonstandard_rsid"], r["modality_category"]) for r in report.silver["omics"].collect()}
    assert kinds == {("rs1", "genomics"), (None, "proteomics")}


def test_one_bad_plugin_does_not_stop_the_others(spark, raw, registry, tmp_path, monkeypatch):
    from cohortweave.operators.modalities import TAGGERS

    def fail(df):
        raise RuntimeError("no luck")

    monkeypatch.setitem(TAGGERS, "nlp", fail)
    report = ingest(spark, raw, str(tmp_path / "silver"), registry, as_of=AS_OF)
    assert report.errors == {"nlp": "no luck"} and "omics" in report.silver


@pytest.fixture(scope="module")
def gold(spark, silver, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("gold") / "cohort")
    tables.write_gold(build_gold(read_silver(spark, silver)), target)
    return tables.read_gold(spark, target)


def test_gold(gold):
    rows = {(r["participant_id"], r["visit_session"]): r.asDict() for r in gold.collect()}
    assert set(rows) == {("sub-01", "ses-01"), ("sub-02", "ses-01"), ("sub-02", "ses-02"), ("sub-03", "ses-07")}
    first = rows["sub-01", "ses-01"]
    assert (first["genomics.genotype_0"], first["genomics.genotype_1"], first["genomics.genotype"]) == ("AA", None, None)
    assert rows["sub-02", "ses-01"]["genomics.genotype"] == "GG"
    assert first["clinical_survey_psychometrics.PHQ-9 Total Score"] == 12
    assert rows["sub-02", "ses-01"]["demographics.nonstandard_participant_age"] == 90
    assert rows["sub-02", "ses-01"]["demographics.nonstandard_birth_date"] == 1920
    assert not any("patient_name" in name for name in gold.columns)
    assert all(len(r["provenance_hash_sha256"]) == 64 for r in rows.values())


def test_questions(spark, gold):
    explorer = CohortExplorer(gold)
    found = explorer.find_participants({
        "clinical_survey_psychometrics.PHQ-9 Total Score": (">", 5),
        "digital_biomarker_wearable.Device Brand": ("contains", "apple"),
        "not.there": (">", 1),
    })
    assert [r["participant_id"] for r in found.collect()] == ["sub-01"]
    with pytest.raises(ValueError):
        explorer.find_participants({"participant_id": ("~", 1)})
    stats = explorer.cohort_stats(["clinical_survey_psychometrics.PHQ-9 Total Score"]).first()
    assert (stats["count"], stats["mean"], stats["missing_percent"]) == (1, 12.0, 75.0)
    assert ("genomics", "genotype_0") in {tuple(r) for r in explorer.modalities().collect()}

    result = query_gold(gold, ["sub-02"], ["genomics", "vital_signs"], exclude_nonstandard=True)
    assert result.result_shape()[0] == 2 and result.original_shape()[0] == 4
    assert "genomics.genotype_0" not in result.columns and "genomics.genotype" in result.columns
    assert not any("nonstandard_" in n for n in result.columns)
    record = json.loads(result.records().filter("record LIKE '%ses-02%'").first()[0])
    assert record["genomics.genotype"] is None and record["participant_id"] == "sub-02"
    only = query_gold(gold, variables=["GENO", "genotype", "participant"], exclude_empty=False)
    assert len(only.columns) == len(set(only.columns)) and "provenance_hash_sha256" not in only.columns
    nobody = query_gold(gold, ["sub-99"])
    assert nobody.result_shape() == (0, len(gold.columns))
    members = spark.createDataFrame([("sub-03",)], "participant_id string")
    assert query_gold(gold, members).result_shape()[0] == 1
    many = [f"sub-{i}" for i in range(2000)] + ["sub-01"]
    assert query_gold(gold, many).result_shape()[0] == 1


def test_csv_layouts_and_order(spark, raw):
    layouts = {r["header"] for r in bronze.csv_layouts(spark, f"{raw}/assessments").collect()}
    assert layouts == {"phq9_total,gad7_total", "participant_id,visit_session,mood"}
    rows = bronze.read_csv(spark, f"{raw}/genomics").orderBy("_source").collect()
    assert [r["rsid"] for r in rows] == ["rs1", "rs2", "rs9"]


def test_inventory(spark, raw):
    files = list_files(spark, raw).select(F.lit("bronze").alias("tier"), F.col("path").alias("relative_path"))
    rows = tier_inventory(files).collect()
    assert len(rows) == 5 and rows[0]["total_files"] == files.count()


def test_registry_tables(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "sex", "demo", "['1=m']", 1), ("b", "x", None, "[]", 2)],
        "`original variable` string, standard_name string, modality string, levels string, n int",
    )
    tables.write_registry(df, str(tmp_path))
    listed, lookups = tables.read_registry(spark, str(tmp_path))
    assert {(r["original_variable"], r["modality"]) for r in listed.collect()} == {("a", "demo"), ("b", None)}
    assert [tuple(r) for r in lookups.collect()] == [("sex", "1", "m")]
    assert "PartitionFilters: [isnotnull" in listed.filter("modality = 'demo'")._jdf.queryExecution().executedPlan().toString()


def test_incremental_ingest_reads_each_file_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    checkpoint = str(tmp_path / "checkpoint")
    batch = spark.range(5)
    seen = []

    def transform(df):
        seen.append(df.count())
        return df.withColumn("twice", F.col("id") * 2)

    for _ in range(2):
        batch.coalesce(1).write.mode("append").parquet(source)
        ingest_new_files(spark, source, target, transform, schema=batch.schema, checkpoint=checkpoint)
    ingest_new_files(spark, source, target, transform, schema=batch.schema, checkpoint=checkpoint)
    assert seen == [5, 5]
    assert spark.read.parquet(target).count() == 10


def test_substring_status(spark):
    manifest = spark.createDataFrame(
        [("a/scan_1.csv", "scan_1.csv", "omics"), ("a/scan_9.csv", "scan_9.csv", "omics"), ("b/x.bin", "x.bin", None)],
        "relative_path string, filename string, plugin string",
    )
    names = spark.createDataFrame([("omics_scan_10",), ("omics_x",)], "name string")
    found = {r["filename"]: r["processed"] for r in status.mark_processed_by_name(manifest, names).collect()}
    assert found == {"scan_1.csv": True, "scan_9.csv": False, "x.bin": False}


def test_substring_status_of_many_names(spark):
    pick = random.Random(5)
    word = lambda low, high: "".join(pick.choices("abc_é", k=pick.randint(low, high)))
    stems = [word(1, 12) for _ in range(150)] + [""]
    rows = [(f"a/{s}.csv", f"{s}.csv", "omics" if i % 5 else None) for i, s in enumerate(stems)] + [("n", None, "omics")]
    names = [word(3, 40) for _ in range(60)] + ["", None]
    manifest = spark.createDataFrame(rows, "relative_path string, filename string, plugin string")
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    found = {(r["relative_path"], r["plugin"]): r["processed"] for r in status.mark_processed_by_name(manifest, listed).collect()}
    for path, filename, plugin in rows:
        of = None if filename is None else filename[: -len(".csv")] or ".csv"
        assert found[path, plugin] == (plugin is not None and of is not None and any(of in n for n in names if n)), path
    nothing = status.mark_processed_by_name(manifest, listed.limit(0))
    assert nothing.filter("processed").count() == 0 and nothing.count() == len(rows)
    assert status.mark_processed_by_name(manifest.limit(0), listed).collect() == []


def test_substrings_that_are_no_stems_become_no_rows(spark):
    names = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("name"))
    stems = spark.range(2000).select(F.concat(F.lit("x"), F.left(F.md5((-F.col("id") - 1).cast("string")), F.lit(20))).alias("_stem"))
    assert status.stem_hits(names, stems).count() < 500 * 12 * 0.15


def tasks_of_stages(spark, run):
    """The numbers of tasks of the stages that a function runs."""
    group = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return [info.numTasks for s in stages if (info := tracker.getStageInfo(s)) is not None]


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"sub-{i}").mkdir()
        (tmp_path / f"sub-{i}" / "a.csv").write_text("x\n1\n")
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    found = []
    tasks = tasks_of_stages(spark, lambda: found.append(list_files(spark, str(tmp_path))))
    assert found[0].count() == 100
    assert tasks and max(tasks) <= 32
    assert spark.conf.get(setting) == before


def test_types_of_many_small_documents_are_found_by_many_tasks(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i}.json").write_text(("﻿" if i == 1 else "") + json.dumps({"a": i, "b": None if i else {"c": 0.5}}, indent=1))
    found = []
    tasks = tasks_of_stages(spark, lambda: found.append(bronze.read_json(spark, str(tmp_path))))
    assert max(tasks) > 4
    assert found[0].drop("_source").schema.simpleString() == "struct<a:bigint,b:struct<c:double>>"
    assert found[0].agg(F.sum("a"), F.max("b.c")).first() == (4950, 0.5)


def test_raw_files_are_written_by_many_tasks(spark, tmp_path):
    from cohortweave.checks.tiers import put, put_text

    rows = spark.range(400).select(F.when(F.col("id") != 7, F.col("id").cast("string")).alias("k"), F.concat(F.lit("v"), "id").alias("value"))
    rows = rows.union(rows.filter("k = '3'"))
    for suffix, write in ((".rec", lambda: put_text(rows, F.col("k"), str(tmp_path / ".rec"), ".rec")),
                          (".json", lambda: put(rows, F.col("k"), str(tmp_path / ".json"), ["value"], ".json")),
                          (".csv", lambda: put(rows, F.col("k"), str(tmp_path / ".csv"), ["value"]))):
        assert max(n for n in tasks_of_stages(spark, write) if n != 8) > 2
        found = {p.parent.name: p.read_text() for p in (tmp_path / suffix).rglob(f"*{suffix}") if not p.name.startswith(".")}
        assert len(found) == 400
        one = {".rec": "v{}\n", ".json": '{{"value":"v{}"}}\n', ".csv": "v{}\n"}[suffix]
        head = "value\n" if suffix == ".csv" else ""
        assert found["_k=3"] == head + 2 * one.format(3) and found["_k=__HIVE_DEFAULT_PARTITION__"] == head + one.format(7)


def test_small_files_share_tasks_of_the_manifest(spark, tmp_path):
    for i in range(600):
        (tmp_path / f"sub-{i % 20}").mkdir(exist_ok=True)
        (tmp_path / f"sub-{i % 20}" / f"{i} a.{'json' if i % 3 == 0 else 'csv'}").write_text('{"device_brand": "x"}' if i % 2 else "[1]")
    found = []
    tasks = tasks_of_stages(spark, lambda: found.append(ingest(spark, str(tmp_path), str(tmp_path / "silver"), spark.createDataFrame(
        [("a", "b", None)], "original_variable_name string, standard_name string, loinc_code string"), dry_run=True).manifest))
    assert max(tasks) <= 16  # as many for Spark's own weight of a file
    assert len(found[0].inputFiles()) <= 16
    kinds = {r["filename"]: r["json_kind"] for r in build_manifest_kinds(spark, str(tmp_path)).collect()}
    assert len(kinds) == 600 and all(k == (None if n.endswith("csv") else "wearable" if int(n.split()[0]) % 2 else "invalid") for n, k in kinds.items())


def build_manifest_kinds(spark, root):
    return list_bronze(spark, root).select(F.substring_index("path", "/", -1).alias("filename"), "json_kind")


def test_a_plugin_reads_each_file_once(spark, tmp_path):
    from cohortweave.operators.modalities import register, unregister
    from cohortweave.sources import per_file

    calls = str(tmp_path / "calls")

    def records(file):
        with open(calls, "a") as log:
            log.write("x\n")
        text = file.read().decode()
        yield (text,)
        if text == "3":
            raise ValueError("three")

    (tmp_path / "bronze" / "ledgers").mkdir(parents=True)
    for i in range(25):
        (tmp_path / "bronze" / "ledgers" / f"sub-{i}.rec").write_text(str(i))
    registry = spark.createDataFrame([("a", "b", None)], "original_variable_name string, standard_name string, loinc_code string")
    register("ledger", lambda df: df.withColumn("modality_category", F.lit("ledger")), reader=per_file.reader("name string", records), markers=(), suffix=".rec")
    try:
        report = ingest(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), registry)
        rows = read_silver(spark, str(tmp_path / "silver"), ["ledger"])
    finally:
        unregister("ledger")
    assert sorted(int(r["nonstandard_name"]) for r in rows.collect()) == list(range(25))
    assert {r["relative_path"]: r["message"] for r in report.outcomes.filter("outcome = 'partly'").collect()} == {"ledgers/sub-3.rec": "ValueError: three"}
    with open(calls) as log:
        assert len(log.read().split()) == 25


def test_kinds_of_text_are_found_once_per_value(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("1", "x", 2, "m"), (" 2 ", "true", 3, "m"), ("0.5", None, 4, "m")], "a string, b string, n int, modality_category string")
    counted, observe = [], type(rows).observe
    monkeypatch.setattr(type(rows), "observe", lambda self, seen, *exprs: counted.extend(map(str, exprs)) or observe(self, seen, *exprs))
    tables.write_silver(rows, str(tmp_path), open_text=["a", "b"])
    assert len(counted) == 9 and not any("rlike" in e.lower() for e in counted)
    found = {r["name"]: (r["integers"], r["fractions"], r["truths"], r["others"]) for r in spark.read.json(f"{tmp_path}/_types/*").collect()}
    assert found == {"a": (2, 1, 0, 0), "b": (0, 0, 1, 1), "n": (3, 0, 0, 0)}
    assert sorted(tables.read_silver(spark, str(tmp_path)).columns) == ["a", "b", "modality_category", "n"]
