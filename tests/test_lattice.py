"""Column types as counts, headers without whole reads, and conditions on columns of mixed types."""

import numpy as np
import pandas as pd
import pytest

from cohortweave.operators import lattice
from cohortweave.operators.select import matching
from cohortweave.plans.ingest import harmonize_files, ingest, plan_scans, read_silver
from cohortweave.sources import layouts, tables
from cohortweave.sources.manifest import discover
from cohortweave.streaming.incremental import ingest_listed


@pytest.mark.parametrize("counts, kind", [
    ((0, 0, 0, 0), None), ((3, 0, 0, 0), "bigint"), ((3, 1, 0, 0), "double"), ((0, 2, 0, 0), "double"), ((0, 0, 2, 0), "boolean"),
    ((1, 0, 1, 0), None), ((1, 1, 0, 1), None), ((0, 0, 0, 5), None),
])
def test_agreed(counts, kind):
    assert lattice.agreed(*counts) == kind


def test_types_do_not_depend_on_the_cut(spark, tmp_path):
    """Any split of the values into batches gives the type of all of them."""
    rng = np.random.default_rng(2)
    values = {"i": ["1", " -7 ", None, "+12"], "d": ["1", "2.5", "1e3", ".5"], "b": ["True", "false", None, "TRUE"], "t": ["1", "x", "True", ""],
              "big": ["123456789012345678901", "1", "2", "3"], "none": [None] * 4}
    rows = [("m", *[values[k][i] for k in values]) for i in range(4)]
    schema = "modality_category string, " + ", ".join(f"{k} string" for k in values)
    for trial in range(3):
        path = str(tmp_path / str(trial))
        for part in np.array_split(rng.permutation(4), trial + 1):
            tables.write_silver(spark.createDataFrame([rows[i] for i in part], schema), path, open_text=list(values))
        found = dict(tables.read_silver(spark, path).dtypes)
        assert found == {"i": "bigint", "d": "double", "b": "boolean", "t": "string", "big": "double", "none": "string", "modality_category": "string"}


def test_text_of_typed_files_stays_text(spark, tmp_path):
    df = spark.createDataFrame([("m", "10", 3)], "modality_category string, code string, n int")
    tables.write_silver(df, str(tmp_path / "a"), batch="one")
    tables.write_silver(df, str(tmp_path / "a"), batch="one")
    back = tables.read_silver(spark, str(tmp_path / "a"))
    assert back.count() == 1 and dict(back.dtypes)["code"] == "string" and dict(back.dtypes)["n"] == "bigint"


def test_first_record_reads_one_chunk(tmp_path, monkeypatch):
    monkeypatch.setattr(layouts, "CHUNK", 64)
    read = []
    real = layouts.opened

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read(self, n):
            read.append(n)
            return self.file.read(n)

    monkeypatch.setattr(layouts, "opened", lambda path: Counted(real(path)))
    for rows in (1, 100_000):
        (tmp_path / "x.csv").write_text("﻿a,b\n" + "1,2\n" * rows)
        read.clear()
        assert layouts.csv_names(str(tmp_path / "x.csv")) == ["a", "b"] and sum(read) == 64
    (tmp_path / "y.csv").write_text('\n"a\nb","say ""hi""",,c,C\r\n1,2,3,4,5\n')
    assert layouts.csv_names(str(tmp_path / "y.csv")) == ["a\nb", 'say "hi"', "_c2", "c3", "C4"]
    (tmp_path / "z.csv").write_text("")
    with pytest.raises(ValueError):
        layouts.csv_names(str(tmp_path / "z.csv"))


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([("who", "participant_id", None)], "original_variable_name string, standard_name string, loinc_code string")


def test_files_of_many_layouts_in_one_scan(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "assessments"
    root.mkdir(parents=True)
    (root / "sub-01_a.csv").write_text("who,x,y\nsub-07,1,2\n,3,4\n")
    (root / "sub-02_b.csv").write_text("y,x\n5,n/a\n")
    (root / "sub-03_c.csv").write_text("z\n9\n8,8\n")
    (root / "sub-04_d.csv").write_text("\n")  # files without a byte are not listed
    (root / "sub-05_e.csv").write_text("x,y\n")
    report = ingest(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), registry)
    rows = {(r["participant_id"], r["nonstandard_x"], r["nonstandard_y"], r["nonstandard_z"]) for r in read_silver(spark, str(tmp_path / "silver")).collect()}
    assert rows == {("sub-07", 1, 2, None), (None, 3, 4, None), ("sub-02", None, 5, None), ("sub-03", None, None, 9)}
    outcomes = {r["relative_path"][-5]: (r["outcome"], r["rows"], r["bad_records"]) for r in report.outcomes.collect()}
    assert outcomes == {"a": ("processed", 2, 0), "b": ("processed", 1, 0), "c": ("partly", 1, 1), "d": ("failed", 0, 1), "e": ("empty", 0, 0)}


def test_parquet_files_of_different_types_and_kinds(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "genomics"
    root.mkdir(parents=True)
    pd.DataFrame({"rsid": ["r1", None], "n": [1, 2]}).to_parquet(root / "sub-01.parquet")
    pd.DataFrame({"protein_id": [None, "p"], "n": [0.5, 2.0]}).to_parquet(root / "sub-02.parquet")
    pd.DataFrame({"rsid": ["r2"], "n": [2.5]}).to_parquet(root / "sub-03.parquet")
    (root / "sub-04.parquet").write_text("not one")
    report = ingest(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), registry)
    rows = sorted((r["participant_id"], r["modality_category"], r["nonstandard_n"]) for r in report.silver["omics"].collect())
    assert rows == [("sub-01", "genomics", 1.0), ("sub-01", "genomics", 2.0), ("sub-02", "proteomics", 0.5), ("sub-02", "proteomics", 2.0), ("sub-03", "genomics", 2.5)]
    bad = report.outcomes.filter("outcome = 'failed'").collect()
    assert len(bad) == 1 and bad[0]["message"] and bad[0]["relative_path"].endswith("sub-04.parquet")


def test_conditions_on_text(spark):
    df = spark.createDataFrame([("a", "7"), ("b", "x"), ("c", None), ("d", "4.5")], "participant_id string, v string")
    assert [r[0] for r in matching(df, {"v": (">", 5)}).collect()] == ["a"]
    assert [r[0] for r in matching(df, {"v": ("<", 5)}).collect()] == ["d"]
    assert [r[0] for r in matching(df, {"v": ("==", "x")}).collect()] == ["b"]


def test_a_subject_opens_its_own_documents_alone(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"sub-0{n}").mkdir()
        (tmp_path / f"sub-0{n}" / "x.json").write_text('{"device_brand": "x"}')
    found = discover(spark, str(tmp_path), "sub-03", in_order=True)
    assert [r["subject_id"] for r in found.collect()] == ["sub-03"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan.split("FileScan text")[1].split("\n")[0]


def test_a_repeated_batch_replaces_itself(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "assessments"
    root.mkdir(parents=True)
    (root / "sub-01_a.csv").write_text("x\n1\n2,2\n")
    paths = [f"file:{root}/sub-01_a.csv"]
    for _ in range(2):
        report = ingest_listed(spark, paths, str(tmp_path / "bronze"), str(tmp_path / "silver"), registry, batch="b")
        assert report.errors == {}
    assert read_silver(spark, str(tmp_path / "silver")).count() == 1
    assert report.bad_records.count() == 1 and report.outcomes.count() == 1


def test_any_number_of_files_per_read(spark, registry, tmp_path):
    root = tmp_path / "bronze" / "assessments"
    root.mkdir(parents=True)
    for i in range(6):
        (root / f"sub-0{i}.csv").write_text(f"x{i % 2},v\n{i},{i if i < 3 else i + 0.5}\n")
    manifest = discover(spark, str(tmp_path / "bronze")).filter("subject_id <> 'sub-05'")
    found = []
    for n in (1, 20_000):
        df, _ = harmonize_files(spark, "assessments", plan_scans(manifest, "assessments", files_per_read=n), registry)
        found.append((df.dtypes, sorted(map(str, df.drop("_source").collect()))))
    assert found[0] == found[1] and ("nonstandard_v", "double") in found[0][0] and len(found[0][1]) == 5
