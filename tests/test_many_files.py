"""Files beyond what Spark's readers are given: the same rows, by tasks."""

import json

import pytest
from pyspark.sql import functions as F

from cohortweave.plans import ingest as plans
from cohortweave.sources import bronze, many_files
from cohortweave.sources.manifest import discover, list_bronze, list_files

DOCUMENTS = {
    "a/sub 1+x%/d.json": b'{"a":1}\n{"a":2}\n', "a/b/empty.json": b"", "a/b/f.json": b'\r\n\n{"a":3}\r{"b":1}', "a/b/bom.json": b'\xef\xbb\xbf{"a":1}',
    "a/_x/y.json": b"{}", "a/_k=1/y.json": b'{"a":7}', "a/.h/y.json": b"{}", "a/_q.json": b"{}", "a/b/c.json._COPYING_": b"{}", "a/b/_metadata": b"1",
    "a/b/bytes.json": b'{"a":"\xff\xfe"}', "a/b/blank.json": b" \n ", "a/b/rest.json": b'{"a":1} x', "a/b/null.json": b"null",
    "a/b/deep.json": b'{"a":{"c":1}}', "a/b/cut.json": b'{"a": [1', "a/n.csv": b"x\n1\n",
}


@pytest.fixture
def odd(tmp_path):
    for name, data in DOCUMENTS.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    (tmp_path / "a" / "link.json").symlink_to(tmp_path / "a" / "b" / "f.json")
    (tmp_path / "a" / "gone.json").symlink_to("/nowhere")
    (tmp_path / "a" / "folder").symlink_to(tmp_path / "a" / "_k=1")
    (tmp_path / "none").mkdir()
    return str(tmp_path)


def test_tasks_list_what_spark_lists(spark, odd, monkeypatch):
    def found():
        return (sorted(list_files(spark, odd).collect()), sorted(map(str, list_bronze(spark, odd).collect())),
                sorted(map(str, list_bronze(spark, f"file://{odd}/", "sub-unknown").collect())), sorted(map(str, list_bronze(spark, odd, "sub 1").collect())))

    few = found()
    monkeypatch.setattr(many_files, "has_many", lambda root: True)
    monkeypatch.setattr(many_files, "FILES_PER_BATCH", 2)
    assert found() == few and len(few[0]) == 13
    assert not any("binaryfile" in s or "FileScan text" in s for s in [list_bronze(spark, odd)._jdf.queryExecution().executedPlan().toString().lower()])


def test_number_of_files_is_bounded(spark, odd):
    root = many_files.qualified(spark, odd)
    assert many_files.has_many(root, 5) and not many_files.has_many(root, 50) and not many_files.has_many("file:/nowhere", 0)


@pytest.mark.parametrize("schema", ["a string, _corrupt_record string", None])
def test_tasks_parse_what_spark_parses(spark, odd, schema):
    paths = [r["path"] for r in list_files(spark, odd).filter("path LIKE '%.json'").collect()]
    files = spark.createDataFrame([(p,) for p in [*paths, paths[0]]], "path string")
    of_spark = bronze.read_json(spark, [*paths, paths[0]], schema)
    of_tasks = bronze.parse_documents(many_files.contents(files), schema)
    assert of_tasks.columns == of_spark.columns
    rows = [sorted(str((*tuple(r)[:-1], r["_source"]["file"], r["_source"]["block"])) for r in df.collect()) for df in (of_spark, of_tasks)]
    assert rows[0] == rows[1] and len(rows[0]) == 12


def test_documents_of_many_files_are_not_described_in_the_driver(spark, tmp_path):
    (tmp_path / "bronze" / "wearables").mkdir(parents=True)
    (tmp_path / "bronze" / "ehr").mkdir()
    for i in range(6):
        (tmp_path / "bronze" / "wearables" / f"sub-{i}.json").write_text(json.dumps({"device_brand": "x", "heart_rate_array": [i, 2.5]}))
        entry = {"resource": {"resourceType": "Observation", "code": {"text": f"v{i}"}}} if i else "none"
        (tmp_path / "bronze" / "ehr" / f"sub-{i}.json").write_text(json.dumps({"resourceType": "Bundle", "entry": [entry]}, indent=None))
    registry = spark.createDataFrame([("a", "b", None)], "original_variable_name string, standard_name string, loinc_code string")
    manifest = discover(spark, str(tmp_path / "bronze"))
    for plugin in ("wearables", "ehr"):
        few, many = (plans.harmonize_files(spark, plugin, plans.plan_scans(manifest, plugin, files_per_read=n), registry) for n in (20_000, 5))
        for one, other in zip(few, many):
            names = [n for n in one.columns if n != "_source"]
            assert sorted(map(str, one.select(*[F.col(f"`{n}`") for n in names]).collect())) == sorted(map(str, other.select(*[F.col(f"`{n}`") for n in names]).collect()))
        assert any(p.endswith(".json") for p in few[0].inputFiles()) and not any(p.endswith(".json") for p in many[0].inputFiles())
    # Scans of few files each count together.
    assert plans.all_scans(manifest, 11)["ehr"][0].documents() is not None and plans.all_scans(manifest, 12)["ehr"][0].documents() is None


def test_outcomes_gather_no_files_in_the_driver(spark, tmp_path):
    listed = spark.createDataFrame([("p", "r", "file:/r", "")], "plugin string, relative_path string, path string, message string")
    spark.range(1).select(F.lit("p").alias("_plugin"), F.struct(F.lit("/r").alias("file")).alias("_source")).write.parquet(str(tmp_path / "w"))
    bad = spark.createDataFrame([("/r", "x", "p")], "file string, record string, plugin string")
    found = plans._outcomes(listed, spark.read.parquet(str(tmp_path / "w")), bad, {})
    assert [tuple(r)[2:5] for r in found.collect()] == [("partly", 1, 1)]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
