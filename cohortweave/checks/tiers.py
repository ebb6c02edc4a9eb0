"""Whole ingests: the given tables written as raw files of many subjects, ingested and read back."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.checks import query, table
from cohortweave.constants import MODALITY
from cohortweave.functions.names import c
from cohortweave.operators.modalities import register, unregister
from cohortweave.plans.ingest import ingest, read_silver
from cohortweave.sources import per_file
from cohortweave.sources.layouts import created, is_reachable
from cohortweave.sources.workspace import new_folder
from cohortweave.streaming.incremental import ingest_arriving, ingest_listed

REGISTRY_DDL = "original_variable_name string, standard_name string, loinc_code string"


def small_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("score", "Score", None), ("price", "price", None)], REGISTRY_DDL)


def subject(number: Column) -> Column:
    return F.concat(F.lit("sub-"), number)


# Folders that one task writes; each is a file that is opened, closed and moved.
FOLDERS_PER_TASK = 100
# Files that one task writes by itself at most, where there are more than four tasks per core.
FILES_PER_TASK = 1_000
# The folder of rows without a key, as Spark's writers name it.
NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def spread(df: DataFrame, key: str, most: int = FOLDERS_PER_TASK) -> DataFrame:
    """Rows of one key together, in a number of tasks that follows the number of keys: adaptive execution sees only bytes.

    More than four tasks per core take up to `most` keys each.
    """
    keys = df.agg(F.approx_count_distinct(key)).first()[0]
    enough = max(-(-keys // most), 4 * df.sparkSession.sparkContext.defaultParallelism)
    tasks = min(-(-keys // FOLDERS_PER_TASK), enough)
    return df.repartition(tasks, key) if tasks > 1 else df.repartition(key)


def put(df: DataFrame, by: Column, folder: str, columns: Sequence[Column | str], suffix: str = ".csv") -> None:
    """Columns as raw files, a folder per value of `by`; documents are one per row, so `by` tells rows apart there."""
    keyed = df.select(*columns, by.alias("_k"))
    if suffix == ".json":
        put_text(keyed.select(F.to_json(F.struct(*[c(n) for n in keyed.columns[:-1]])).alias("value"), "_k"), c("_k"), folder, suffix)
        return
    rows = spread(keyed, "_k").write.partitionBy("_k").mode("append")
    if suffix == ".csv":
        rows.option("header", True).option("escape", '"').csv(folder)
    else:
        rows.parquet(folder)


def put_text(df: DataFrame, by: Column, folder: str, suffix: str) -> None:
    """One file per value of `by` with its `value`s as lines, under a suffix of any format. Tasks write their share of the files."""
    keyed = df.select("value", by.cast("string").alias("_k"))
    if not is_reachable(folder):
        spread(keyed, "_k").write.partitionBy("_k").text(folder)
        rename(df.sparkSession, folder, suffix)
        return
    lines = keyed.groupBy(F.coalesce("_k", F.lit(NO_KEY)).alias("_k")).agg(F.collect_list(F.coalesce("value", F.lit(""))).alias("lines"))
    spread(lines, "_k", FILES_PER_TASK).mapInArrow(_file_writer(folder, suffix), "files bigint").agg(F.sum("files")).collect()


def _file_writer(folder: str, suffix: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, lines in zip(batch.column("_k").to_pylist(), batch.column("lines").to_pylist()):
                # A task that is repeated replaces its files.
                with created(f"{folder}/_k={key}/part-0{suffix}") as file:
                    file.write("".join(f"{line}\n" for line in lines).encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    return write


def rename(spark: SparkSession, folder: str, suffix: str) -> None:
    """Text files under another suffix, to have files of formats that Spark does not write."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(folder)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.listFiles(top, True)
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().endswith(".txt"):
            store.rename(path, jvm.org.apache.hadoop.fs.Path(path.getParent(), path.getName()[:-4] + suffix))


def two_layouts(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Surveys of two layouts: whole scores in one, fractions and one more column in the other."""
    orders = table(spark, sf_dir, "orders").withColumn("participant_id", subject(c("o_custkey")))
    session = F.concat(F.lit("ses-"), c("o_orderkey")).alias("visit_session")
    key = c("o_orderkey")
    whole = ["participant_id", session, (key % 10).alias("score"), F.lit(7).alias("level")]
    put(orders.filter(key % 2 == 0), subject((key / 2).cast("int") % 8), f"{root}/assessments/a", whole)
    level = F.when(key % 3 == 0, "high").otherwise("7").alias("level")
    parts = [session, c("o_orderpriority").alias("mood"), "participant_id", (key % 100 / 8).alias("score"), level]
    put(orders.filter(key % 2 == 1), subject(key % 8), f"{root}/assessments/b", parts)


TWO_LAYOUTS_SQL = """
    SELECT 'sub-' || o_custkey AS participant_id, 'ses-' || o_orderkey AS visit_session, 'clinical_survey_general' AS modality_category,
           CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 10)::DOUBLE ELSE (o_orderkey % 100)::DOUBLE / 8 END AS "Score",
           CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0 THEN '7' ELSE 'high' END AS nonstandard_level,
           CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS nonstandard_mood
    FROM orders
"""
_TWO = ["participant_id", "visit_session", MODALITY, "Score", "nonstandard_level", "nonstandard_mood"]


@query(TWO_LAYOUTS_SQL)
def silver_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers and fractions of one column meet as fractions; numbers and words as text."""
    root, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    two_layouts(spark, sf_dir, root)
    ingest(spark, root, silver, small_registry(spark))
    return read_silver(spark, silver).select(*_TWO)


@query(f"""WITH silver AS ({TWO_LAYOUTS_SQL})
    SELECT participant_id, visit_session, "Score" FROM silver WHERE "Score" > 5 AND nonstandard_level = '7'
""")
def silver_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions with whole numbers on a column of mixed layouts, and on one that stayed text."""
    from cohortweave.operators.select import matching

    root, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    two_layouts(spark, sf_dir, root)
    ingest(spark, root, silver, small_registry(spark))
    found = matching(read_silver(spark, silver), {"Score": (">", 5), "nonstandard_level": ("==", 7)})
    return found.select("participant_id", "visit_session", "Score")


@query("""
    SELECT 'sub-' || n_regionkey AS participant_id, o_orderkey AS nonstandard_order,
           CASE WHEN n_regionkey = 0 THEN (o_orderkey % 10)::DOUBLE ELSE o_orderkey % 10 + 0.5::DOUBLE END AS "Score"
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey IN (0, 1)
""")
def silver_after_two_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subjects ingested one after the other, the first with whole scores, the second with fractions."""
    root, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    regions = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
    orders = table(spark, sf_dir, "orders").join(regions, c("o_custkey") == c("c_custkey")).withColumn("participant_id", subject(c("n_regionkey")))
    whole, part = orders.filter("n_regionkey = 0"), orders.filter("n_regionkey = 1")
    for i, (rows, score) in enumerate(((whole, c("o_orderkey") % 10), (part, c("o_orderkey") % 10 + 0.5))):
        put(rows, c("participant_id"), f"{root}/assessments/{i}", ["participant_id", c("o_orderkey").alias("order"), score.alias("score")])
    for one in ("sub-0", "sub-1"):
        ingest(spark, root, silver, small_registry(spark), subject=one)
    return read_silver(spark, silver).select("participant_id", "nonstandard_order", "Score")


def many_kinds(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Raw files of every format."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    p, s = c("p_partkey"), c("s_suppkey")
    variant = [subject(p % 50).alias("participant_id"), F.concat(F.lit("rs"), p).alias("rsid"), F.when(p % 5 > 0, c("p_brand")).alias("genotype")]
    put(part, subject(p % 4), f"{root}/genomics/g", variant)
    # The marker is null in every third row: such a row is of the kind of its file all the same.
    protein = [subject(s % 50).alias("participant_id"), F.when(s % 3 > 0, c("s_name")).alias("protein_id"), c("s_acctbal").alias("abundance")]
    put(supplier, subject(s % 4), f"{root}/proteomics/p", protein, ".parquet")
    metabolite = [subject(p % 50).alias("participant_id"), F.when(p % 3 > 0, c("p_name")).alias("metabolite_name"), c("p_size").alias("abundance")]
    put(part, subject(p % 4), f"{root}/proteomics/m", metabolite, ".parquet")
    pulse = F.array(s.cast("double"), F.lit(3.0)).alias("heart_rate_array")
    worn = [F.concat(F.lit("brand "), c("s_nationkey")).alias("device_brand"), subject(s).alias("participant_id"), pulse]
    put(supplier, s, f"{root}/wearables/w", worn, ".json")
    resource = F.struct(
        F.lit("Observation").alias("resourceType"), F.struct(c("s_name").alias("text")).alias("code"),
        F.struct(c("s_acctbal").alias("value"), F.lit("mg").alias("unit")).alias("valueQuantity"),
    )
    bundle = [F.lit("Bundle").alias("resourceType"), F.array(F.struct(resource.alias("resource"))).alias("entry")]
    put(supplier, subject(s), f"{root}/ehr/b", bundle, ".json")


MANY_KINDS_SQL = """
    SELECT 'genomics' AS modality_category, p_partkey % 50 AS s, CASE WHEN p_partkey % 5 > 0 THEN 1 ELSE 0 END AS v, 0::DOUBLE AS x FROM part
    UNION ALL SELECT 'proteomics', s_suppkey % 50, CASE WHEN s_suppkey % 3 > 0 THEN 1 ELSE 0 END, s_acctbal FROM supplier
    UNION ALL SELECT 'metabolomics', p_partkey % 50, CASE WHEN p_partkey % 3 > 0 THEN 1 ELSE 0 END, p_size FROM part
    UNION ALL SELECT 'digital_biomarker_wearable', s_suppkey, 1, (s_suppkey + 3) / 2::DOUBLE FROM supplier
"""


@query(f"""WITH silver AS ({MANY_KINDS_SQL})
    SELECT modality_category, 'sub-' || s AS participant_id, count(*) AS rows, sum(v)::BIGINT AS marked, round(sum(x), 4) AS total
    FROM silver GROUP BY modality_category, s
""")
def ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every format at once; rows are of the kind that their file's columns say."""
    root, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    many_kinds(spark, sf_dir, root)
    ingest(spark, root, silver, small_registry(spark))
    rows = read_silver(spark, silver, ["omics", "wearables"])
    marked = F.coalesce(
        F.when(c(MODALITY) == "genomics", c("nonstandard_genotype").isNotNull()), F.when(c(MODALITY) == "proteomics", c("nonstandard_protein_id").isNotNull()),
        F.when(c(MODALITY) == "metabolomics", c("nonstandard_metabolite_name").isNotNull()), F.lit(True),
    )
    value = F.coalesce(c("nonstandard_abundance"), c("nonstandard_mean_hr"), F.lit(0.0))
    return rows.groupBy(MODALITY, "participant_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(marked).alias("marked"), F.round(F.sum(value), 4).alias("total")
    )


@query("""
    WITH files AS (
        SELECT s_suppkey AS k, s_suppkey % 5 AS kind FROM supplier),
    named AS (
        SELECT k, kind, CASE kind WHEN 0 THEN 'assessments' WHEN 1 THEN 'proteomics' WHEN 2 THEN 'ehr' WHEN 3 THEN 'genomics' ELSE 'imaging' END AS folder
        FROM files)
    SELECT 'sub-' || k AS subject_id, folder,
           CASE kind WHEN 0 THEN 'partly' WHEN 4 THEN 'skipped' WHEN 3 THEN 'processed' ELSE 'failed' END AS outcome,
           CASE kind WHEN 0 THEN 2 WHEN 3 THEN 1 ELSE 0 END::BIGINT AS rows, CASE WHEN kind < 3 THEN 1 ELSE 0 END::BIGINT AS bad_records,
           kind IN (0, 1, 2, 4) AS explained
    FROM named
""")
def ingest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per supplier: a CSV with a record too long, a broken Parquet file, a bundle of another form, a good file, an image."""
    root, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    files = table(spark, sf_dir, "supplier").withColumn("sub", subject(c("s_suppkey")))
    of = [files.filter(c("s_suppkey") % 5 == kind) for kind in range(5)]
    lines = F.array(F.lit("score,price"), F.lit("1,2"), F.lit("3,4,5"), F.lit("6,7"))
    put_text(of[0].select(F.array_join(lines, "\n").alias("value"), "sub"), c("sub"), f"{root}/assessments/a", ".csv")
    put_text(of[1].select(F.lit("PAR1 is not all").alias("value"), "sub"), c("sub"), f"{root}/proteomics/p", ".parquet")
    put(of[2], c("sub"), f"{root}/ehr/e", [F.lit("Bundle").alias("resourceType"), F.lit("none").alias("entry")], ".json")
    put(of[3], c("sub"), f"{root}/genomics/g", [F.lit("x").alias("rsid")])
    put_text(of[4].select(F.lit("image").alias("value"), "sub"), c("sub"), f"{root}/imaging/i", ".nii.gz")
    report = ingest(spark, root, silver, small_registry(spark))
    folder = F.substring_index("relative_path", "/", 1)
    return report.outcomes.select(
        F.regexp_extract("relative_path", "(sub-[0-9]+)", 1).alias("subject_id"), folder.alias("folder"), "outcome", "rows", "bad_records",
        (c("message") != "").alias("explained"),
    )


def _records(file: BinaryIO) -> Iterator[tuple]:
    """`key: value` lines; a blank line ends a record."""
    held: dict[str, str] = {}
    for line in [*file.read().decode().split("\n"), ""]:
        key, _, value = line.partition(": ")
        if value:
            held[key] = value
        elif held:
            if "name" not in held:
                raise ValueError("a record without name")
            yield held.get("participant"), held["name"], float(held["balance"]) if "balance" in held else None
            held = {}


per_file.by_value(__name__)


@query("""
    SELECT 'sub-' || c_custkey AS participant_id, 'ledger' AS modality_category, c_name AS nonstandard_name, c_acctbal AS nonstandard_balance
    FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT 'broken', CASE WHEN bool_or(c_custkey % 7 = 0) THEN 'failed' END, NULL, count(*)::DOUBLE FROM customer WHERE c_custkey % 7 = 0
""")
def plugin_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plugin with a format of its own: it brings the reader, the tag and the suffix of its files. Some files are broken."""
    root, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    who = table(spark, sf_dir, "customer").withColumn("sub", subject(c("c_custkey")))
    fields = [F.concat(F.lit("participant: "), c("sub")), F.concat(F.lit("name: "), c("c_name")), F.concat(F.lit("balance: "), c("c_acctbal")), F.lit("")]
    good = who.filter("c_custkey % 7 <> 0").groupBy((c("c_custkey") % 50).alias("sub")).agg(F.array_join(F.collect_list(F.array_join(F.array(*fields), "\n")), "\n").alias("value"))
    put_text(good, F.concat(F.lit("sub-"), c("sub")), f"{root}/ledgers/l", ".rec")
    put_text(who.filter("c_custkey % 7 = 0").select(F.concat(F.lit("participant: "), c("sub")).alias("value"), "sub"), c("sub"), f"{root}/ledgers/x", ".rec")
    read = per_file.reader("participant_id string, name string, balance double", _records)
    register("ledger", lambda df: df.withColumn(MODALITY, F.lit("ledger")), reader=read, markers=(), suffix=".rec")
    try:
        report = ingest(spark, root, silver, small_registry(spark))
        rows = read_silver(spark, silver, ["ledger"]).select("participant_id", MODALITY, "nonstandard_name", "nonstandard_balance")
    finally:
        unregister("ledger")
    broken = report.outcomes.filter("outcome = 'failed'").agg(
        F.lit("broken").alias("participant_id"), F.max("outcome").alias(MODALITY), F.lit(None).cast("string").alias("nonstandard_name"),
        F.count(F.lit(1)).cast("double").alias("nonstandard_balance"),
    )
    return rows.unionByName(broken)


@query(TWO_LAYOUTS_SQL)
def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive in two steps, harmonized by two runs of the stream; one batch is repeated as after a failure."""
    root, silver, checkpoint = (new_folder(spark, n) for n in ("bronze", "silver", "checkpoint"))
    orders, half = table(spark, sf_dir, "orders"), new_folder(spark, "half")
    for step in (0, 1):
        orders.filter(c("o_orderkey") % 4 < 2 if step == 0 else c("o_orderkey") % 4 >= 2).write.parquet(f"{half}/{step}/orders.parquet")
        two_layouts(spark, f"{half}/{step}", root)
        ingest_arriving(spark, root, silver, small_registry(spark), checkpoint=checkpoint, max_files_per_batch=12)
    first = spark.read.parquet(f"{silver}/assessments").filter("_batch LIKE 'stream-0-%'").select("_source.file").distinct()
    ingest_listed(spark, [r["file"] for r in first.collect()], root, silver, small_registry(spark), batch="stream-0")
    return read_silver(spark, silver).select(*_TWO)
