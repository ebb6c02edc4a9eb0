"""Files: manifest and routing, raw scans, sinks and incremental ingest.

Queries that need files first write the given tables into the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.checks import query, table
from cohortweave.checks.cohort import activity, purchases
from cohortweave.checks.registry import REGISTRY_SQL, derived_registry
from cohortweave.constants import SOURCE
from cohortweave.functions import paths
from cohortweave.functions.names import c
from cohortweave.operators import status
from cohortweave.operators.modalities import wearables
from cohortweave.sources import bronze, tables
from cohortweave.sources.manifest import build_manifest, json_kind
from cohortweave.sources.manifest import tier_inventory as inventory
from cohortweave.sources.workspace import new_folder
from cohortweave.streaming.incremental import ingest_new_files

DIRECTORIES = (
    "genomics", "proteomics", "metabolomics", "assessments", "biospecimens", "ehr_notes", "wearables", "ehr",
    "pharmacy", "demographics", "imaging",
)
SUFFIXES = (".csv", ".json", ".parquet", ".nii.gz", ".CSV", "")
DOCUMENTS = (
    '{"resourceType": "Bundle", "entry": []}', '{"device_brand": "x"}', '{"resourceType": "Patient"}', '[1, 2]', "{broken",
)


def _pick(values: tuple[str, ...], index: str):
    return F.get(F.array(*map(F.lit, values)), F.expr(index).cast("int"))


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a raw folder; every fourth path names no subject."""
    suffix = _pick(SUFFIXES, f"doc_id % {len(SUFFIXES)}")
    name = F.when(c("doc_id") % 4 == 0, F.concat(F.lit("scan_"), c("doc_id"))).otherwise(
        F.concat(F.lit("sub-"), c("source"), F.lit("_ses-"), c("lang"), F.lit("_"), c("doc_id"))
    )
    path = F.concat(
        F.lit("file:/data/bronze/"), _pick(DIRECTORIES, f"doc_id % {len(DIRECTORIES)}"), F.lit("/"), name, suffix
    )
    document = _pick(DOCUMENTS, f"doc_id div 7 % {len(DOCUMENTS)}")
    return table(spark, sf_dir, "documents").select(
        path.alias("path"), F.when(suffix == ".json", json_kind(document)).alias("json_kind"), "doc_id"
    )


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


MANIFEST_SQL = f"""
    WITH named AS (
        SELECT doc_id, {_list(DIRECTORIES)}[doc_id % {len(DIRECTORIES)} + 1] AS modality_dir,
               {_list(SUFFIXES)}[doc_id % {len(SUFFIXES)} + 1] AS extension,
               CASE WHEN doc_id % 4 = 0 THEN 'scan_' || doc_id ELSE 'sub-' || source || '_ses-' || lang || '_' || doc_id END AS stem,
               CASE WHEN doc_id % 4 = 0 THEN 'sub-unknown' ELSE 'sub-' || source END AS subject_id,
               CASE WHEN doc_id % 4 <> 0 THEN 'ses-' || lang END AS session_id,
               {_list(("bundle", "wearable", "other", "invalid", "invalid"))}[doc_id // 7 % {len(DOCUMENTS)} + 1] AS kind
        FROM documents),
    hinted AS (
        SELECT *, CASE WHEN modality_dir IN ('genomics', 'proteomics', 'metabolomics') THEN 'omics'
                       WHEN modality_dir IN ('assessments', 'biospecimens', 'wearables') THEN modality_dir
                       WHEN modality_dir = 'ehr_notes' THEN 'nlp' END AS hint
        FROM named),
    manifest AS (
        SELECT doc_id, 'file:/data/bronze/' || modality_dir || '/' || stem || extension AS path, subject_id, session_id,
               modality_dir, stem || extension AS filename, modality_dir || '/' || stem || extension AS relative_path,
               extension,
               CASE extension WHEN '.csv' THEN hint WHEN '.parquet' THEN 'omics' WHEN '.json' THEN
                    CASE kind WHEN 'bundle' THEN 'ehr' WHEN 'wearable' THEN 'wearables' WHEN 'other' THEN hint END
               END AS plugin, stem
        FROM hinted)
"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_manifest(file_rows(spark, sf_dir), "/data/bronze")


@query(MANIFEST_SQL + """
    SELECT path, subject_id, session_id, modality_dir, filename, relative_path, extension, plugin,
           CASE WHEN plugin IS NULL THEN 'skipped' ELSE 'pending' END AS status,
           CASE WHEN plugin IS NULL THEN 'No plugin mapped for ' || extension || ' in ' || modality_dir || '/' ELSE '' END AS message
    FROM manifest
""")
def manifest_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, sf_dir)


@query(MANIFEST_SQL + """
    SELECT subject_id, string_agg(DISTINCT modality_dir, ',' ORDER BY modality_dir) AS modalities,
           count(*) AS total_files, count(plugin) AS processable, count(*) - count(plugin) AS skipped
    FROM manifest GROUP BY subject_id
""")
def manifest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = status.subject_manifests(manifest(spark, sf_dir))
    return found.withColumn("modalities", F.array_join("modalities", ","))


@query(MANIFEST_SQL + "SELECT plugin, relative_path FROM manifest WHERE plugin IS NOT NULL AND subject_id = 'sub-src1'")
def task_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.task_list(status.of_subject(manifest(spark, sf_dir), "sub-src1"))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the files are in the harmonized tier."""
    files = manifest(spark, sf_dir)
    done = files.filter("cast(regexp_extract(filename, '(\\\\d+)(\\\\.|$)', 1) as bigint) % 3 = 0")
    return status.mark_processed(files, done.select("plugin", "relative_path"))


_TALLIES = """count(*) AS total_files, count(plugin) AS processable,
    count(*) FILTER (plugin IS NOT NULL AND done) AS processed,
    count(*) FILTER (plugin IS NOT NULL AND NOT done) AS pending, count(*) - count(plugin) AS skipped"""


@query(MANIFEST_SQL + f""", marked AS (SELECT *, doc_id % 3 = 0 AS done FROM manifest)
    SELECT subject_id, 1::BIGINT AS subjects, {_TALLIES} FROM marked GROUP BY subject_id
    UNION ALL SELECT NULL, count(DISTINCT subject_id), {_TALLIES} FROM marked
""")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.status_counts(marked(spark, sf_dir))


@query(MANIFEST_SQL + """
    SELECT subject_id, filename, relative_path,
           CASE WHEN plugin IS NULL THEN 'skipped' WHEN doc_id % 3 = 0 THEN 'processed' ELSE 'pending' END AS state
    FROM manifest
""")
def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.file_status(marked(spark, sf_dir))


@query(MANIFEST_SQL + """,
    names AS (SELECT plugin || '_' || stem AS name FROM manifest WHERE plugin IS NOT NULL AND doc_id % 5 = 0)
    SELECT relative_path, plugin IS NOT NULL AND EXISTS (SELECT 1 FROM names WHERE contains(name, stem)) AS processed
    FROM manifest
""")
def status_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substring form: 'scan_12' counts as processed when 'omics_scan_120' exists."""
    files = manifest(spark, sf_dir)
    done = status.processable(files).filter(
        "cast(regexp_extract(filename, '(\\\\d+)(\\\\.|$)', 1) as bigint) % 5 = 0"
    )
    names = done.select(F.concat_ws("_", "plugin", paths.stem(c("filename"))).alias("name"))
    return status.mark_processed_by_name(files, names).select("relative_path", "processed")


@query("""
    WITH files AS (
        SELECT ['bronze', 'silver', 'gold'][page_id % 3 + 1] AS tier, split_part(url, '//', 2) || '/' || page_id AS relative_path
        FROM pages),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY relative_path) AS position,
                      count(*) OVER (PARTITION BY tier) AS total_files FROM files)
    SELECT tier, total_files, position, relative_path FROM ranked WHERE position <= 5
""")
def tier_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five paths of a tier are the feature."""
    files = table(spark, sf_dir, "pages").select(
        _pick(("bronze", "silver", "gold"), "page_id % 3").alias("tier"),
        F.concat(F.get(F.split("url", "//"), F.lit(1)), F.lit("/"), c("page_id")).alias("relative_path"),
    )
    return inventory(files)


@query("""
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'ses-' || lang WHEN 1 THEN 'ses-01' ELSE 'ses-' END AS visit_session,
           CASE doc_id % 3 WHEN 1 THEN 'sub-unknown' ELSE 'sub-' || source END AS participant_id,
           CASE doc_id % 3 WHEN 1 THEN NULL ELSE 'sub-' || source END AS subject_id,
           CASE doc_id % 3 WHEN 0 THEN 'ses-' || lang END AS session_id
    FROM documents
""")
def default_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = (
        F.when(c("doc_id") % 3 == 0, F.concat(F.lit("harmonized_nlp_sub-"), c("source"), F.lit("_ses-"), c("lang"), F.lit("_x.csv")))
        .when(c("doc_id") % 3 == 1, F.concat(F.lit("harmonized_nlp_"), c("doc_id"), F.lit(".csv")))
        .otherwise(F.concat(F.lit("harmonized_ses-_sub-"), c("source"), F.lit(".csv")))
    )
    files = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("/silver/"), name).alias("path"))
    keyed = bronze.with_default_keys(files, c("path"))
    return keyed.select(
        "doc_id", "visit_session", "participant_id",
        paths.subject_of(c("path")).alias("subject_id"), paths.session_of(c("path")).alias("session_id"),
    )


@query("""
    SELECT o_orderkey AS "order key", nullif(o_orderstatus, 'F') AS status, o_totalprice AS price,
           o_orderkey % 2 = 0 AS even,
           CASE WHEN o_orderkey % 3 = 0 THEN 'said "' || o_orderpriority || '", then left' END AS note
    FROM orders
""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV with missing-value tokens and quotes; read back with inferred types."""
    folder = new_folder(spark, "csv-scan")
    tokens = F.when(c("o_orderkey") % 2 == 0, F.lit("n/a")).otherwise(F.lit("<NA>"))
    note = F.concat(F.lit('said "'), c("o_orderpriority"), F.lit('", then left'))
    written = table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("order key"),
        F.when(c("o_orderstatus") == "F", tokens).otherwise(c("o_orderstatus")).alias("status"),
        c("o_totalprice").alias("price"),
        F.initcap((c("o_orderkey") % 2 == 0).cast("string")).alias("even"),
        F.when(c("o_orderkey") % 3 == 0, note).alias("note"),
    )
    tables.export_csv(written, folder)
    return bronze.read_csv(spark, folder).drop(SOURCE)


@query("""
    WITH listed AS (SELECT vec_id, embedding::DOUBLE[] AS hr, label FROM embeddings)
    SELECT 'sub-' || vec_id AS participant_id, 'brand ' || label AS device_brand, round(list_avg(hr), 6) AS mean_hr,
           CASE WHEN label > 0 THEN round(100.0::DOUBLE * CASE label % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END / 3, 6) END
           AS sleep_efficiency, 'digital_biomarker_wearable' AS modality_category
    FROM listed
""")
def wearable_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry written as JSON, read with a schema and reduced per row."""
    folder = new_folder(spark, "wearable-scan")
    stages = (
        F.when(c("label") <= 0, F.array().cast("array<string>"))
        .when(c("label") % 3 == 0, F.array(F.lit("deep"), F.lit("light"), F.lit("wake")))
        .when(c("label") % 3 == 1, F.array(F.lit("deep"), F.lit("rem"), F.lit("light")))
        .otherwise(F.array(F.lit("light"), F.lit("light"), F.lit("wake")))
    )
    table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("sub-"), c("vec_id")).alias("participant_id"),
        F.concat(F.lit("brand "), c("label")).alias("device_brand"),
        c("embedding").cast("array<double>").alias("heart_rate_array"), stages.alias("sleep_stages_array"),
    ).write.json(folder)
    schema = "participant_id string, device_brand string, heart_rate_array array<double>, sleep_stages_array array<string>"
    tagged = spark.read.schema(schema).json(folder).transform(wearables)
    return tagged.select(
        "participant_id", "device_brand", F.round("mean_hr", 6).alias("mean_hr"),
        F.round("sleep_efficiency", 6).alias("sleep_efficiency"), "modality_category",
    )


@query("""
    SELECT participant_id, visit_session, modality_category, seq_id, event_type, value, NULL::DOUBLE AS total_price FROM (
        SELECT 'sub-' || user_id AS participant_id, 'ses-' || ((day(ts) - 1) // 7) AS visit_session,
               'activity' AS modality_category, event_id AS seq_id, event_type, value FROM events)
    UNION ALL
    SELECT 'sub-' || o_custkey, 'ses-' || ((day(o_orderdate) - 1) // 7), 'purchases', o_orderkey, NULL, NULL, o_totalprice
    FROM orders
""")
def silver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two modalities written into one partitioned table and read back as one."""
    folder = new_folder(spark, "silver")
    tables.write_silver(activity(spark, sf_dir), folder)
    tables.write_silver(purchases(spark, sf_dir), folder)
    return tables.read_silver(spark, folder).select(
        "participant_id", "visit_session", "modality_category", "seq_id", "event_type", "value", "total_price"
    )


@query(f"""
    WITH registry AS ({REGISTRY_SQL}),
    levels AS (
        SELECT replace(p_name, ' ', '_') AS standard_name, unnest(CASE p_size % 4
            WHEN 1 THEN [('0', 'No'), ('1', p_type)] WHEN 2 THEN [('2', 'a=b'), ('3', p_brand)] ELSE [] END) AS item
        FROM part)
    SELECT 'variables' AS source, lower(p_type) AS name, count(*) AS rows FROM registry GROUP BY 2
    UNION ALL SELECT 'lookups', item[1], count(*) FROM levels GROUP BY 2
""")
def registry_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry written per modality with its lookup table; rows counted from what is read back."""
    folder = new_folder(spark, "registry")
    tables.write_registry(derived_registry(spark, sf_dir), folder)
    listed, lookups = tables.read_registry(spark, folder)
    return (
        listed.groupBy(c("modality").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("source", F.lit("variables"))
        .unionByName(
            lookups.groupBy(c("code").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("source", F.lit("lookups"))
        )
    )


@query("""
    SELECT event_id AS "Event", user_id AS nonstandard_user_id, value AS nonstandard_value FROM events
""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files arriving in two steps, harmonized by two runs over one checkpoint."""
    from cohortweave.operators.harmonize import harmonize

    source, target = new_folder(spark, "arriving"), new_folder(spark, "harmonized")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    registry = spark.createDataFrame(
        [("event_id", "Event")], "original_variable_name string, standard_name string"
    )
    checkpoint = new_folder(spark, "checkpoint")
    for step in (0, 1):
        events.filter(c("event_id") % 2 == step).write.mode("append").parquet(source)
        ingest_new_files(
            spark, source, target, harmonize(registry), schema=events.schema, checkpoint=checkpoint
        )
    return spark.read.parquet(target).drop("batch")
