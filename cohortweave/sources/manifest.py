"""The raw folder as a table: one row per file with its subject, session and plugin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.constants import SKIP_MESSAGE, UNKNOWN_SUBJECT, WEARABLE_KEYS
from cohortweave.functions.names import c
from cohortweave.functions.paths import (
    extension,
    file_name,
    first_directory,
    relative_to,
    route,
    session_of,
    subject_of,
)
from cohortweave.sources import many_files
from cohortweave.sources.bronze import plain_path
from cohortweave.sources.workspace import listing


def json_kind(text):
    """'bundle', 'wearable', 'other' or, for anything but a JSON object, 'invalid'."""
    keys = F.json_object_keys(text)
    return (
        F.when(keys.isNull(), F.lit("invalid"))
        .when(F.get_json_object(text, "$.resourceType") == "Bundle", F.lit("bundle"))
        .when(F.arrays_overlap(keys, F.array(*[F.lit(k) for k in WEARABLE_KEYS])), F.lit("wearable"))
        .otherwise(F.lit("other"))
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files below a folder; contents are not read."""
    if many_files.has_many(folder := many_files.qualified(spark, root)):
        return many_files.files_below(spark, folder)
    return _few_files(spark, root)


def _few_files(spark: SparkSession, root: str) -> DataFrame:
    with listing(spark):
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def list_bronze(spark: SparkSession, root: str, subject: str | None = None, paths: Sequence[str] | None = None) -> DataFrame:
    """(path, json_kind) of all files; only JSON files are opened, and no join is needed.

    With a subject, or with `paths`, only its files or these are listed and opened: the filter on the
    path leaves the others out before anything is read. Documents count by lines, each is a row.
    """

    def wanted(path: Column) -> Column:
        return F.lit(True) if subject is None else F.coalesce(subject_of(path), F.lit(UNKNOWN_SUBJECT)) == subject

    folder = None if paths is not None else many_files.qualified(spark, root)
    many = folder is not None and many_files.has_many(folder)
    if paths is not None:
        listed = spark.createDataFrame([(p,) for p in paths], "path string")
        documents_in = [p for p in paths if p.endswith(".json")]
    else:
        listed, documents_in = many_files.files_below(spark, folder) if many else _few_files(spark, root), [root]
    others = listed.filter(~F.endswith("path", F.lit(".json")) & wanted(c("path"))).select(
        "path", F.lit(None).cast("string").alias("json_kind")
    )
    if not documents_in:
        return others
    if many:
        lines = many_files.contents(listed.filter(F.endswith("path", F.lit(".json")) & wanted(c("path"))), by_line=True)
        return others.unionByName(lines.select("path", json_kind(c("content")).alias("json_kind")))
    path = plain_path(c("_metadata").getField("file_path"))
    with listing(spark):
        texts = spark.read.options(wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").text(documents_in)
    documents = texts.filter(wanted(path)).select(path.alias("path"), json_kind(c("value")).alias("json_kind"))
    return others.unionByName(documents)


def build_manifest(files: DataFrame, root: str) -> DataFrame:
    """One row per file below the root: ids, routing and why a file is skipped. A projection."""
    name = file_name(c("path"))
    described = (
        files.withColumn("relative_path", relative_to(c("path"), root))
        .filter("relative_path IS NOT NULL")
        .select(
            "path",
            F.coalesce(subject_of(c("path")), F.lit(UNKNOWN_SUBJECT)).alias("subject_id"),
            session_of(c("path")).alias("session_id"),
            first_directory(c("relative_path")).alias("modality_dir"),
            name.alias("filename"),
            "relative_path",
            extension(name).alias("extension"),
            "json_kind",
        )
    )
    return described.withColumn("plugin", route(c("extension"), c("modality_dir"), c("json_kind"))).select(
        "path", "subject_id", "session_id", "modality_dir", "filename", "relative_path", "extension", "plugin",
        F.when(c("plugin").isNull(), F.lit("skipped")).otherwise(F.lit("pending")).alias("status"),
        F.when(c("plugin").isNull(), F.format_string(SKIP_MESSAGE, c("extension"), c("modality_dir")))
        .otherwise(F.lit("")).alias("message"),
    )


def discover(spark: SparkSession, root: str, subject: str | None = None, *, in_order: bool = False) -> DataFrame:
    """Manifest of a raw folder, or of one subject's files in it; `in_order` sorts it by path."""
    manifest = build_manifest(list_bronze(spark, root, subject), root)
    return manifest.orderBy("relative_path") if in_order else manifest


def tier_inventory(files: DataFrame, shown: int = 5) -> DataFrame:
    """(tier, total_files, position, relative_path): file count and first paths of each tier."""
    totals = files.groupBy("tier").agg(F.count(F.lit(1)).alias("total_files"))
    in_order = Window.partitionBy("tier").orderBy("relative_path")
    first = files.withColumn("position", F.row_number().over(in_order).cast("bigint")).filter(c("position") <= shown)
    return totals.join(first.select("tier", "position", "relative_path"), "tier")
