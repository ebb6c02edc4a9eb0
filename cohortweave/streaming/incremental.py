"""Harmonize only files that have not been seen: a file stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from cohortweave.plans.ingest import IngestReport, ingest_manifest
from cohortweave.sources.manifest import build_manifest, list_bronze
from cohortweave.sources.workspace import small_files, stored

# Columns of a file listing; only the path is read.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    schema: T.StructType | str,
    checkpoint: str,
    file_format: str = "parquet",
    options: dict[str, str] | None = None,
    max_files_per_batch: int = 10_000,
) -> str:
    """Process all files that arrived since the last run with the same checkpoint; returns the checkpoint.

    The checkpoint remembers finished files. Each batch writes to a folder of its own below the
    target and replaces it, so a batch that is repeated after a failure leaves no duplicates.
    """
    stream = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .options(**(options or {}))
        .load(source)
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return checkpoint


def ingest_listed(
    spark: SparkSession, paths: Sequence[str], bronze_root: str, silver_root: str, registry: DataFrame, *, batch: str,
    as_of: date | Column | None = None,
) -> IngestReport:
    """Route and harmonize the named files as one batch; a batch that is repeated replaces its own rows, counts and outcomes."""
    with small_files(spark):
        manifest = stored(build_manifest(list_bronze(spark, bronze_root, paths=paths), bronze_root), "manifest")
    return ingest_manifest(spark, manifest, silver_root, registry, batch=batch, as_of=as_of)


def ingest_arriving(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    registry: DataFrame,
    *,
    checkpoint: str,
    as_of: date | Column | None = None,
    max_files_per_batch: int = 10_000,
) -> None:
    """Ingest the raw files of any kind that arrived since the last run with the same checkpoint.

    The stream is a listing of files: a batch holds their paths, so at most `max_files_per_batch` of them
    reach the driver. Each goes through the same routing, harmonizing and writing as `plans.ingest.ingest`;
    the harmonized rows are the same as of an ingest of all files at once.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .load(bronze_root)
        .select("path")
    )

    def harmonize_batch(listed: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in listed.collect()]
        if paths:
            ingest_listed(spark, paths, bronze_root, silver_root, registry, batch=f"stream-{batch_id}", as_of=as_of)

    query = (
        files.writeStream.foreachBatch(harmonize_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
