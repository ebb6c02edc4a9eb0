"""What has been found, processed and is pending, per subject and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.names import c
from cohortweave.functions.paths import stem
from cohortweave.operators.lookups import bit_filter, lookup_join


def processable(manifest: DataFrame) -> DataFrame:
    return manifest.filter(c("plugin").isNotNull())


def skipped(manifest: DataFrame) -> DataFrame:
    return manifest.filter(c("plugin").isNull())


def of_subject(manifest: DataFrame, subject: str | None) -> DataFrame:
    """One subject's files, or all."""
    return manifest if subject is None else manifest.filter(c("subject_id") == subject)


def task_list(manifest: DataFrame) -> DataFrame:
    """(plugin, relative_path) of the files to process."""
    return processable(manifest).select("plugin", "relative_path")


def subject_manifests(manifest: DataFrame) -> DataFrame:
    """Files, processable and skipped files and directories per subject.

    The files themselves stay rows of the manifest; a subject may have any number of them.
    """
    per_directory = manifest.groupBy("subject_id", "modality_dir").agg(
        F.count(F.lit(1)).alias("files"), F.count("plugin").alias("processable")
    )
    return per_directory.groupBy("subject_id").agg(
        F.array_sort(F.collect_set("modality_dir")).alias("modalities"),
        F.sum("files").alias("total_files"),
        F.sum("processable").alias("processable"),
        (F.sum("files") - F.sum("processable")).alias("skipped"),
    )


def mark_processed(manifest: DataFrame, silver_files: DataFrame) -> DataFrame:
    """Add `processed`: whether the harmonized tier holds rows of a file.

    `silver_files` lists (plugin, relative_path); files are matched exactly, by one hash join.
    """
    done = silver_files.select(
        c("plugin").alias("_plugin"), c("relative_path").alias("_path"), F.lit(True).alias("_done")
    ).distinct()
    joined = manifest.join(done, (c("plugin") == c("_plugin")) & (c("relative_path") == c("_path")), "left")
    return joined.withColumn("processed", F.coalesce("_done", F.lit(False))).drop("_plugin", "_path", "_done")


def stem_hits(names: DataFrame, stems: DataFrame) -> DataFrame:
    """Distinct `_stem`s of the names: their substrings that have the length and the hash bits of a stem.

    Substrings are tested where the name is read and only those that pass become rows, so the rows grow with
    the stems that occur (all are among the hits) and not with the lengths of names.
    """
    # File names have at most 255 characters, so there are at most that many lengths.
    per_length = dict(stems.groupBy(F.length("_stem")).count().collect())
    known = bit_filter(stems.select(F.xxhash64("_stem").alias("_hash")), "_hash", sum(per_length.values()))
    lengths = F.array(*[F.lit(n) for n in sorted(per_length)]).cast("array<int>")
    size = F.length("name")

    def of_length(n: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(c("name"), i, n))
        return F.filter(every, lambda part: known(F.xxhash64(part)))

    passing = F.flatten(F.transform(F.filter(lengths, lambda n: n <= size), of_length))
    return names.select("name").distinct().select(F.explode(passing).alias("_stem")).distinct()


def mark_processed_by_name(manifest: DataFrame, silver_names: DataFrame) -> DataFrame:
    """Add `processed`: whether a file's stem occurs anywhere in some harmonized name.

    A stem occurs in a name if it equals one of the name's substrings of its length. Substrings that pass a bit
    filter of the stems' hashes are compared with the stems themselves, by one join.
    """
    stems = processable(manifest).select(stem(c("filename")).alias("_stem")).filter("_stem IS NOT NULL").distinct()
    found = stems.join(stem_hits(silver_names, stems), "_stem", "left_semi").select(c("_stem"), F.lit(True).alias("_done"))
    joined = lookup_join(manifest.withColumn("_stem", stem(c("filename"))), found, ["_stem"])
    done = F.coalesce("_done", F.lit(False)) & c("plugin").isNotNull()
    return joined.withColumn("processed", done).drop("_stem", "_done")


def status_counts(marked: DataFrame) -> DataFrame:
    """Counts per subject, and in the row with a null subject the totals over all of them.

    The totals add up the rows per subject, so no task sees more than partial sums. A table without
    files has the row of totals alone.
    """
    names = ["total_files", "processable", "processed", "pending", "skipped"]
    per_subject = marked.groupBy("subject_id").agg(*_tallies())
    totals = per_subject.agg(
        F.count(F.lit(1)).alias("subjects"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
    ).withColumn("subject_id", F.lit(None).cast("string"))
    return per_subject.withColumn("subjects", F.lit(1).cast("bigint")).select("subject_id", "subjects", *names).unionByName(totals)


def _tallies() -> list[Column]:
    can = c("plugin").isNotNull()
    return [
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(can).alias("processable"),
        F.count_if(can & c("processed")).alias("processed"),
        F.count_if(can & ~c("processed")).alias("pending"),
        F.count_if(~can).alias("skipped"),
    ]


def file_status(marked: DataFrame) -> DataFrame:
    """(subject, file, state): processed, pending or skipped, one row per file."""
    state = (
        F.when(c("plugin").isNull(), F.lit("skipped"))
        .when(c("processed"), F.lit("processed"))
        .otherwise(F.lit("pending"))
    )
    return marked.select("subject_id", "filename", "relative_path", state.alias("state"))
