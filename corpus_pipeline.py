"""The corpus pipeline: toxicity, line dedup, near duplicates, decontamination and mixing, in this order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import decontaminate, jaccard_join, line_dedup, toxicity
from cohortweave.llm.queries import source_mix, table
from cohortweave.sources.workspace import stored


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it is fitted on the labelled ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one that had lines to remove and has no other text left goes."""
    found = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed_lines") == 0) | (F.trim("text") != "")
    return found.filter(left).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest id."""
    return jaccard_join.keep_one(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, with the epoch of each row and how many of its words were taken."""
    return source_mix(spark, docs)


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_once),
    ("ngram_jaccard_join", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("mixing", mixed),
]

# The classifier's scores cannot be stated in SQL; each stage is tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
