"""Cohort exploration: find participants, describe variables, rank correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from cohortweave.operators.nested import columns_of, is_nested, matching_records, positions_beside, variable_catalog
from cohortweave.operators.select import catalog, matching
from cohortweave.operators.statistics import correlations, describe
from cohortweave.sources.tables import read_gold


class CohortExplorer:
    """Questions about one cohort table, wide or nested; both know the same column names."""

    def __init__(self, gold: DataFrame):
        self.gold = gold
        self.nested = is_nested(gold)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CohortExplorer:
        return cls(read_gold(spark, path))

    def find_participants(self, filters: Mapping[str, tuple[str, Any]]) -> DataFrame:
        """Rows that satisfy every condition."""
        return matching_records(self.gold, filters) if self.nested else matching(self.gold, filters)

    def cohort_stats(self, columns: Sequence[str]) -> DataFrame:
        """Descriptive statistics and missing share per column."""
        return describe(columns_of(self.gold, columns) if self.nested else self.gold, columns)

    def correlations(self, target: str, threshold: float = 0.3) -> DataFrame:
        """Variables whose correlation with the target reaches the threshold.

        In a nested cohort these are the variables of the same record number and of single records.
        """
        gold = columns_of(self.gold, positions_beside(self.gold, target)) if self.nested else self.gold
        return correlations(gold, target, threshold)

    def modalities(self) -> DataFrame:
        """(modality, variable) of the cohort."""
        return variable_catalog(self.gold) if self.nested else catalog(self.gold)
