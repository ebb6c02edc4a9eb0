"""Filtered access to the cohort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cohortweave.operators.select import (
    only_modalities,
    only_participants,
    only_variables,
    to_records,
    without_empty,
    without_nonstandard,
)
from cohortweave.sources.tables import shape


@dataclass(frozen=True)
class CohortResult:
    """Matching rows and the cohort they came from; counting is left until it is asked for."""

    data: DataFrame
    cohort: DataFrame

    @property
    def columns(self) -> list[str]:
        return self.data.columns

    def result_shape(self) -> tuple[int, int]:
        return shape(self.data)

    def original_shape(self) -> tuple[int, int]:
        return shape(self.cohort)

    def records(self) -> DataFrame:
        """Rows as JSON objects, as a table: results may be of any size."""
        return to_records(self.data)


def query_gold(
    gold: DataFrame,
    participants: Sequence[str] | DataFrame | None = None,
    modalities: Sequence[str] | None = None,
    variables: Sequence[str] | None = None,
    exclude_nonstandard: bool = False,
    exclude_empty: bool = True,
) -> CohortResult:
    """Rows of participants, then columns by modality, variable, registry and content, in this order.

    `exclude_empty` costs one aggregate over the result; the rest is pushed into the scan.
    """
    df = only_participants(gold, participants)
    df = only_modalities(df, modalities)
    df = only_variables(df, variables)
    if exclude_nonstandard:
        df = without_nonstandard(df)
    if exclude_empty:
        df = without_empty(df)
    return CohortResult(df, gold)
