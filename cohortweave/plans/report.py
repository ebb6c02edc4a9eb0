"""Quality report of the harmonized tier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from cohortweave.constants import MODALITY, SOURCE
from cohortweave.operators import profile
from cohortweave.sources.workspace import stored


class QualityReport:
    """The report as tables, so that any number of files and subjects fits.

    The column profile is computed once, when it is first asked for, and stored; completeness
    and issues are read from it.
    """

    def __init__(
        self, silver: DataFrame, file: str, modality: str | None = None, order_by: Sequence[str] | None = None
    ):
        self.rows = profile.with_modality_filter(silver, modality)
        self.file = file
        self.group = [MODALITY, file]
        self.order_by = order_by

    @property
    def modalities(self) -> DataFrame:
        """Records, files and number of subjects per modality."""
        return profile.modality_report(self.rows, self.file)

    @property
    def subjects(self) -> DataFrame:
        """Subjects of each modality."""
        return profile.modality_subjects(self.rows, self.file)

    @cached_property
    def columns(self) -> DataFrame:
        """Profile of every column of every file."""
        skipped = {MODALITY, self.file, SOURCE, "_plugin", *(self.order_by or ())}
        measured = [name for name in self.rows.columns if name not in skipped]
        return stored(profile.full_profile(self.rows, self.group, measured, self.order_by), "column-profile")

    @property
    def completeness(self) -> DataFrame:
        """Overall completeness of each file."""
        return profile.overall_completeness(self.columns, self.group)

    @property
    def issues(self) -> DataFrame:
        """Columns with low completeness or outliers."""
        return profile.quality_issues(self.columns, self.group)
