"""Tagging of raw rows with their modality, per plugin."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.constants import (
    MODALITY,
    NOTES_MODALITY,
    OMICS_MARKERS,
    PSYCHOMETRIC_MARKERS,
    SPECIMEN_UNKNOWN,
    SPECIMEN_UNSPECIFIED,
    SPECIMEN_WORDS,
    SURVEY_GENERAL,
    SURVEY_PSYCHOMETRIC,
    WEARABLE_MODALITY,
)
from cohortweave.functions.names import c
from cohortweave.functions.paths import SUFFIX_PLUGINS
from cohortweave.functions.text import note_codes
from cohortweave.functions.values import array_mean, stage_share
from cohortweave.operators.harmonize import harmonize

Tagger = Callable[[DataFrame], DataFrame]


def omics(df: DataFrame) -> DataFrame:
    """Genomics, proteomics or metabolomics, by the identifying column that is present."""
    for marker, modality in OMICS_MARKERS:
        if marker in df.columns:
            return df.withColumn(MODALITY, F.lit(modality))
    return df


def assessments(df: DataFrame) -> DataFrame:
    """Psychometric survey if a known score is present, else a general one."""
    scored = any(marker in df.columns for marker in PSYCHOMETRIC_MARKERS)
    return df.withColumn(MODALITY, F.lit(SURVEY_PSYCHOMETRIC if scored else SURVEY_GENERAL))


def specimen_modality(specimen: Column) -> Column:
    """Modality of one specimen, by the first known word in its description."""
    (first_word, first_modality), *others = SPECIMEN_WORDS
    lowered = F.lower(specimen)
    tag = F.when(F.contains(lowered, F.lit(first_word)), F.lit(first_modality))
    for word, modality in others:
        tag = tag.when(F.contains(lowered, F.lit(word)), F.lit(modality))
    return tag.otherwise(F.lit(SPECIMEN_UNKNOWN))


def biospecimens(df: DataFrame) -> DataFrame:
    if "specimen_type" not in df.columns:
        return df.withColumn(MODALITY, F.lit(SPECIMEN_UNSPECIFIED))
    return df.withColumn(MODALITY, specimen_modality(c("specimen_type")))


def notes(df: DataFrame) -> DataFrame:
    """Codes of the phenotypes named in each note."""
    coded = df.withColumn("extracted_snomed", note_codes(c("clinical_note"))) if "clinical_note" in df.columns else df
    return coded.withColumn(MODALITY, F.lit(NOTES_MODALITY))


def wearables(df: DataFrame) -> DataFrame:
    """Mean heart rate and sleep efficiency out of the telemetry arrays of each row."""
    if "heart_rate_array" in df.columns:
        df = df.withColumn("mean_hr", array_mean(c("heart_rate_array")))
    if "sleep_stages_array" in df.columns:
        df = df.withColumn("sleep_efficiency", stage_share(c("sleep_stages_array")))
    return df.withColumn(MODALITY, F.lit(WEARABLE_MODALITY))


def unchanged(df: DataFrame) -> DataFrame:
    """Flattened bundles carry their modality already."""
    return df


TAGGERS: dict[str, Tagger] = {
    "omics": omics,
    "assessments": assessments,
    "biospecimens": biospecimens,
    "nlp": notes,
    "wearables": wearables,
    "ehr": unchanged,
}


# The columns whose presence in a file decides how its rows are tagged. A plugin that is not listed may look at any.
MARKERS: dict[str, tuple[str, ...]] = {
    "omics": tuple(marker for marker, _ in OMICS_MARKERS),
    "assessments": tuple(PSYCHOMETRIC_MARKERS),
    "biospecimens": ("specimen_type",),
    "nlp": ("clinical_note",),
    "wearables": ("heart_rate_array", "sleep_stages_array"),
    "ehr": (),
}

# Readers that plugins bring: files (path) -> raw rows with their `_source`.
Reader = Callable[[DataFrame], DataFrame]
READERS: dict[str, Reader] = {}


def register(
    plugin: str, tagger: Tagger, *, reader: Reader | None = None, markers: Sequence[str] | None = None, suffix: str | None = None
) -> None:
    """Add a plugin or replace one.

    A plugin may bring a reader for its files, `sources.per_file.reader` for instance, and a suffix that
    they have. `markers` are the columns whose presence the tagger asks for; without them files of
    different columns are tagged apart.
    """
    unregister(plugin)
    TAGGERS[plugin] = tagger
    if reader is not None:
        READERS[plugin] = reader
    if markers is not None:
        MARKERS[plugin] = tuple(markers)
    if suffix is not None:
        SUFFIX_PLUGINS[suffix] = plugin


def unregister(plugin: str) -> None:
    """Forget a plugin, its reader, markers and suffixes."""
    for known in (TAGGERS, READERS, MARKERS):
        known.pop(plugin, None)
    for suffix in [s for s, p in SUFFIX_PLUGINS.items() if p == plugin]:
        del SUFFIX_PLUGINS[suffix]


def harmonize_modality(df: DataFrame, plugin: str, registry: DataFrame) -> DataFrame:
    """Raw rows of one plugin -> tagged rows under registry names."""
    if plugin not in TAGGERS:
        raise ValueError(f"unknown plugin {plugin!r}; known: {sorted(TAGGERS)}")
    return df.transform(TAGGERS[plugin]).transform(harmonize(registry))
