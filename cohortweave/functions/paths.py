"""Everything that is read off a file path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortweave.constants import (
    DEFAULT_SESSION,
    DIRECTORY_PLUGINS,
    EXTENSION_PLUGINS,
    SESSION_PATTERN,
    SUBJECT_PATTERN,
    UNKNOWN_SUBJECT,
)


# Plugins of suffixes; registered plugins may add theirs.
SUFFIX_PLUGINS: dict[str, str] = dict(EXTENSION_PLUGINS)


def _first_match(path: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def subject_of(path: Column) -> Column:
    """First `sub-…` entity in the path, or null."""
    return _first_match(path, SUBJECT_PATTERN)


def session_of(path: Column) -> Column:
    """First `ses-…` entity in the path, or null."""
    return _first_match(path, SESSION_PATTERN)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    """File name without its last extension; a leading dot does not start one."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def extension(name: Column) -> Column:
    """Last extension with its dot, '.nii.gz' as a whole, or ''."""
    return F.when(F.endswith(name, F.lit(".nii.gz")), F.lit(".nii.gz")).otherwise(
        F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1)
    )


def plain(path: Column) -> Column:
    """A path as all listings spell it: local ones without scheme and authority."""
    return F.regexp_replace(path, "^file:/+", "/")


def plain_root(root: str) -> str:
    """A folder as listings spell it: without a trailing slash, and local ones without scheme or authority."""
    plain = root.rstrip("/")
    if plain.startswith("file:"):
        plain = "/" + plain.removeprefix("file:").lstrip("/")
    return plain


def relative_to(path: Column, root: str) -> Column:
    """The part of the path below the root folder; null outside of it."""
    prefix = plain_root(root) + "/"
    inside = F.locate(prefix, path)
    return F.when(inside > 0, F.substring(path, inside + len(prefix), F.length(path)))


def first_directory(relative: Column) -> Column:
    """First component of a relative path (the file name for a file at the root)."""
    return F.substring_index(relative, "/", 1)


def _keyed_part(file_stem: Column, key: str) -> Column:
    part = F.substring_index(F.element_at(F.split(file_stem, key, -1), 2), "_", 1)
    return F.when(F.contains(file_stem, F.lit(key)), F.concat(F.lit(key), part))


def default_session(file_stem: Column) -> Column:
    """Session named in a file stem, else the baseline session."""
    return F.coalesce(_keyed_part(file_stem, "ses-"), F.lit(DEFAULT_SESSION))


def default_participant(file_stem: Column) -> Column:
    """Participant named in a file stem, else the unknown subject."""
    return F.coalesce(_keyed_part(file_stem, "sub-"), F.lit(UNKNOWN_SUBJECT))


def _named(table: Mapping[str, str | None]) -> Column:
    """A constant map of the entries that have a value."""
    return F.create_map(*[F.lit(x) for pair in table.items() if pair[1] is not None for x in pair])


def directory_plugin(directory: Column) -> Column:
    """Plugin that the first directory level stands for, or null."""
    return F.try_element_at(_named(DIRECTORY_PLUGINS), directory)


def route(suffix: Column, directory: Column, json_kind: Column) -> Column:
    """Plugin of a file from its extension, directory and, for JSON, its content.

    `json_kind` is 'bundle', 'wearable', 'other' or 'invalid'; null outside of JSON files.
    """
    by_directory = (suffix == ".csv") | ((suffix == ".json") & (json_kind == "other"))
    by_content = F.when(json_kind == "bundle", F.lit("ehr")).when(json_kind == "wearable", F.lit("wearables"))
    return (
        F.when(by_directory, directory_plugin(directory))
        .when(suffix == ".json", by_content)
        .otherwise(F.try_element_at(_named(SUFFIX_PLUGINS), suffix))
    )
