"""Missing-value tokens, note tagging and string similarity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortweave.constants import CLINICAL_NA, NA_LIKE, NO_CODES, NOTE_CODES


def na_to_null(text: Column, tokens: Iterable[str] = CLINICAL_NA) -> Column:
    """Null where the text is one of the missing-value tokens."""
    return F.when(~text.isin(list(tokens)), text)


def is_na_like(text: Column) -> Column:
    """True for text that only looks like a missing marker."""
    return F.lower(text).isin(list(NA_LIKE))


def note_codes(note: Column, keywords: Iterable[tuple[str, str]] = NOTE_CODES) -> Column:
    """Codes of the keywords found in a note, joined with ';', or NONE."""
    lowered = F.lower(note)
    found = F.concat_ws(";", *[F.when(F.contains(lowered, F.lit(word)), F.lit(code)) for word, code in keywords])
    return F.when(found == "", F.lit(NO_CODES)).otherwise(found)


def edit_similarity(left: Column, right: Column) -> Column:
    """1 - edit distance / length of the longer text."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.lit(1.0) - F.try_divide(F.levenshtein(left, right).cast("double"), longest.cast("double"))
