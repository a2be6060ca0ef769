"""String expressions: tokens, n-grams, name clean-up, ordered regex extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_PATTERN = r"\p{L}+"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column, pattern: str = WORD_PATTERN) -> Column:
    """Array of the pattern's matches in reading order (the tokeniser of the lexicon tagger)."""
    return F.regexp_extract_all(col_(text), F.lit(pattern), 0)


def newline_to_blank(c: str | Column) -> Column:
    return F.regexp_replace(col_(c), "\n", " ")


def clean_name(c: str | Column) -> Column:
    """Lemma clean-up of the extraction step: newline and underscore to blank, trim blank/tab/CR/LF on both
    ends, collapse runs of blanks. ``F.trim`` alone would strip blanks only."""
    c = F.translate(newline_to_blank(c), "_", " ")
    c = F.regexp_replace(c, r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    return F.regexp_replace(c, " +", " ")


def strip_braces(c: str | Column) -> Column:
    return F.translate(col_(c), "{}", "")


def first_match(text: str | Column, patterns: Sequence[str]) -> Column:
    """Whole match of the first pattern (in list order) that matches anywhere; NULL when none does.

    ``coalesce`` stops at the first non-null argument, so later patterns are not evaluated after a hit.
    """
    if not patterns:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.regexp_substr(col_(text), F.lit(p)) for p in patterns])


def file_id(path: str | Column, prefix: str | None = None) -> Column:
    """File id from a path: the literal directory prefix removed, or the last path segment."""
    path = col_(path)
    if prefix is not None:
        p = prefix if prefix.endswith("/") else prefix + "/"
        return F.when(F.startswith(path, F.lit(p)), F.substr(path, F.lit(len(p) + 1))).otherwise(path)
    return F.element_at(F.split(path, "/"), -1)
