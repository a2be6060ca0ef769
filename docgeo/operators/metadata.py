"""Metadata from raw text with ordered regular expressions (independent of the place branch)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from docgeo.functions.text import first_match

# The workflow's metadata patterns, in their original order (first matching pattern wins; kept
# verbatim, including the unescaped "." in "Mio." and the leading blank of the last funding pattern).
GRADE_PATTERNS = [
    r"Note[\:]?[ ]?\d",
    r"rating[\:]?[ ]?\d",
    r"Grade[\:]?[ ]?\d",
    r"note[\:]?[ ]?\d",
    r"Stufe[\:]?[ ]?\d",
]
FUNDING_VOLUME_PATTERNS = [
    r"[0-9,\.]{2,15}[ ]?Mio. E[ ]?U[ ]?R",
    r"E[ ]?U[ ]?R [0-9,\.]{2,4}[ ]?Mio.",
    r" D[ ]?M[ ]? [0-9,\.]{2,4}[ ]?Mio.",
]
DATE_PATTERNS = [r"[\d]{1,2}\.[\d]{1,2}\.[\d]{4}"]

DEFAULT_PATTERNS = {"grade": GRADE_PATTERNS, "funding_volume": FUNDING_VOLUME_PATTERNS, "date": DATE_PATTERNS}


def extract_metadata(
    docs: DataFrame, patterns: Mapping[str, Sequence[str]] = DEFAULT_PATTERNS, text_col: str = "text"
) -> DataFrame:
    """doc_id + one nullable string column per field: the whole match of the field's first matching pattern,
    searched over the whole text. One narrow projection, no shuffle."""
    return docs.select("doc_id", *[first_match(text_col, list(ps)).alias(name) for name, ps in patterns.items()])
