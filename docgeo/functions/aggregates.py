"""Aggregate expressions with the workflow's null rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def avg_strict(c: str | Column) -> Column:
    """Mean that is NULL as soon as one input is NULL (R's ``mean`` without ``na.rm``); Spark's ``avg`` skips NULLs."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))


def first_by(c: str | Column, order: Column) -> Column:
    """Value of ``c`` on the row with the smallest ``order`` key: "first in row order" made explicit, so the
    result does not depend on how a shuffle happened to interleave rows."""
    c = F.col(c) if isinstance(c, str) else c
    return F.min_by(c, order)
