"""Class/type removal rules and the name blacklist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


WILDCARD = "all"


def removal_condition(rules: Sequence[tuple[str, str]]) -> Column:
    """Boolean column: the row matches a rule. ``(all, t)`` matches type t, ``(c, all)`` class c, ``(c, t)`` both.
    A rule ``(all, all)`` takes the first branch and so matches only a literal type ``all``."""
    conds = []
    for klass, typ in rules:
        if klass == WILDCARD:
            conds.append(F.col("type") == F.lit(typ))
        elif typ == WILDCARD:
            conds.append(F.col("class") == F.lit(klass))
        else:
            conds.append((F.col("class") == F.lit(klass)) & (F.col("type") == F.lit(typ)))
    if not conds:
        return F.lit(False)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    return F.coalesce(cond, F.lit(False))  # a missing class/type never matches


def remove_classes(doc_geo: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """Drop rows matching any (class, type) removal rule; no match keeps every row.

    A literal rule list compiles to one filter expression. A rule table becomes three anti joins against it:
    on type for ``(all, t)``, on class for ``(c, all)``, on both for exact pairs.
    """
    if not isinstance(rules, DataFrame):
        return doc_geo.where(~removal_condition(list(rules)))
    r = rules.select("class", "type").where(F.col("class").isNotNull() & F.col("type").isNotNull()).distinct()
    by_type = r.where(F.col("class") == WILDCARD).select("type")
    by_class = r.where((F.col("class") != WILDCARD) & (F.col("type") == WILDCARD)).select("class")
    exact = r.where((F.col("class") != WILDCARD) & (F.col("type") != WILDCARD))
    return (
        doc_geo.join(by_type, "type", "left_anti")
        .join(by_class, "class", "left_anti")
        .join(exact, ["class", "type"], "left_anti")
        .select(*doc_geo.columns)
    )


def _names(blacklist: DataFrame) -> DataFrame:
    return blacklist.select(F.col("location").alias("query")).where(F.col("query").isNotNull()).distinct()


def remove_blacklisted(doc_geo: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Drop rows whose name is on the blacklist (name only; the blacklist's coordinates are not used)."""
    return doc_geo.join(_names(blacklist), "query", "left_anti")


def blacklist_report(doc_geo: DataFrame, blacklist: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_removed, removed): blacklisted names per document, sorted and comma separated. With ``docs``,
    documents without a hit are listed with 0 and NULL. Lists are bounded by the blacklist's size."""
    hits = doc_geo.join(_names(blacklist), "query", "left_semi")
    rep = hits.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_removed"),
        F.array_join(F.array_sort(F.collect_list("query")), ", ").alias("removed"),
    )
    if docs is None:
        return rep
    return (
        docs.select("doc_id")
        .join(rep, "doc_id", "left")
        .select("doc_id", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "removed")
    )
