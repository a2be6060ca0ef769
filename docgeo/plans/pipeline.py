"""Workflow entry points.

A: corpus -> languages -> place names -> geocode (cache + resolver) -> class/type filter -> confidence ->
   blacklist -> file names, country, continent -> whitelist ledger -> condensed whitelist.
B: corpus -> regex metadata (independent of A).

The order of A is the workflow's: the class/type filter runs before the centroid, the blacklist after the
confidence (a blacklisted name still pulls the centroid).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgeo.operators import confidence as C
from docgeo.operators import entities as E
from docgeo.operators import enrich as N
from docgeo.operators import filters as FL
from docgeo.operators import geocode as G
from docgeo.operators import language as L
from docgeo.operators import metadata as M
from docgeo.operators import scan as S
from docgeo.operators import whitelist as W
from docgeo.plans.fixtures import DEFAULT_REMOVAL_RULES
from docgeo.session import written


@dataclass
class Inputs:
    docs: DataFrame  # doc_id, text[, file_name]
    lexicon: DataFrame  # lang, surface, lemma, entity_type
    cache: DataFrame  # location cache (16 columns)
    gazetteer: DataFrame | None = None  # resolver table with the cache's columns
    profile: DataFrame | None = None  # word, lang; None = use the documents' own ``lang`` column
    rules: Sequence[tuple[str, str]] | DataFrame = field(default_factory=lambda: list(DEFAULT_REMOVAL_RULES))
    blacklist: DataFrame | None = None  # location[, lat, lon]
    boundaries: DataFrame | None = None  # poly_id, country, continent, rings
    threshold: float = L.THRESHOLD
    default_language: str = L.DEFAULT_LANGUAGE
    tags: Sequence[str] = E.PLACE_TAGS
    resolver: object = None
    prefix: str | None = None  # directory that file names are relative to
    hits: DataFrame | None = None  # what a scan of the texts found (see ``scanned``)


def languages(inp: Inputs) -> DataFrame:
    """(doc_id, code, model_rank) per document: detected mixed languages, or the given ``lang`` column."""
    if inp.profile is None:
        return L.given_language(inp.docs)
    supported = inp.lexicon.select("lang")
    return L.relevant_languages(inp.docs, detected(inp), supported, inp.threshold, inp.default_language)


def scanned(inp: Inputs) -> Inputs:
    """The inputs with what a single scan of the texts finds, languages and names, written down (hits only): neither the
    choice of languages nor anything after it reads the texts again."""
    if inp.hits is not None:
        return inp
    return replace(inp, hits=written(S.packed_hits(inp.docs, inp.lexicon, inp.profile), "hits"))


def detected(inp: Inputs) -> DataFrame:
    """(doc_id, code, proportion, rank) of every document; its own ``lang`` alone if there is no profile."""
    if inp.profile is None:
        return L.given_language(inp.docs).select("doc_id", "code", F.lit(1.0).alias("proportion"), F.col("model_rank").alias("rank"))
    return L.proportions(S.profile_counts(inp.hits)) if inp.hits is not None else L.detect_languages(inp.docs, inp.profile)


def candidates(inp: Inputs) -> DataFrame:
    """Lexicon hits in each document's languages."""
    inp = scanned(inp)
    return S.candidates(inp.hits, languages(inp))


def consolidated(inp: Inputs, max_n: int | None = None) -> DataFrame:
    """Leftmost-longest lexicon hits of every document and model."""
    if max_n is None:
        max_n = E.longest_entry(inp.lexicon)
    return E.consolidate(candidates(inp), max_n)


def combined(inp: Inputs, max_n: int | None = None) -> DataFrame:
    """Consolidated, tag-filtered mentions of all models; they lie together by document since the hits met their languages."""
    return E.combine_models(E.keep_tags(consolidated(inp, max_n), inp.tags))


def mentions(inp: Inputs, max_n: int | None = None) -> DataFrame:
    """Consolidated, tag-filtered, model-combined, cleaned mentions."""
    return E.clean_names(combined(inp, max_n))


def doc_locations(inp: Inputs) -> DataFrame:
    return E.name_frequencies(mentions(inp))


def lookup_names(inp: Inputs) -> DataFrame:
    """``doc_locations`` without braces: what is looked up."""
    return E.name_frequencies(G.without_braces(mentions(inp)))


def geocoded(inp: Inputs, locate: bool = False) -> G.Geocoded:
    """Names with coordinates, the new cache, what is unresolved, and the new cache rows; with ``locate`` also country and
    continent, once per name (known names of a located cache need no lookup)."""
    place = (lambda rows: N.enrich(rows, inp.boundaries)) if locate and inp.boundaries is not None else None
    return G.geocode(lookup_names(inp), inp.cache, inp.gazetteer, inp.resolver, place, stripped=True)


def scored(inp: Inputs, geo: G.Geocoded | None = None) -> DataFrame:
    """doc_geo after the class/type filter, with centroid, distance and confidence."""
    doc_geo = FL.remove_classes((geo or geocoded(inp)).doc_geo, inp.rules)
    return C.cluster_confidence(doc_geo)


def enriched(inp: Inputs, geo: G.Geocoded | None = None) -> DataFrame:
    """Scored doc_geo after the blacklist, with file name, country and continent."""
    doc_geo = scored(inp, geo or geocoded(inp, locate=True))
    if inp.blacklist is not None:
        doc_geo = FL.remove_blacklisted(doc_geo, inp.blacklist)
    if "file_name" in inp.docs.columns:
        doc_geo = N.attach_file_names(doc_geo, inp.docs, inp.prefix)
    if "country" in doc_geo.columns:
        return doc_geo
    if inp.boundaries is not None:
        return N.enrich(doc_geo, inp.boundaries)
    return doc_geo.withColumn("country", F.lit(None).cast("string")).withColumn("continent", F.lit(None).cast("string"))


def whitelist_ledger(inp: Inputs, seq: int = 0, geo: G.Geocoded | None = None) -> DataFrame:
    return W.build_whitelist(enriched(inp, geo), seq)


def run_whitelist(inp: Inputs, mode: str = "name", earlier: DataFrame | None = None) -> DataFrame:
    """Entry point A: the condensed whitelist (optionally appended to an earlier uncondensed ledger)."""
    if earlier is not None:
        ledger = W.append(whitelist_ledger(inp, seq=1), earlier)
    else:
        ledger = whitelist_ledger(inp)
    return W.condense(ledger, mode)


def run_metadata(docs: DataFrame, patterns: Mapping[str, Sequence[str]] = M.DEFAULT_PATTERNS) -> DataFrame:
    """Entry point B: regex metadata per document."""
    return M.extract_metadata(docs, patterns)


# ---------------------------------------------------------------- sample accessors


def coordinates_of(doc_geo: DataFrame, doc_id: int) -> DataFrame:
    return doc_geo.where(F.col("doc_id") == doc_id)


def text_preview(docs: DataFrame, n_chars: int = 1000) -> DataFrame:
    return docs.select("doc_id", F.substring("text", 1, n_chars).alias("preview"))


def languages_of(doc_language: DataFrame, doc_id: int) -> DataFrame:
    return doc_language.where(F.col("doc_id") == doc_id)


def metadata_of(doc_meta: DataFrame, doc_id: int) -> DataFrame:
    return doc_meta.where(F.col("doc_id") == doc_id)


def field_of_all(doc_meta: DataFrame, name: str) -> DataFrame:
    return doc_meta.select("doc_id", name)
