"""Named queries over the driver's tables: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query runs the library's operators over the whole tables (plus fixture tables derived from them).
Computed doubles are rounded to 6 decimals so that an independent SQL engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgeo.functions.text import file_id
from docgeo.operators import confidence as C
from docgeo.operators import entities as E
from docgeo.operators import enrich as N
from docgeo.operators import filters as FL
from docgeo.operators import geocode as G
from docgeo.operators import language as L
from docgeo.operators import metadata as M
from docgeo.operators import whitelist as W
from docgeo.plans import pipeline as P
from docgeo.plans.fixtures import DEFAULT_REMOVAL_RULES, IMPORT_DIR, Fixtures
from docgeo.session import new_table_path
from docgeo.streaming.state import CorpusState

# Custom metadata fields for the user-extension path (patterns that occur in the driver's raw texts).
CUSTOM_PATTERNS = {
    "ip_address": [r"\d{1,3}(\.\d{1,3}){3}"],
    "card_number": [r"\d{16}"],
    "api_token": [r'token = "[0-9a-f]+"'],
}

TOP_N = 3

# The document that the single-document accessors show.
SHOWN_DOCUMENT = 7


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def _inputs(fx: Fixtures, **kw) -> P.Inputs:
    base = dict(
        docs=fx.corpus(),
        lexicon=fx.lexicon(),
        cache=fx.starting_cache(),
        gazetteer=fx.gazetteer(),
        profile=fx.language_profile(),
        rules=list(DEFAULT_REMOVAL_RULES),
        blacklist=fx.blacklist(),
        boundaries=fx.boundaries(),
    )
    base.update(kw)
    return P.Inputs(**base)


def _conversation_inputs(fx: Fixtures) -> P.Inputs:
    # Cantor's pairing: one number for each (conversation, turn)
    conv = fx.table("conversations").select(
        F.expr("((conv_id + turn) * (conv_id + turn + 1)) div 2 + turn").alias("doc_id"),
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("file_name"),
        "text",
    )
    return _inputs(fx, docs=conv)


# ---------------------------------------------------------------- languages


def q_language_proportions(spark, d):
    fx = Fixtures(spark, d)
    return L.detect_languages(fx.corpus(), fx.language_profile()).select("doc_id", "code", r6("proportion"), "rank")


def q_relevant_languages(spark, d):
    return P.languages(_inputs(Fixtures(spark, d)))


def q_language_default(spark, d):
    return P.languages(_inputs(Fixtures(spark, d), threshold=0.5))


def q_given_language(spark, d):
    return P.languages(_inputs(Fixtures(spark, d), profile=None))


# ---------------------------------------------------------------- extraction


def q_consolidated_entities(spark, d):
    return P.consolidated(_inputs(Fixtures(spark, d)))


def q_combined_models(spark, d):
    fx = Fixtures(spark, d)
    docs = fx.bilingual_documents().withColumn("file_name", F.lit(None).cast("string"))
    inp = _inputs(fx, docs=docs, lexicon=fx.multilingual_lexicon())
    return P.combined(inp).select("doc_id", "model_rank", "pos", "len", "token", "lemma", "entity_type")


def q_clean_names(spark, d):
    return P.mentions(_inputs(Fixtures(spark, d))).select("doc_id", "model_rank", "pos", "token", "lemma", "entity_type")


def q_name_frequencies(spark, d):
    return P.doc_locations(_inputs(Fixtures(spark, d)))


def q_top_names_per_doc(spark, d):
    return E.top_names(P.doc_locations(_inputs(Fixtures(spark, d))), TOP_N)


# ---------------------------------------------------------------- geocoding


def _names(inp):
    return P.lookup_names(inp)


def q_cache_hits(spark, d):
    inp = _inputs(Fixtures(spark, d))
    return G.cache_hits(_names(inp), inp.cache)


def q_cache_misses(spark, d):
    inp = _inputs(Fixtures(spark, d))
    return G.cache_misses(_names(inp), inp.cache)


def q_resolved_names(spark, d):
    inp = _inputs(Fixtures(spark, d))
    return G.resolve_offline(G.cache_misses(_names(inp), inp.cache), inp.gazetteer)


def q_updated_cache(spark, d):
    return P.geocoded(_inputs(Fixtures(spark, d))).new_cache


def q_doc_coordinates(spark, d):
    return P.geocoded(_inputs(Fixtures(spark, d))).doc_geo


def q_unresolved_names(spark, d):
    return P.geocoded(_inputs(Fixtures(spark, d))).unresolved


# ---------------------------------------------------------------- class/type filter


def q_class_type_filter(spark, d):
    inp = _inputs(Fixtures(spark, d))
    return FL.remove_classes(P.geocoded(inp).doc_geo, list(DEFAULT_REMOVAL_RULES))


def q_class_type_filter_custom(spark, d):
    fx = Fixtures(spark, d)
    inp = _inputs(fx)
    return FL.remove_classes(P.geocoded(inp).doc_geo, fx.removal_rules(custom=True))


# ---------------------------------------------------------------- confidence


def q_centroid_distance(spark, d):
    inp = _inputs(Fixtures(spark, d))
    g = FL.remove_classes(P.geocoded(inp).doc_geo, inp.rules)
    return C.centroid_distance(g).select(*g.columns, r6("c_lat"), r6("c_lon"), "distance_km")


def q_confidence(spark, d):
    s = P.scored(_inputs(Fixtures(spark, d)))
    return s.select("doc_id", "query", "frequency", "lat", "lon", "class", "type", "importance", "distance_km", "confidence")


# ---------------------------------------------------------------- blacklist (B1-B2)


def q_blacklist_filter(spark, d):
    inp = _inputs(Fixtures(spark, d))
    s = FL.remove_blacklisted(P.scored(inp), inp.blacklist)
    return s.select("doc_id", "query", "frequency", "lat", "lon", "class", "type", "importance", "confidence")


def q_blacklist_report(spark, d):
    inp = _inputs(Fixtures(spark, d))
    return FL.blacklist_report(FL.remove_classes(P.geocoded(inp).doc_geo, inp.rules), inp.blacklist, inp.docs)


# ---------------------------------------------------------------- enrichment


def q_point_country(spark, d):
    fx = Fixtures(spark, d)
    return N.locate_points(fx.gazetteer(), fx.boundaries())


def q_enriched_locations(spark, d):
    fx = Fixtures(spark, d)
    e = P.enriched(_inputs(fx, docs=fx.filed_corpus(), prefix=IMPORT_DIR))
    return e.select(
        "doc_id", "query", "frequency", "lat", "lon", "class", "type", "importance", "confidence", "country",
        "continent", "file_name",
    )


# ---------------------------------------------------------------- whitelist


def _wl(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c) if c in ("importance", "confidence") else F.col(c) for c in W.WHITELIST_COLUMNS])


def q_whitelist_full(spark, d):
    return _wl(P.whitelist_ledger(_inputs(Fixtures(spark, d))))


def q_whitelist_by_name(spark, d):
    return _wl(P.run_whitelist(_inputs(Fixtures(spark, d)), "name"))


def q_whitelist_by_coords(spark, d):
    return _wl(P.run_whitelist(_inputs(Fixtures(spark, d)), "coords"))


def q_whitelist_head(spark, d):
    return W.head(q_whitelist_by_name(spark, d), 6)


def q_whitelist_appended(spark, d):
    fx = Fixtures(spark, d)
    earlier = P.whitelist_ledger(_conversation_inputs(fx), seq=0)
    return _wl(P.run_whitelist(_inputs(fx), "name", earlier=earlier))


# ---------------------------------------------------------------- metadata and accessors


def q_metadata_reference_patterns(spark, d):
    return M.extract_metadata(Fixtures(spark, d).report_documents(), M.DEFAULT_PATTERNS)


def q_metadata_custom_patterns(spark, d):
    return M.extract_metadata(Fixtures(spark, d).documents(), CUSTOM_PATTERNS)


def q_metadata_raw_text(spark, d):
    return M.extract_metadata(Fixtures(spark, d).documents(), M.DEFAULT_PATTERNS)


def q_text_preview(spark, d):
    return P.text_preview(Fixtures(spark, d).documents())


def q_all_grades(spark, d):
    return P.field_of_all(M.extract_metadata(Fixtures(spark, d).report_documents()), "grade")


_STATES: dict[tuple[str, str], str] = {}


def _results(spark, d) -> CorpusState:
    """The workflow's results by document, as incremental runs keep them: written once per session and input folder."""
    key = (spark.sparkContext.applicationId, d)
    state = CorpusState(spark, _STATES.get(key) or new_table_path(spark, "results"))
    if key not in _STATES:
        inp = P.scanned(_inputs(Fixtures(spark, d)))
        geo = P.geocoded(inp, locate=True)
        state.upsert(inp.docs, P.whitelist_ledger(inp, geo=geo), geo.doc_geo, P.detected(inp))
        _STATES[key] = state.log.root
    return state


def q_coordinates_of_document(spark, d):
    return _results(spark, d).of_document("coordinates", SHOWN_DOCUMENT)


def q_languages_of_document(spark, d):
    return _results(spark, d).of_document("languages", SHOWN_DOCUMENT).select("doc_id", "code", r6("proportion"), "rank")


def q_metadata_of_document(spark, d):
    return P.metadata_of(q_metadata_reference_patterns(spark, d), SHOWN_DOCUMENT)


def q_file_ids(spark, d):
    pages = Fixtures(spark, d).table("pages")
    return pages.select(F.col("page_id").alias("doc_id"), file_id(F.col("url")).alias("file_name"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "language_proportions": q_language_proportions,
    "relevant_languages": q_relevant_languages,
    "language_default": q_language_default,
    "given_language": q_given_language,
    "consolidated_entities": q_consolidated_entities,
    "combined_models": q_combined_models,
    "clean_names": q_clean_names,
    "name_frequencies": q_name_frequencies,
    "top_names_per_doc": q_top_names_per_doc,
    "cache_hits": q_cache_hits,
    "cache_misses": q_cache_misses,
    "resolved_names": q_resolved_names,
    "updated_cache": q_updated_cache,
    "doc_coordinates": q_doc_coordinates,
    "unresolved_names": q_unresolved_names,
    "class_type_filter": q_class_type_filter,
    "class_type_filter_custom": q_class_type_filter_custom,
    "centroid_distance": q_centroid_distance,
    "confidence": q_confidence,
    "blacklist_filter": q_blacklist_filter,
    "blacklist_report": q_blacklist_report,
    "point_country": q_point_country,
    "enriched_locations": q_enriched_locations,
    "whitelist_full": q_whitelist_full,
    "whitelist_by_name": q_whitelist_by_name,
    "whitelist_by_coords": q_whitelist_by_coords,
    "whitelist_head": q_whitelist_head,
    "whitelist_appended": q_whitelist_appended,
    "metadata_reference_patterns": q_metadata_reference_patterns,
    "metadata_custom_patterns": q_metadata_custom_patterns,
    "metadata_raw_text": q_metadata_raw_text,
    "text_preview": q_text_preview,
    "all_grades": q_all_grades,
    "coordinates_of_document": q_coordinates_of_document,
    "languages_of_document": q_languages_of_document,
    "metadata_of_document": q_metadata_of_document,
    "file_ids": q_file_ids,
}
