"""Dimension tables the workflow needs but the driver's tables lack, derived from those tables by expression.

The reference ships no lexicon, gazetteer, blacklist, boundaries or language profile, so these stand-in inputs are
built from ``documents``, ``nation`` and ``region`` (FIXTURES.md). They only provide rows of the expected schema;
all work of a query (tagging, geocoding, scoring, ...) runs in the library's operators on them. The same
derivations are written in DuckDB SQL in ``sqlcheck/oracle.py`` for the oracle.

Derived tables are written once per session and input folder under the checkpoint root, the way they would sit
on shared storage in production, and read back from there.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgeo.session import checkpoint_root
from docgeo.sources.corpus import dealt_out

CANDIDATE_PATTERN = r"\p{Lu}\p{Ll}{3,}"
# In tokens joined by blanks: group 1 is a pair, the match its first letter alone, so that pairs may overlap.
PAIR_PATTERN = r"(?<![^ ])(?=(\p{Lu}\p{Ll}{3,} \p{Lu}\p{Ll}{3,})(?![^ ]))\p{Lu}"
LANGS = ["de", "en", "es", "fr"]

# Stop-word profile of the rule-based language detector (our own choice, about twenty frequent function words
# per language; words shared by languages are listed under each of them).
LANGUAGE_PROFILE = {
    "en": "the of and to a in is that it for was on with be by as this are at from",
    "de": "der die und in den von zu das mit sich auf des für ist nicht dem im ein eine als",
    "fr": "de la le et les des en un du une que pour est qui par dans sur au avec pas",
    "es": "de la que el en y los se del las por un no con su una es para al lo",
}

# The default class/type removal list of the workflow, in its order (the repeated tourism rule is
# dropped); "all" is the wildcard.
DEFAULT_REMOVAL_RULES = [
    ("shop", "all"),
    ("tourism", "all"),
    ("highway", "all"),
    ("amenity", "all"),
    ("landuse", "all"),
    ("office", "all"),
    ("waterway", "fuel"),
]
CUSTOM_REMOVAL_RULES = [("all", "river"), ("place", "city")]

# Folder that the paths of the fixture's documents start with.
IMPORT_DIR = "/data/files_to_be_imported"

# Hexagon offsets of the fixture country polygons (closed ring).
HEXAGON = [(0, 0), (50, 3), (66, 12), (40, 23), (12, 20), (3, 11), (0, 0)]

_TABLE_CACHE: dict[tuple[str, str, str], str] = {}


def h(c: str | Column, o: int, n: int) -> Column:
    """Deterministic hash slice: 7 hex digits of md5 from position ``o``, modulo ``n``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(c), o, 7), 16, 10).cast("bigint") % F.lit(n)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _materialize(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _TABLE_CACHE.get(key)
    if path is None:
        tag = hashlib.md5(f"{spark.sparkContext.applicationId}|{sf_dir}".encode()).hexdigest()[:10]
        path = f"{checkpoint_root(spark).rstrip('/')}/fixtures-{tag}/{name}"
        build().write.mode("overwrite").parquet(path)
        _TABLE_CACHE[key] = path
    return spark.read.parquet(path)


# ---------------------------------------------------------------- derived from documents


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, w) for every capitalised word of four or more letters."""
    return docs.select("doc_id", "lang", F.explode(F.regexp_extract_all("text", F.lit(CANDIDATE_PATTERN), 0)).alias("w"))


def adjacent_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, w) for every two adjacent word tokens that are both capitalised candidates."""
    toks = F.array_join(F.regexp_extract_all("text", F.lit(r"\p{L}+"), 0), " ")
    return docs.select("doc_id", "lang", F.explode(F.regexp_extract_all(toks, F.lit(PAIR_PATTERN), 1)).alias("w"))


def _names(docs: DataFrame) -> DataFrame:
    """(n_tokens, w, lang): words and pairs found in two documents at least, with every language they are found in.

    What travels is one row per name, language and task, whatever the number of documents: two of them are told by the
    smallest and the largest id.
    """
    found = candidates(docs).withColumn("n_tokens", F.lit(1)).unionByName(adjacent_pairs(docs).withColumn("n_tokens", F.lit(2)))
    span = [F.min("low").alias("low"), F.max("high").alias("high")]
    by_lang = found.groupBy("n_tokens", "w", "lang").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    names = by_lang.groupBy("n_tokens", "w").agg(*span, F.collect_list(F.struct("lang")).alias("langs"))
    return names.where("low < high").select("n_tokens", "w", F.explode("langs.lang").alias("lang"))


def _lexicon(names: DataFrame) -> DataFrame:
    s = F.col("surface")
    variant = h(s, 12, 20)
    lemma = (
        F.when(variant == 0, F.concat(F.lit(" "), s, F.lit("  ")))
        .when(variant == 1, F.concat(F.substring(s, 1, 2), F.lit("_"), F.expr("substring(surface, 3)")))
        .when(variant == 2, F.concat(s, F.lit("\nNord")))
        .when(variant == 3, F.substring(s, 1, 1))
        .when(variant == 4, F.concat(s, F.lit("   Sud")))
        .when(variant == 5, F.concat(F.lit("{"), s, F.lit("}")))
        .when(variant == 6, F.concat(F.lit("\t"), s))
        .otherwise(s)
    )
    etype = F.when(h(s, 10, 10) == 0, "PER").when(h(s, 14, 2) == 0, "LOC").otherwise("GPE")
    return names.withColumnRenamed("w", "surface").select("lang", "surface", lemma.alias("lemma"), etype.alias("entity_type"), "n_tokens")


def _multilingual_lexicon(lex: DataFrame) -> DataFrame:
    """Lexicon where one surface in three is listed for every language (exercises model combination)."""
    shared = (
        lex.where(h("surface", 5, 3) == 0)
        .select("surface", "lemma", "entity_type", "n_tokens")
        .distinct()
        .select(F.explode(F.array(*[F.lit(c) for c in LANGS])).alias("lang"), "surface", "lemma", "entity_type", "n_tokens")
    )
    return lex.unionByName(shared).dropDuplicates(["lang", "surface"])


def _gazetteer(names: DataFrame) -> DataFrame:
    w = F.col("w")
    grid = h(w, 22, 2) == 0
    lat = F.when(grid, (h(w, 1, 12) * 10 - 60).cast("double") + 0.37).otherwise(h(w, 1, 120000).cast("double") / 1000.0 - 60.0)
    lon = F.when(grid, (h(w, 8, 34) * 10 - 170).cast("double") + 0.41).otherwise(h(w, 8, 340000).cast("double") / 1000.0 - 170.0)
    klass = (
        F.when(h(w, 15, 8) == 0, "shop").when(h(w, 15, 8) == 1, "tourism").when(h(w, 15, 8) == 2, "highway")
        .when(h(w, 15, 8) == 3, "waterway").when(h(w, 15, 8) == 4, "boundary").when(h(w, 15, 8) == 5, "natural")
        .otherwise("place")
    )
    typ = F.when(h(w, 18, 4) == 0, "fuel").when(h(w, 18, 4) == 1, "city").when(h(w, 18, 4) == 2, "river").otherwise("village")
    importance = F.when(h(w, 2, 50) == 0, F.lit(None).cast("double")).otherwise(h(w, 11, 1000).cast("double") / 1000.0)
    base = (
        names.select("w").distinct()
        .where(h(w, 25, 10) < 9)
        .select(
            w.alias("query"), lat.alias("lat"), lon.alias("lon"), F.substring(F.md5(w), 1, 8).alias("place_id"),
            F.when(h(w, 3, 3) == 0, "node").when(h(w, 3, 3) == 1, "way").otherwise("relation").alias("osm_type"),
            h(w, 5, 100000000).cast("string").alias("osm_id"), h(w, 7, 30).cast("int").alias("place_rank"),
            klass.alias("class"), typ.alias("type"), importance.alias("importance"),
        )
    )
    second = base.where(h("query", 6, 20) == 0).select(
        "query", (F.col("lat") + 1.0).alias("lat"), (F.col("lon") + 1.0).alias("lon"),
        F.substring(F.md5(F.concat("query", F.lit("/2"))), 1, 8).alias("place_id"), "osm_type", "osm_id", "place_rank",
        "class", "type", (F.col("importance") / 2.0).alias("importance"),
    )
    return base.unionByName(second).select(
        "query", "lat", "lon",
        (F.col("lat") - 0.05).alias("lat_min"), (F.col("lat") + 0.05).alias("lat_max"),
        (F.col("lon") - 0.05).alias("lon_min"), (F.col("lon") + 0.05).alias("lon_max"),
        "place_id", "osm_type", "osm_id", "place_rank",
        F.concat(F.col("query"), F.lit(", "), F.col("class")).alias("display_name"),
        "class", "type", "importance", F.lit(None).cast("string").alias("icon"),
    )


def _report_documents(docs: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    grade = F.concat(F.lit("Note: "), (d % 6).cast("string"))
    rating = F.concat(F.lit("rating "), (d % 6).cast("string"))
    date = F.concat(F.lit(" Vertrag 0"), (d % 9 + 1).cast("string"), F.lit(".12.2019 "))
    amount = (d % 90 + 10).cast("string")
    v = d % 5
    line = (
        F.when(v == 0, F.concat(grade, date, amount, F.lit(",5 Mio. EUR")))
        .when(v == 1, F.concat(rating, date, F.lit("EUR "), amount, F.lit(",5 Mio.")))
        .when(v == 2, F.concat(F.lit("Stufe 3"), date, F.lit("Betrag DM 3,5 Mio.")))
        .when(v == 3, F.concat(F.lit("Grade: 2 am "), (d % 28 + 1).cast("string"), F.lit(".1.2020")))
        .otherwise(F.lit("ohne Angaben"))
    )
    return docs.select("doc_id", "lang", F.concat(F.col("text"), F.lit("\n"), line).alias("text"))


def _bilingual_documents(docs: DataFrame) -> DataFrame:
    a = docs.select("doc_id", "lang", F.col("text").alias("a_text"))
    b = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("b_text"))
    # every document with the next one's text after its own; the last has none
    return a.join(b, "doc_id", "left").select("doc_id", "lang", F.concat_ws("\n", "a_text", "b_text").alias("text"))


# ---------------------------------------------------------------- public accessors


class Fixtures:
    """Fixture tables for one input folder (``sf_dir``) of the driver's parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def documents(self) -> DataFrame:
        return dealt_out(self.table("documents"))

    def corpus(self) -> DataFrame:
        """The corpus in the workflow's document schema; ``file_name`` is absent, so ids are the doc_id text."""
        return self.documents().select("doc_id", "lang", "text", F.lit(None).cast("string").alias("file_name"))

    def filed_corpus(self) -> DataFrame:
        """The corpus with a path for each document, as a folder reader gives them: source as directory."""
        path = F.concat(F.lit(f"{IMPORT_DIR}/"), F.col("source"), F.lit("/report "), F.col("doc_id").cast("string"), F.lit(".txt"))
        return self.documents().select("doc_id", "lang", "text", path.alias("file_name"))

    def names(self) -> DataFrame:
        """Names found in two documents at least, by language: the texts are read once for all tables derived from them."""
        return _materialize(self.spark, self.sf_dir, "names", lambda: _names(self.documents()))

    def lexicon(self) -> DataFrame:
        return _materialize(self.spark, self.sf_dir, "lexicon", lambda: _lexicon(self.names()))

    def multilingual_lexicon(self) -> DataFrame:
        return _materialize(self.spark, self.sf_dir, "lexicon_multi", lambda: _multilingual_lexicon(self.lexicon()))

    def gazetteer(self) -> DataFrame:
        return _materialize(self.spark, self.sf_dir, "gazetteer", lambda: _gazetteer(self.names()))

    def starting_cache(self) -> DataFrame:
        return self.gazetteer().where(h("query", 4, 2) == 0)

    def blacklist(self) -> DataFrame:
        return (
            self.gazetteer().where(h("query", 9, 15) == 0).select(F.col("query").alias("location")).distinct()
            .select("location", F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
        )

    def removal_rules(self, custom: bool = False) -> DataFrame:
        rows = CUSTOM_REMOVAL_RULES if custom else DEFAULT_REMOVAL_RULES
        return self.spark.createDataFrame(rows, "class string, type string")

    def language_profile(self) -> DataFrame:
        rows = [(w, lang) for lang, words in LANGUAGE_PROFILE.items() for w in words.split()]
        return self.spark.createDataFrame(rows, "word string, lang string")

    def boundaries(self) -> DataFrame:
        n = self.table("nation")
        r = self.table("region")
        ox = ((F.col("n_nationkey") % 5) * 68 - 170).cast("double")
        oy = (F.floor(F.col("n_nationkey") / 5) * 24 - 60).cast("double")
        ring = F.array(*[F.struct((ox + dx).alias("x"), (oy + dy).alias("y")) for dx, dy in HEXAGON])
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").cast("int").alias("poly_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("continent"),
            F.array(ring).alias("rings"),
        )

    def report_documents(self) -> DataFrame:
        return _report_documents(self.documents())

    def bilingual_documents(self) -> DataFrame:
        return _bilingual_documents(self.documents())

