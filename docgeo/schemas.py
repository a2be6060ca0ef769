"""Declared schemas of the tables the workflow passes between its steps."""

from pyspark.sql import types as T

DOCUMENTS_COLUMNS = ["doc_id", "file_name", "text"]

DOC_LANGUAGE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("code", T.StringType()),
        T.StructField("proportion", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]
)

MENTION_COLUMNS = ["doc_id", "model_rank", "pos", "len", "token", "lemma", "entity_type"]

DOC_LOCATION_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("location", T.StringType()),
        T.StructField("frequency", T.LongType()),
    ]
)

# Geocoder result columns of the location cache, in the order the workflow declares them.
LOCATION_CACHE_SCHEMA = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat_min", T.DoubleType()),
        T.StructField("lat_max", T.DoubleType()),
        T.StructField("lon_min", T.DoubleType()),
        T.StructField("lon_max", T.DoubleType()),
        T.StructField("place_id", T.StringType()),
        T.StructField("osm_type", T.StringType()),
        T.StructField("osm_id", T.StringType()),
        T.StructField("place_rank", T.IntegerType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("icon", T.StringType()),
    ]
)
LOCATION_CACHE_COLUMNS = [f.name for f in LOCATION_CACHE_SCHEMA.fields]

# What a cache may hold besides: where a place lies, looked up once per name.
PLACE_COLUMNS = ["country", "continent"]
LOCATED_CACHE_SCHEMA = T.StructType([*LOCATION_CACHE_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in PLACE_COLUMNS]])

DOC_GEO_COLUMNS = ["doc_id", "query", "frequency", "lat", "lon", "class", "type", "importance"]

BLACKLIST_SCHEMA = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

REMOVAL_RULES_SCHEMA = T.StructType([T.StructField("class", T.StringType()), T.StructField("type", T.StringType())])

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
BOUNDARY_SCHEMA = T.StructType(
    [
        T.StructField("poly_id", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("rings", T.ArrayType(T.ArrayType(POINT))),
    ]
)

WHITELIST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("frequency", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("class", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("importance", T.DoubleType()),
        T.StructField("country", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)
WHITELIST_COLUMNS = [f.name for f in WHITELIST_SCHEMA.fields]

DOC_META_COLUMNS = ["doc_id", "grade", "funding_volume", "date"]
