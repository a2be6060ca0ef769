"""Corpus readers: a folder of files (one text per file) or a table of texts."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgeo.functions.text import file_id
from docgeo.session import cut_lineage, ship_package

IDS_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("doc_id", T.LongType())])
STATUS = ("ok", "failed", "too large")

# A file beyond this is not handed to an extractor (a row of Spark holds less than 2 GB).
MAX_BYTES = 1 << 30


def path_id(path: Column, attempt: int = 0) -> Column:
    """Id of a path: 63 bits of a hash, the same in every run and partitioning; another one for each attempt."""
    return F.xxhash64(*([path] if attempt == 0 else [path, F.lit(attempt)])).bitwiseAND(F.lit((1 << 63) - 1))


def exceptional_ids(paths: DataFrame, known: DataFrame | None = None, id_of: Callable[[Column, int], Column] = path_id) -> DataFrame:
    """(path, doc_id) of the paths whose id is not the plain ``path_id``, so that no two paths share one.

    Of paths that want the same id the smallest gets it, and the others try again. ``known`` (path, doc_id): ids that were
    given before; they stay, and none is given to another path. Only ids are grouped; the result is as long as there are
    collisions (none, usually) and changed ids among the known.
    """
    spark = paths.sparkSession
    paths = paths.select("path").distinct()
    none = spark.createDataFrame([], IDS_SCHEMA)
    known = none if known is None else known.select("path", "doc_id")
    given = known.where(F.col("doc_id") != id_of(F.col("path"), 0))
    todo, taken, attempt = paths.join(known, "path", "left_anti"), known.select("doc_id"), 0
    while True:
        wants = todo.withColumn("doc_id", id_of(F.col("path"), attempt))
        first = wants.groupBy("doc_id").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n"))
        free = first.join(taken, "doc_id", "left_anti").select("path", "doc_id")
        todo = cut_lineage(wants.join(first.where("n > 1").select("doc_id").unionByName(taken).distinct(), "doc_id", "left_semi").select("path").join(free, "path", "left_anti"))
        if attempt:
            given = given.unionByName(free)
        if todo.isEmpty():
            return cut_lineage(given)
        # few paths are left: ids of the others as they stand
        taken, attempt = cut_lineage(taken.unionByName(free.select("doc_id"))), attempt + 1


def with_ids(files: DataFrame, listing: DataFrame, prefix: str | None, known: DataFrame | None = None, id_of: Callable[[Column, int], Column] = path_id) -> DataFrame:
    """``files`` with ``doc_id`` and ``file_name`` from their ``path``. ``listing`` (path) is read for collisions, not the files."""
    changed = exceptional_ids(listing, known, id_of).withColumnRenamed("doc_id", "_id")
    rest = [c for c in files.columns if c != "path"]
    # as long as there are collisions, so small; Catalyst sees its size, as it is written
    return files.join(changed, "path", "left").select(
        F.coalesce("_id", id_of(F.col("path"), 0)).alias("doc_id"), file_id(F.col("path"), prefix).alias("file_name"), *rest
    )


def _listing(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def known_ids(spark: SparkSession, path: str, glob: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """(path, doc_id) of the files under ``path`` and of the known ones: to be kept and given to the next run's reader, so
    that a file has the same id whatever files come later."""
    listing = _listing(spark, path, glob).select("path")
    changed = exceptional_ids(listing, known).withColumnRenamed("doc_id", "_id")
    new = listing.join(changed, "path", "left").select("path", F.coalesce("_id", path_id(F.col("path"))).alias("doc_id"))
    return new if known is None else known.select("path", "doc_id").unionByName(new.join(known, "path", "left_anti"))


def read_text_files(spark: SparkSession, path: str, prefix: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """One row per file (doc_id, file_name, text): each file read whole; ``file_name`` is the path with the
    directory prefix removed (or the last path segment). No two files share a ``doc_id``; ``known``: see ``known_ids``."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return with_ids(raw, _listing(spark, path, None).select(F.col("_metadata.file_path").alias("path")), prefix, known)


def extract_files(
    spark: SparkSession,
    path: str,
    extractor: Callable[[bytes], str],
    prefix: str | None = None,
    glob: str | None = None,
    max_bytes: int = MAX_BYTES,
    known: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, file_name, text, status, error) for every file, for formats that need a parser (PDF, office).

    ``extractor(bytes) -> text`` runs file by file on the executors. A file that makes it raise, or return something else
    than text, has the status ``failed`` and the error's message, and no other file is touched by it; one of more than
    ``max_bytes`` is ``too large`` and never read; the others are ``ok``. Files of no bytes are no rows: Spark skips them.
    """
    ship_package(spark)
    files = _listing(spark, path, glob)

    def one(content: bytes) -> tuple[str | None, str, str | None]:
        try:
            text = extractor(bytes(content))
            if not isinstance(text, str):
                raise TypeError(f"the extractor returned {type(text).__name__}, not text")
            return text.encode("utf-8", "replace").decode(), "ok", None
        except Exception as e:  # noqa: BLE001 - whatever a parser raises concerns its file alone
            return None, "failed", f"{type(e).__name__}: {e}"[:1000]

    def run(batches):
        for pdf in batches:
            found = [one(b) for b in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], **{c: pd.Series([f[i] for f in found], dtype=object) for i, c in enumerate(("text", "status", "error"))}})

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("path", "text", "status", "error")])
    read = files.where(F.col("length") <= max_bytes).select("path", "content").mapInPandas(run, schema)
    nothing = F.lit(None).cast("string")
    large = files.where(F.col("length") > max_bytes).select(
        "path", nothing.alias("text"), F.lit("too large").alias("status"), F.concat(F.col("length").cast("string"), F.lit(" bytes")).alias("error")
    )
    return with_ids(read.unionByName(large), files.select("path"), prefix, known)


def read_binary_files(
    spark: SparkSession,
    path: str,
    extractor: Callable[[bytes], str],
    prefix: str | None = None,
    glob: str | None = None,
    quarantine: str | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, file_name, text) of the files that the extractor could read.

    With ``quarantine`` the others are written there (doc_id, file_name, status, error), and files are extracted once: the
    texts are written down before they are returned.
    """
    found = extract_files(spark, path, extractor, prefix, glob, known=known)
    if quarantine is not None:
        found = cut_lineage(found)
        found.where("status != 'ok'").drop("text").write.mode("append").parquet(quarantine)
    return found.where("status = 'ok'").select("doc_id", "file_name", "text")


def dealt_out(table: DataFrame) -> DataFrame:
    """``table`` (a plain scan) as it is if it has a split for every core at least, else its rows dealt to as many tasks.

    A file of one row group, or one compressed as a whole, is one split however large it is, and per-row work on texts
    would run on one core. Tables of many splits, all large ones, are never shuffled.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)


def read_text_table(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", name_col: str | None = None) -> DataFrame:
    """A parquet table of texts in the corpus schema."""
    t = spark.read.parquet(path)
    name = F.col(name_col) if name_col else F.lit(None).cast("string")
    extra = [c for c in ("lang",) if c in t.columns]
    return t.select(F.col(id_col).cast("long").alias("doc_id"), name.alias("file_name"), F.col(text_col).alias("text"), *extra)


def file_ids(df: DataFrame, path_col: str, prefix: str | None = None) -> DataFrame:
    """``file_name`` column derived from a path/URL column."""
    return df.withColumn("file_name", file_id(F.col(path_col), prefix))
