"""Helpers shared by the operators: table readers, intermediate tables in the shared folder, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docgeo.session import new_table_path, ship_package

# A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"

# Bytes of an Arrow batch that goes to a Python worker, unless the session sets its own: long texts make large batches.
BATCH_BYTES = 8 << 20
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

# Rows that leave a Python worker at once, by bytes of text: bounds a worker's memory whatever the text lengths.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it again.

    Cuts the lineage with files that outlive any executor; columns are still pruned when the table is read.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package at hand on the workers and batches of bounded size."""
    ship_package(df.sparkSession)
    if df.sparkSession.conf.get(_BATCH_CONF, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        df.sparkSession.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` whose ``column`` holds about ``limit`` bytes (one row at least)."""
    lengths = batch.column(batch.schema.get_field_index(column))
    start, size = 0, 0
    for i, v in enumerate(pc.binary_length(lengths).to_pylist()):
        if i > start and size + (v or 0) > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += v or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def count_chars(text: Column | str, inside: str) -> Column:
    """Characters of ``text`` in the class ``[inside]``: what is left without the runs of others (no list of matches)."""
    return F.length(F.regexp_replace(text, f"[^{inside}]+", ""))


def uniform_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values only (not on partitions or runs)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def cells(rows: DataFrame, key: list[str], item: str, limit: int, name: str) -> DataFrame:
    """Cut the groups of ``key`` into cells of at most about ``2 * limit`` rows that together hold every pair of a group.

    A group of more than ``limit`` rows is split into shards by a hash of ``item``; shard ``low`` and shard ``high`` meet in
    cell ``(low, high)``. Adds ``low, high, side``: 0 for rows of shard low, 1 for those of shard high, 2 where both are one.
    """
    crowded = written(
        rows.groupBy(*key).count().filter(F.col("count") > limit).select(*key, F.ceil(F.col("count") / limit).cast("int").alias("shards")), name
    )
    shards = F.coalesce("shards", F.lit(1))
    split = rows.join(crowded, key, "left").withColumns({"shards": shards, "own": F.pmod(F.xxhash64(item), shards).cast("int")})
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return split.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other"), "side": side}).drop("shards", "own", "other")
