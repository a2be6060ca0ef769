"""Tables kept as a log: immutable deltas, and numbered manifests that say which of them make up the table.

    root/manifests/m-000000012/      one line of JSON, complete once its _SUCCESS is there
    root/<part>/delta=7/bucket=3/    rows of one write, dealt to buckets by a hash of the part's key

A write adds its deltas and then a manifest; the newest complete manifest is the table, so readers see all of a write or
nothing, there is no pointer to lose, and a failed write leaves files that no manifest lists. Several parts (tables) share
the manifests and change together. A write from a numbered batch is applied once, however often it is replayed. One writer
at a time: two that commit the same manifest number collide, and the second fails.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64


@dataclass(frozen=True)
class Manifest:
    number: int = -1
    deltas: tuple[int, ...] = ()
    applied: Mapping[str, int] = field(default_factory=dict)  # last batch of each source
    unique: bool = True  # no key of a part that has one row per key is in two deltas
    buckets: int | None = None  # in how many the table is laid out, from its first write on


@dataclass(frozen=True)
class Part:
    schema: T.StructType
    key: tuple[str, ...]


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str, pattern: str) -> dict[int, bool]:
    """Numbers in the names under ``path`` that match ``pattern``, and whether each directory was written completely."""
    p, fs = _files(spark, path)
    if not fs.exists(p):
        return {}
    found = {}
    for status in fs.listStatus(p):
        if m := re.fullmatch(pattern, status.getPath().getName()):
            found[int(m[1])] = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    return found


class LogTable:
    def __init__(self, spark: SparkSession, root: str, parts: Mapping[str, Part], buckets: int = BUCKETS):
        """``buckets``: for a table that is not there yet; others keep their own."""
        self.spark, self.root, self.parts = spark, root.rstrip("/"), dict(parts)
        self.buckets = self.manifest().buckets or buckets

    # ------------------------------------------------------------ manifests

    def manifest(self) -> Manifest:
        """The newest complete manifest, or an empty one."""
        numbers = [n for n, complete in listed(self.spark, f"{self.root}/manifests", r"m-(\d+)").items() if complete]
        if not numbers:
            return Manifest()
        n = max(numbers)
        text = json.loads(self.spark.read.text(f"{self.root}/manifests/m-{n:09d}").first()[0])
        return Manifest(n, tuple(text["deltas"]), text["applied"], text["unique"], text["buckets"])

    def exists(self) -> bool:
        return self.manifest().number >= 0

    def _commit(self, m: Manifest) -> Manifest:
        text = json.dumps({"deltas": list(m.deltas), "applied": dict(m.applied), "unique": m.unique, "buckets": m.buckets})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{self.root}/manifests/m-{m.number:09d}")
        return m

    def is_applied(self, source: str, batch: int) -> bool:
        return self.manifest().applied.get(source, -1) >= batch

    # ------------------------------------------------------------ rows

    def bucket_of(self, part: str, *values: Column) -> Column:
        """Bucket of a key: of the part's key columns, or of ``values`` in their place."""
        return F.pmod(F.xxhash64(*(values or [F.col(c) for c in self.parts[part].key])), F.lit(self.buckets)).cast("int")

    def _write(self, delta: int, rows: Mapping[str, DataFrame]) -> None:
        for name, df in rows.items():
            part = self.parts[name]
            out = df.select(*[F.col(f.name).cast(f.dataType) for f in part.schema]).withColumn("bucket", self.bucket_of(name))
            # AQE puts small buckets together and cuts large ones by size: files are neither tiny nor the work of one task
            out = out.hint("rebalance", "bucket").sortWithinPartitions("bucket", *part.key)
            out.write.mode("errorifexists").partitionBy("bucket").parquet(f"{self.root}/{name}/delta={delta}")

    def _next_delta(self) -> int:
        return 1 + max((n for part in self.parts for n in listed(self.spark, f"{self.root}/{part}", r"delta=(\d+)")), default=-1)

    def append(self, rows: Mapping[str, DataFrame], source: str | None = None, batch: int = 0, unique: bool = True) -> Manifest:
        """Add one delta of the given parts. A batch of a source that is in already changes nothing."""
        m = self.manifest()
        if source is not None and m.applied.get(source, -1) >= batch:
            return m
        delta = self._next_delta()
        self._write(delta, rows)
        applied = {**m.applied, **({source: batch} if source is not None else {})}
        return self._commit(Manifest(m.number + 1, (*m.deltas, delta), applied, m.unique and unique, self.buckets))

    def read(self, part: str, manifest: Manifest | None = None) -> DataFrame:
        """All rows of the live deltas with ``delta`` and ``bucket``; a filter on ``bucket`` prunes files."""
        m = manifest or self.manifest()
        schema = T.StructType([*self.parts[part].schema.fields, T.StructField("delta", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        there = listed(self.spark, f"{self.root}/{part}", r"delta=(\d+)")
        paths = [f"{self.root}/{part}/delta={d}" for d in m.deltas if d in there]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}").parquet(*paths)

    # ------------------------------------------------------------ upkeep

    def compact(self, merge: Callable[[str, DataFrame], DataFrame]) -> Manifest:
        """Write every part as one delta: ``merge(part, rows)`` is what its live deltas amount to."""
        m = self.manifest()
        if len(m.deltas) < 2:
            return m
        delta = self._next_delta()
        self._write(delta, {part: merge(part, self.read(part, m)) for part in self.parts})
        return self._commit(Manifest(m.number + 1, (delta,), m.applied, True, self.buckets))

    def vacuum(self) -> list[str]:
        """Delete deltas that the newest manifest doesn't list, and older manifests. Nothing may be reading those."""
        m, gone = self.manifest(), []
        for part in self.parts:
            gone += [f"{self.root}/{part}/delta={d}" for d in listed(self.spark, f"{self.root}/{part}", r"delta=(\d+)") if d not in m.deltas]
        gone += [f"{self.root}/manifests/m-{n:09d}" for n in listed(self.spark, f"{self.root}/manifests", r"m-(\d+)") if n < m.number]
        for path in gone:
            p, fs = _files(self.spark, path)
            fs.delete(p, True)
        return gone
