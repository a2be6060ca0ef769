"""Incremental workflow: new corpus files are processed batch by batch; state lives in logs that grow by what is new.

All per-document results (languages, names, centroid, clusters) are independent between documents, so the only
cross-run state is the location cache (``sources.location_log``) and the results by document with the sums behind the
averages (``streaming.state``). A micro-batch runs the workflow on its documents once, adds the names it resolved to the
cache and puts its documents' results in the place of earlier ones. A batch that is replayed after a failure finds itself
in the manifests and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgeo.operators import whitelist as W
from docgeo.plans import pipeline as P
from docgeo.session import cut_lineage
from docgeo.sources.location_log import LocationLog
from docgeo.streaming.state import CorpusState


def process_batch(docs: DataFrame, make_inputs: Callable[[DataFrame, DataFrame], P.Inputs], state: CorpusState, cache: LocationLog, source: str, batch: int) -> None:
    """One batch of documents, each at most once: their results replace earlier ones of the same ``doc_id``."""
    if state.is_applied(source, batch):
        return
    inp = P.scanned(make_inputs(docs, cache.read()))
    geo = P.geocoded(inp, locate=True)
    cache.add(geo.resolved, source, batch)
    state.upsert(docs, P.whitelist_ledger(inp, seq=batch, geo=geo), geo.doc_geo, P.detected(inp), source, batch)


def run_incremental(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    make_inputs: Callable[[DataFrame, DataFrame], P.Inputs],
    ledger_dir: str,
    cache_root: str,
    checkpoint_location: str,
) -> None:
    """Process every file now in ``source_dir`` that earlier runs have not seen, then stop.

    ``make_inputs(batch_docs, cache)`` builds the workflow inputs for one micro-batch. A document that comes again, changed
    or not, replaces its former results; of several rows with one ``doc_id`` in a batch, the one with the greatest text counts.
    """
    state, cache = CorpusState(spark, ledger_dir), LocationLog(spark, cache_root)

    def one_batch(docs: DataFrame, batch_id: int) -> None:
        if docs.isEmpty():
            return
        rest = [c for c in docs.columns if c not in ("doc_id", "text")]
        last = docs.groupBy("doc_id").agg(F.max(F.struct("text", *rest)).alias("x")).select("doc_id", "x.*").select(*docs.columns)
        process_batch(cut_lineage(last), make_inputs, state, cache, checkpoint_location, batch_id)

    query = (
        spark.readStream.schema(schema)
        .parquet(source_dir)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ledger(spark: SparkSession, ledger_dir: str) -> DataFrame:
    """The ledger rows of all documents in their last state (the batch number is in the rows' order column)."""
    return CorpusState(spark, ledger_dir).read("ledger")


def condensed(spark: SparkSession, ledger_dir: str, mode: str = "name") -> DataFrame:
    """The whitelist over everything processed so far; the averages come from the sums that are kept up."""
    state = CorpusState(spark, ledger_dir)
    return W.condense(state.read("ledger"), mode, state.averages("locations" if mode == "name" else "points"))
