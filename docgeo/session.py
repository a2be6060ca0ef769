"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "docgeo", shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings this library is tuned for (AQE, skew join, no UI)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:  # else Spark's own setting: AQE only coalesces, so a small default would cap a cluster
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DOCGEO_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a local-mode session without
    one gets a private temporary folder; a cluster session without one is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        root = tempfile.mkdtemp(prefix="docgeo-ckpt-")
        sc.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - a session may refuse to change it at runtime; the context has it
            pass
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint root for a written intermediate table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss, truncates the plan."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet under the shared checkpoint folder, read again.

    Cuts the lineage as ``cut_lineage`` does, and the rows are compressed, columns are pruned when they are read, and a shuffle
    that two branches of a plan need is done once: Spark knows two scans of one file for the same, not two of a checkpoint.
    """
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``docgeo`` importable in the Python workers (pandas UDF / applyInPandas / mapInPandas code paths).

    Zips the package once per application and adds it with ``addPyFile``, the way ``--py-files`` would; a
    deployment that already ships the package via ``--py-files`` or an installed wheel pays only the check.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="docgeo-pyfiles-"), "docgeo.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
