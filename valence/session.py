"""Session construction and shared-storage helpers.

Intermediate tables (checkpoints, persisted models, sink folders) are
written below the folder the cluster names in ``spark.checkpoint.dir`` so
that every executor can read them and a lost executor never takes data with
it. A private folder is created only when the session has none configured,
which is the case in unit tests on a laptop.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Session defaults: AQE re-plans joins and coalesces partitions at runtime,
# skew-join splitting handles hot keys, and the UI server stays off.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of frames the driver no longer references are removed
    # from the shared folder instead of accumulating there
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # small scans are cut into enough splits for the text work on them
    "spark.sql.files.openCostInBytes": "262144",
}


def get_spark(master: str | None = None, app: str = "valence",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, configuring it if unset.

    Order: the folder already set on the context, then the
    ``spark.checkpoint.dir`` setting. Only a local master, where driver and
    executors are one process, gets a private temporary folder; on a cluster
    a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="valence-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "valence", f"{name}-{uuid.uuid4().hex[:12]}")


def freeze(df: DataFrame) -> DataFrame:
    """Cut ``df``'s lineage with a reliable checkpoint in the shared folder.

    The rows are persisted first: a checkpoint writes its files in a second
    job after the first one has computed them, and without the cache that
    second job computes everything again. The cache is dropped once the
    files are written; the returned DataFrame reads only the checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def store(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there,
    for rows with texts, tokens or vectors: :func:`freeze` holds such rows a
    second time while it writes, neither copy compressed. The files stay until
    the checkpoint folder is removed, so a stream's batches use :func:`freeze`;
    order and partitions are not kept."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
