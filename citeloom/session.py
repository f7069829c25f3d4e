"""Session helpers: a tuned SparkSession and the shared scratch/checkpoint folder.

Every job that must cut lineage (surrogate keys, stream checkpoints, staging
files) writes below the folder named by ``spark.checkpoint.dir``. On a cluster
that setting points at shared storage and is read as is; only a local session
without it (unit tests, the local bench) gets a fresh folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "citeloom", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    shared_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return (spark.conf.get("spark.master", "") or "").startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and job scratch data.

    Reads ``spark.checkpoint.dir`` (or a directory set with
    ``SparkContext.setCheckpointDir``). Only a local session without either
    gets a private folder; a cluster session without one is an error, since a
    machine-local folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns checkpointing
        sc = None
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None
                  else spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS, S3, ABFS, ...) so checkpoints survive executor loss")
    folder = tempfile.mkdtemp(prefix="citeloom-ckpt-")
    if sc is None:
        return folder
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark)}/citeloom/{purpose}-{uuid.uuid4().hex}"


def written(purpose: str, rows: DataFrame) -> DataFrame:
    """The rows as a table below the shared folder: computed once, however often they are read."""
    path = scratch_path(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
