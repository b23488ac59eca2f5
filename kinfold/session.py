"""Session settings and the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "kinfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on.

    Nothing here fixes a partition count: on a cluster set
    ``spark.sql.shuffle.partitions`` to a few times the core count (AQE merges
    what turns out small), or leave the cluster's own default in place.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Checkpoints of finished rounds go once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    The folder is the one the session names in ``spark.checkpoint.dir``; all
    executors must share it. A local session without that setting uses a folder
    below its warehouse, which is as shared as the tables it writes.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
