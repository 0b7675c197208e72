"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tillcast",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # remove a checkpoint's files once its DataFrame is garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset
    (local runs, tests) fall back to a fresh scratch folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    target = configured or tempfile.mkdtemp(prefix="tillcast-ckpt-")
    sc.setCheckpointDir(target)
    return target


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss).  Errors are raised: frames
    that are tagged by partition must not be recomputed with another partitioning."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when a bounded probe proves it holds at most ``max_rows`` rows;
    otherwise leave the join strategy to Spark (sort-merge or AQE's runtime choice)."""
    from pyspark.sql.functions import broadcast
    n = df.limit(max_rows + 1).count()
    return broadcast(df) if n <= max_rows else df
