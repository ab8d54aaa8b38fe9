"""Spark session setup.

Every model assumes UTC session time (timestamps in the raw tables are zoned
instants) and ANSI casts. Adaptive execution stays on so joins against small
dimensions are converted to broadcast joins from *measured* sizes and skewed
partitions are split at run time.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (~1000 executors, ~100 TB of landed telemetry).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions, which fit
# executor memory with room for sort buffers (larger ones spill, never fail);
# scans split files into 256 MB pieces; a partition 5x the median and over
# 512 MB counts as skewed and is split; dimension joins are broadcast only
# when the *measured* side is under 64 MB (sessions, meetings, drivers per
# season are far below that), everything else is a sort-merge join.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str | None = None,
    app_name: str = "raceline",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the models rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models need to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    operator (a shared file system). Only when it is unset on a local master
    (tests, single-machine runs) a private scratch folder is created and
    registered; on a cluster an unset value is an error, never a
    machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:  # a Connect session has no SparkContext on the client
        context = spark.sparkContext
    except Exception:
        context = None
    if configured:
        if context is not None:
            context.setCheckpointDir(configured)
        return configured
    master = context.master if context is not None else (spark.conf.get("spark.master", None) or "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="raceline-ckpt-", dir=os.environ.get("RACELINE_SCRATCH"))
    spark.conf.set("spark.checkpoint.dir", local)
    if context is not None:
        context.setCheckpointDir(local)
    return local
