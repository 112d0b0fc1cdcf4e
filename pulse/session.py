"""Session construction and shared-storage locations.

All intermediate data that must outlive a task (checkpoints, landed payloads,
written marts) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Without that setting a local folder is used in
local mode only (unit tests on a laptop); on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter at scale.  Shuffle partitions is the *initial* number;
# AQE coalesces small partitions and splits skewed ones at runtime, so the
# same code is right for sf0.01 on a laptop and for 100 TB on a cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pulse", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = os.path.join(os.environ.get("TMPDIR", "/tmp"), "pulse-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for landed payloads, written tables and stream checkpoints so that
    every executor (and a restarted driver) sees the same files.
    """
    base = ensure_checkpoint_dir(spark)
    # getCheckpointDir returns a per-application sub folder; stay inside it.
    return f"{base.rstrip('/')}/pulse/{name}-{uuid.uuid4().hex[:12]}"


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files of the tables at ``paths`` (a file or a folder each); their content is not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
             .agg(F.sum("length")).first())
    return files[0] or 0
