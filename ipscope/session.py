"""Session construction and shared-folder helpers.

The cluster names its shared durable folder in ``spark.checkpoint.dir``.  Jobs
read it from the session and only fall back to a folder of their own when it is
unset (unit tests on a laptop).  Nothing here writes to a machine-local temp
folder on a cluster.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Defaults tuned for correctness first, then scale:
# * UTC session zone — timestamps are compared across engines and stores.
# * AQE with skew-join splitting and partition coalescing — runtime re-planning
#   covers hot keys and converts sort-merge joins to broadcast joins when the
#   measured shuffle size of a side is under the adaptive threshold.
# * partitionColumnTypeInference off — keeps ``month=04`` a string.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions sized by bytes, not by count: AQE coalesces small ones
    # and splits skewed ones around this target; scans split at the same size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # The only broadcast path is Spark's size check: a side is broadcast when its
    # estimated (static) or measured (AQE) size is under these bounds.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "ipscope",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Static confs only take effect on a fresh session; runtime ones we re-assert.
    for k, v in conf.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared durable folder for staging tables and lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session.  A folder of our own is
    chosen only on a local master, where the driver is the only executor; on a
    cluster an unset folder is an error, since each executor would write its own
    disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "ipscope-checkpoints")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "ipscope", *parts, uuid.uuid4().hex])
