"""Session construction and the few session-level settings the library relies on.

Everything here is ordinary Spark configuration. On a cluster the deployment
owns most of it (executor sizing, shuffle partitions, the checkpoint folder);
``build_session`` only fills in what is unset, so tests and the bench run the
same code as production without overriding a cluster's tuning.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here assumes. AQE re-plans joins at runtime from real
# shuffle sizes (broadcast conversion, skew splitting, partition coalescing),
# which is what lets the star joins work unchanged from sf0.001 to 100 TB.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs an extra shuffle later (e.g.
    # the races join that reuses the results' raceId partitioning): a hot
    # key holding a third of the rows must not become one straggler task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static broadcast threshold for relations with file statistics, and the
    # runtime one AQE applies to measured shuffle output. Both are size checks:
    # a dimension that outgrows them falls back to a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Partitioned writes with few partition values per task (race_type, year)
    # keep that many files open instead of sorting every task's rows by the
    # partition columns; past the limit Spark falls back to the sort, so
    # memory stays bounded.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

# Static settings, fixed when the JVM starts: set only for local runs (tests,
# bench). On a cluster they belong to the submit configuration (Kryo is
# recommended there too).
LOCAL_STATIC = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "gridlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``DEFAULTS`` fill in only what the submit configuration (``--conf``,
    ``spark-defaults.conf``) or the running session has not set, so a
    cluster's own tuning always wins. The static ``LOCAL_STATIC`` settings
    are applied only when ``master`` asks for a local run (tests, bench).
    ``shuffle_partitions`` and ``extra`` are explicit requests and are
    applied. ``shuffle_partitions`` is the *initial* partition count; AQE
    coalesces it at runtime, so on a cluster set it high (thousands) and
    let AQE size the stages.
    """
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for k, v in LOCAL_STATIC.items():
                builder = builder.config(k, v)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    conf = spark.conf
    for k, v in DEFAULTS.items():
        if conf.get(k, None) is None and conf.isModifiable(k):
            conf.set(k, v)
    for k, v in explicit.items():
        if conf.isModifiable(k):
            conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    return sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only when none is configured.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Without one,
    a local folder is used on a local master only (tests, the bench): anywhere
    else every executor would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    existing = checkpoint_dir(spark)
    if existing:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(existing)
        return existing
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="gridlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
