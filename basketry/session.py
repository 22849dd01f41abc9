"""Session helpers: a local session for tests/bench and the shared scratch dir."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "basketry") -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster the session comes from the launcher; only the SQL knobs below
    matter there (UTC zone, AQE with skew-join and partition coalescing).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; created privately only when unset.

    A private folder is on this machine, so that is for local masters only.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="basketry-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, base)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder.

    Used where one intermediate feeds several branches of a plan that Spark
    cannot share (differently pruned column sets): it is computed once, and
    a lost executor re-reads the checkpoint instead of recomputing upstream.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    (local runs, tests) is a private temporary folder created and registered
    as the checkpoint dir, so later ``checkpoint()`` calls land there too.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if name else uuid.uuid4().hex[:12]
    return f"{base}/basketry/{leaf}"
