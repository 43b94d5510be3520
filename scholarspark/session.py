"""Session helpers: building a local session for tests/bench and locating shared storage.

Operators never create sessions. On a cluster the deployer's session is used as is; the
only thing read from it is ``spark.checkpoint.dir`` (a shared folder), which is where
lineage cuts and intermediate tables go. A local fallback is set only when it is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: str | None = None


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "scholarspark", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and bench.py (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset (tests on one
    machine) a private temporary folder is created.
    """
    global _LOCAL_FALLBACK
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: the server owns spark.checkpoint.dir
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not local_fallback_allowed(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_FALLBACK is None:
            _LOCAL_FALLBACK = tempfile.mkdtemp(prefix="scholarspark-ckpt-")
        conf = _LOCAL_FALLBACK
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def local_fallback_allowed(master: str) -> bool:
    """Only a single-process session may use a folder of this machine."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scholarspark", f"{name}-{uuid.uuid4().hex[:12]}")


def reliable_checkpoint(df, name: str = "materialised"):
    """Cut lineage by writing the frame as a parquet table in the shared checkpoint folder and
    reading it back (never a local checkpoint, never a machine-local path on a cluster).

    Unlike ``Dataset.checkpoint`` - a count job followed by a second job that recomputes the
    frame to write it - the write is a single job, and the table is columnar and compressed.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
