"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults sized for a large cluster; local runs override partitions.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Multi-character separators need the full row to detect short rows
    # (DROPMALFORMED); see sources.text.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Plans are built from many small Column calls; skipping the per-call
    # call-site capture (error-message context only) halves the py4j
    # round trips while a plan is being built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Window state of the streaming jobs lives off-heap in RocksDB and is
    # checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Lineage cuts (``checkpoint()``) are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "skywarden",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    Uses ``spark.checkpoint.dir`` from the session.  Only a local-mode
    session without that setting (tests, laptops) gets a fresh scratch
    folder; on a cluster a missing setting is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="skywarden-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")
