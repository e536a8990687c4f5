"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library's plans assume. All are standard Spark options.
DEFAULT_CONF = {
    # Wall-clock text carries no zone; keep parsing and rendering in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn a sort-merge join into a broadcast join when the
    # measured (not estimated) side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key also where that costs one more exchange (a join between
    # two others on the same key, as in the ward board).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A join whose filtered side is too large to broadcast still reduces the
    # other side before its shuffle, by a Bloom filter of the keys (8 MB at
    # most). Spark only tries for scans of over 10 GB and sides of under 10 MB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    # The JVM does not compile methods of over 8,000 bytes of bytecode, and wide
    # cleansing projections generate such: they ran interpreted, several times
    # slower. Beyond the limit Spark splits the work into smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "wardline", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as-is. Only when it is unset on a local master (tests) do we create a
    scratch folder of our own; on any other master that is an error, since
    executors could not share it.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if cur:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(cur)
        return cur
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="wardline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path
