"""Table sinks: full-overwrite writes, optionally partitioned, in a chosen format."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import fs


def delta_available(spark: SparkSession) -> bool:
    """True when the Delta Lake classes are on the session's class path."""
    try:
        spark._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return True
    except Exception:
        return False


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                change_feed: bool = False, rebalance: bool = True, compression: str | None = None) -> None:
    """Overwrite the table at ``path`` (schema may change between runs).

    ``partition_by`` lays files out by value so filters on those columns
    become partition prunes. Rows are first rebalanced on the partition
    columns (``REBALANCE`` hint): each value's rows meet in few tasks, so
    each folder gets a few large files instead of one small file per task,
    and AQE splits a value that holds a large share of the rows (one year,
    one big insurer) across several tasks instead of one.
    ``compression`` is the files' codec, the session's by default.
    With ``fmt="delta"`` the table's change data feed can be switched on;
    other formats have none (use
    :func:`wardline.operators.incremental.change_feed` between snapshots).
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").format(fmt)
    if compression:
        w = w.option("compression", compression)
    if fmt == "delta":
        w = w.option("overwriteSchema", "true")
        if change_feed:
            w = w.option("delta.enableChangeDataFeed", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage
    on a cluster), for intermediate tables that cut lineage."""
    root = ensure_checkpoint_dir(spark)
    return fs.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str, partition_by=(), fmt: str = "parquet",
                compression: str | None = None) -> DataFrame:
    """Write ``df`` to scratch storage and read it back: the result's plan
    starts at the written files (survives executor loss, no recomputation)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_table(df, path, fmt=fmt, partition_by=partition_by, compression=compression)
    return spark.read.format(fmt).load(path)
