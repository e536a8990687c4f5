"""Order and samples over whole tables without one task that sees all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import materialize
from .incremental import row_digest


def with_position(df: DataFrame, order: list[Column], name: str = "POSITION") -> DataFrame:
    """``df`` with each row's place, 1, 2, ..., in the given order.

    Rows are dealt to tasks by ranges of the order and sorted there; a count per
    task gives where its first row stands. So the only window is over one row
    per task. Ties take places next to each other, in any order: name columns
    that make the order total where it matters. The ranged rows are staged in
    the checkpoint folder, so that places do not change when a task is lost.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = materialize(ranged.select("*", F.spark_partition_id().alias("__task"), F.monotonically_increasing_id().alias("__row")),
                         "ordered")
    tasks = staged.groupBy("__task").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select(F.col("__task").alias("__t"), "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__row") - F.col("__first") + 1
    return staged.join(starts, staged["__task"] == starts["__t"]).select(*df.columns, place.alias(name))


HEX = 15      # hex digits of the hash that orders a sample
BUCKETS = 3   # of these, the first ones by which rows are counted: 4,096 buckets


def sample_hash(key, seed: int) -> Column:
    """Hex text whose order is the order in which keys enter a sample; any engine
    with MD5 computes the same."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, HEX)


def sample_rows(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """Exactly ``rows`` rows of ``df`` (all, if it has no more): those whose keys
    hash lowest. The same rows for any partitioning, order and engine, and a
    larger sample with the same seed contains a smaller one.

    Rows are counted by the first digits of their hash; buckets that fit are
    taken as they are, and only the rows of the one that does not are sorted.
    Rows with one key go by their values; equal rows are interchangeable.
    """
    hashed = df.withColumn("__h", sample_hash(key, seed)).withColumn("__b", F.substring("__h", 1, BUCKETS))
    counts = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("n"))  # 4,096 rows at most
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("__b")))
    whole, edge = upto.agg(F.max(F.when(F.col("upto") <= rows, F.struct("__b", "upto"))),
                           F.min(F.when(F.col("upto") > rows, F.col("__b")))).first()
    parts = [hashed.where(F.col("__b") <= F.lit(whole["__b"]))] if whole else []
    left = rows - (whole["upto"] if whole else 0)
    if edge is not None and left > 0:
        parts.append(hashed.where(F.col("__b") == F.lit(edge)).orderBy("__h", row_digest(df.columns)).limit(left))
    if not parts:
        return df.limit(0)
    return reduce(DataFrame.unionByName, parts).select(*df.columns)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """:func:`sample_rows` of the nearest whole number of rows to ``fraction``."""
    return sample_rows(df, key, int(df.count() * fraction + 0.5), seed)
