"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.sinks import materialize

# Words are maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package's code, once per application, as a zip
    that the driver serves: tasks import it wherever they run. Also sees to it
    that the checkpoint folder is set."""
    ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="wardline-code-"), "wardline_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The columns an operator works on, under fixed names: ``doc_id`` long,
    ``text`` string (NULL becomes empty) and ``more`` as they are. All other
    columns are left behind, so their names cannot clash with an operator's."""
    ship(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                     *[F.col(c) for c in more])


def give_back() -> None:
    """At the end of a Python task: memory that is free goes back to the system.
    Workers stay for the next step, and what the allocators keep would count
    beside it. Does nothing where the C library has no such call."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back."""
    return materialize(df, f"llm-{name}")


def words(col):
    """The words of a string column as an array, JVM-side."""
    return F.filter(F.split(col, SPACE, -1), lambda w: w != "")


def rank_within(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with a long column ``name``: 0, 1, ... within each ``group`` by
    ``order``. Rows are dealt by range over group and order together, so a
    group of any size is ranked by many tasks: each task numbers its own rows,
    and counts per task and group give the offsets.

    NULL keys form a group of their own; ties get distinct ranks in any order.
    """
    ranged = (df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
                .withColumn("_part", F.spark_partition_id())
                .withColumn("_row", F.monotonically_increasing_id())
                .checkpoint())
    per_task = ranged.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                              F.col("_part").alias("_p"), "_first",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    on = (F.col("_part") == F.col("_p"))
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (ranged.join(offsets, on)
                  .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first"))
                  .select(*df.columns, name))
