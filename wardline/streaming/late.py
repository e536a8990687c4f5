"""The alert feed as two stages with a watermark, and a side table for late rows.

``land``   lab files -> alerts (stream-static joins), one folder per batch;
``accept`` landed alerts -> ``withWatermark`` -> ``dropDuplicatesWithinWatermark``
           -> feed, stored by month. Spark's state store remembers the keys of
           alerts until the watermark has passed them, so its size follows the
           delay and not the feed. Rows that come later than the watermark are
           dropped by that operator;
``side``   a batch job over the landed batches that ``accept`` has been through:
           rows below its watermark that the feed does not hold were late, and go
           to the side table. Only the months that such rows lie in are read.

So every alert is in the feed or in the side table, and in one of them once.
:func:`run_cycle` runs the three after one another over all that has arrived.
Each stage writes a folder per batch with overwrite and keeps its own progress,
so a cycle that dies is taken up where it was, and a batch done again replaces
its own output.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fs
from .alerts import ALERT_COLUMNS, alerts_from_labs

KEY = ["ALERT_BK", "RESULTED_TS"]
SCHEMA = ", ".join(f"{c} {'timestamp_ntz' if c == 'RESULTED_TS' else 'date' if c == 'ADMIT_DATE' else 'string'}" for c in ALERT_COLUMNS)
STORED = f"{SCHEMA}, month date, batch long"


@dataclass
class AlertFolders:
    """Where a feed with late rows lives, all on shared storage."""
    root: str

    def __getattr__(self, name):
        if name in ("landed", "feed", "late", "checkpoints"):
            return fs.join(self.root, name)
        raise AttributeError(name)


def _write(batch: DataFrame, path: str) -> None:
    """A batch, by month and sorted by time; also one without rows, so that it is known to be done."""
    out = batch.select(*ALERT_COLUMNS, _month().alias("month")).hint("rebalance", "month")
    out.sortWithinPartitions("month", *KEY[::-1]).write.mode("overwrite").partitionBy("month").parquet(path)


def _month():
    return F.to_date(F.date_trunc("month", "RESULTED_TS"))


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished batches of a stage."""
    return sorted(int(n.split("=")[1]) for n, _ in fs.listing(spark, path)
                  if n.startswith("batch=") and fs.exists(spark, fs.join(path, n, "_SUCCESS")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The feed or the side table so far, with ``month`` and ``batch``."""
    if not _batches(spark, path):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("basePath", path).parquet(fs.join(path, "batch=*"))


def land(spark: SparkSession, lab_dir: str, lab_schema, encounters: DataFrame, providers: DataFrame, departments: DataFrame,
         diagnoses: DataFrame, folders: AlertFolders, max_files: int | None = None) -> None:
    """Alerts of all lab files that have arrived since, a folder per batch."""
    reader = spark.readStream.schema(lab_schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    labs = reader.parquet(lab_dir).where((F.col("RESULT_FLAG") == "Abnormal") & F.col("RESULTED_TS").isNotNull())
    alerts = alerts_from_labs(labs, encounters, providers, departments, diagnoses)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(fs.join(folders.landed, f"batch={number}"))

    (alerts.writeStream.foreachBatch(write).option("checkpointLocation", fs.join(folders.checkpoints, "land"))
           .trigger(availableNow=True).start().awaitTermination())


def accept(spark: SparkSession, folders: AlertFolders, delay: str, max_files: int | None = None) -> list[dict]:
    """Landed alerts into the feed, each key once, unless they are later than
    the watermark. Returns the progress of the batches."""
    reader = spark.readStream.schema(f"{SCHEMA}, batch long")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a watermark needs a time with a zone; sessions run in UTC
    rows = (reader.parquet(folders.landed).withColumn("_time", F.col("RESULTED_TS").cast("timestamp"))
                  .withWatermark("_time", delay).dropDuplicatesWithinWatermark(KEY))
    query = (rows.writeStream.foreachBatch(lambda batch, n: _write(batch, fs.join(folders.feed, f"batch={n}")))
                 .option("checkpointLocation", fs.join(folders.checkpoints, "accept")).trigger(availableNow=True).start())
    query.awaitTermination()
    return [p if isinstance(p, dict) else p.jsonValue for p in query.recentProgress]


def watermark_of(progress: list[dict]) -> _dt.datetime | None:
    """The watermark that the last batch worked with (they only rise)."""
    marks = [p["eventTime"]["watermark"] for p in progress if p.get("eventTime", {}).get("watermark")]
    return max(_dt.datetime.fromisoformat(m.replace("Z", "+00:00")).replace(tzinfo=None) for m in marks) if marks else None


def side(spark: SparkSession, folders: AlertFolders, watermark: _dt.datetime | None) -> int | None:
    """Late rows of the landed batches that this stage has not been through yet;
    all of them must have been through ``accept``. The batch is named by the last
    landed one. Returns its number, None if there was nothing to do."""
    landed, done = _batches(spark, folders.landed), _batches(spark, folders.late)
    todo = [n for n in landed if n > max(done, default=-1)]
    if not todo:
        return None
    rows = spark.read.schema(SCHEMA).parquet(*[fs.join(folders.landed, f"batch={n}") for n in todo])
    # what is not below the watermark was in time, and is in the feed
    rows = rows.where(F.col("RESULTED_TS") < F.lit(watermark)) if watermark is not None else rows
    rows = rows.dropDuplicates(KEY).withColumn("month", _month())
    months = [r["month"] for r in rows.select("month").distinct().collect()]  # as many as the calendar has
    for stored in (folders.feed, folders.late):
        have = read(spark, stored).where(F.col("month").isin(months)).select("month", *KEY)
        rows = rows.join(have, ["month", *KEY], "left_anti")
    _write(rows, fs.join(folders.late, f"batch={todo[-1]}"))
    return todo[-1]


def run_cycle(spark: SparkSession, lab_dir: str, lab_schema, encounters: DataFrame, providers: DataFrame, departments: DataFrame,
              diagnoses: DataFrame, root: str, delay: str = "2 days", max_files: int | None = None) -> dict:
    """All that has arrived, through the three stages. Returns the watermark (the
    last one known), the rows that ``accept`` dropped as late (repeats of alerts
    in the feed among them) and the rows its state holds."""
    folders = AlertFolders(root)
    land(spark, lab_dir, lab_schema, encounters, providers, departments, diagnoses, folders, max_files)
    if not _batches(spark, folders.landed):
        return {"watermark": None, "dropped": 0, "state_rows": 0}
    progress = accept(spark, folders, delay)
    side(spark, folders, watermark_of(progress))
    states = [s for p in progress for s in p.get("stateOperators", ())]
    return {"watermark": watermark_of(progress), "dropped": sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
            "state_rows": states[-1]["numRowsTotal"] if states else 0}
