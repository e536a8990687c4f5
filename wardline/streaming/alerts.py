"""Structured Streaming twin of the abnormal-lab alert feed.

New lab files land in a folder; each trigger turns the newly arrived rows
into alerts and appends them to the feed:

``readStream`` (parquet folder) -> keep abnormal, resulted labs ->
stream-static joins with encounters and dimensions -> ``foreachBatch`` into a
parquet folder, one sub-folder per batch id, written with overwrite so a batch
replayed after a failure replaces its own output (exactly-once with the
checkpoint). A batch leaves out alerts that other batches have written: a
re-delivered alert has the same result time, so only that stretch of the feed
is read. However late an alert comes, it is kept, and no state is held.

``trigger(availableNow=True)`` processes everything available and stops,
so the same job runs as a scheduled refresh or continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources import fs

ALERT_COLUMNS = ["ALERT_BK", "RESULTED_TS", "LAB_ORDER_BK", "ENCOUNTER_BK", "PATIENT_BK", "TEST_NAME",
                 "RESULT_FLAG", "PROVIDER_BK", "ATTENDING_PROVIDER", "DEPARTMENT_NAME",
                 "DIAGNOSIS_DESC", "ADMIT_DATE"]


def alerts_from_labs(labs: DataFrame, encounters: DataFrame, providers: DataFrame,
                     departments: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """The alert projection; works on a streaming or a static ``labs``."""
    e = (encounters.where(F.col("STATUS") != "Cancelled")
                   .select("ENCOUNTER_BK", "PATIENT_BK", "PROVIDER_BK", "DEPARTMENT_BK", "DIAGNOSIS_BK",
                           "ADMIT_DATE"))
    prov = providers.select("PROVIDER_BK", F.col("PROVIDER_NAME").alias("ATTENDING_PROVIDER"))
    dept = departments.select("DEPARTMENT_BK", "DEPARTMENT_NAME")
    dx = diagnoses.select("DIAGNOSIS_BK", "DIAGNOSIS_DESC")
    j = (labs.join(e, "ENCOUNTER_BK", "inner")
             .join(prov, "PROVIDER_BK", "left")
             .join(dept, "DEPARTMENT_BK", "left")
             .join(dx, "DIAGNOSIS_BK", "left"))
    return j.select(F.col("LAB_ORDER_BK").alias("ALERT_BK"), *ALERT_COLUMNS[1:])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def start_alert_stream(spark: SparkSession, lab_dir: str, lab_schema, encounters: DataFrame,
                       providers: DataFrame, departments: DataFrame, diagnoses: DataFrame,
                       sink_dir: str, checkpoint: str | None = None,
                       available_now: bool = True, max_files_per_trigger: int | None = None
                       ) -> StreamingQuery:
    """Start the alert stream; returns the ``StreamingQuery``.

    ``checkpoint`` defaults to a folder under the session's
    ``spark.checkpoint.dir`` (shared storage on a cluster).
    """
    if checkpoint is None:
        checkpoint = fs.join(ensure_checkpoint_dir(spark), "alert-stream", sink_dir.rstrip("/").rsplit("/", 1)[-1])
    reader = spark.readStream.schema(lab_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    labs = reader.parquet(lab_dir).where((F.col("RESULT_FLAG") == "Abnormal") & F.col("RESULTED_TS").isNotNull())
    alerts = alerts_from_labs(labs, encounters, providers, departments, diagnoses)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        one = batch.dropDuplicates(["ALERT_BK", "RESULTED_TS"])
        low, high = batch.agg(F.min("RESULTED_TS"), F.max("RESULTED_TS")).first()
        if low is not None and fs.exists(spark, sink_dir):
            seen = (spark.read.schema(f"{_ddl(batch)}, batch long").parquet(sink_dir)
                         .where((F.col("batch") != batch_id) & F.col("RESULTED_TS").between(low, high)))
            one = one.join(seen.select("ALERT_BK", "RESULTED_TS"), ["ALERT_BK", "RESULTED_TS"], "left_anti")
        one.write.mode("overwrite").parquet(fs.join(sink_dir, f"batch={batch_id}"))

    w = alerts.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_alert_feed(spark: SparkSession, sink_dir: str) -> DataFrame:
    """All alerts written so far (``batch`` is the partition column)."""
    return spark.read.parquet(sink_dir)
