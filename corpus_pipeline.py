"""The corpus pipeline: five stages from raw documents to packed pieces.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import decontamination, lines, packing, simhash, toxicity
from wardline.llm.common import stored
from wardline.llm.queries import tokenizer_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. A NULL doc_id stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.score(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("_toxic"))
    return docs.join(found.where("_toxic is not null").distinct(), docs["doc_id"] == F.col("_toxic"), "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, up to two edits, go; a document that
    has no words left goes too."""
    return lines.without_lines(docs, lines.duplicate_lines(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest doc_id stays."""
    return simhash.keep_one_per_group(docs, simhash.near_duplicates(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(
        docs, decontamination.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, tokenized and packed: one row per piece."""
    return packing.pack(docs, tokenizer_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# SQL cannot express trained models, edit-distance joins and packing; the tests
# compare the stages with plain Python on a small fixture instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
