"""The registered queries of this subpackage: each applies one operator with
production parameters to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontamination, extraction, lines, mixing, packing, quality, simhash, spelling, structure, substrings, suffixes,
    toxicity,
)
from .oracle import ORACLE  # noqa: F401


def tokenizer_path() -> str:
    """The public tokenizer file that packing uses."""
    import public_tokenizers  # noqa: PLC0415
    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(_table(spark, sf_dir, "conversations"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "similarity")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words", "n_removed_lines")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.duplicate_lines(_table(spark, sf_dir, "documents")).drop("copy")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return structure.report(conversations, structure.damaged(conversations), order=("copy",))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.groups(_table(spark, sf_dir, "documents"), slip=spelling.slips())


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_toxicity": op10_toxicity,
    "op11_structure_repair": op11_structure_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_mixing": op13_source_mixing,
}
