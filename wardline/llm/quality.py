"""Quality rules: lines that many documents of one host share are removed, and
documents that lose too much by it are rejected.

Arrow batches give each document's counts and its lines as (hash of the
normalised line, words); everything across documents is DataFrame work on
those short rows: count distinct documents per host and line, keep the lines
over the limit, add up what each document loses.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored

MAX_DOCS = 100  # a line in more documents of one host than this is boilerplate
MIN_LEFT = 0.5  # share of words that must be left
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def repeat_words(ws: list, gram: int = GRAM) -> int:
    """Words in ``gram``-word windows found twice or more, first included."""
    grams = list(zip(*[ws[k:] for k in range(gram)], strict=False))
    if len(set(grams)) == len(grams):
        return 0
    count, covered, upto = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered += i + gram - max(i, upto)
            upto = i + gram
    return covered


def measure(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, hashes of
    the normalised lines with a word, words in each)."""
    from xxhash import xxh64_intdigest  # noqa: PLC0415
    ws = text.encode("utf-8", "replace").split()
    seen, dups, hashes, sizes = set(), 0, [], []
    for line in text.split("\n"):
        parts = line.encode("utf-8", "replace").split()
        if not parts:
            continue
        dups += line in seen
        seen.add(line)
        h = xxh64_intdigest(b" ".join(parts).decode("utf-8").lower().encode())
        hashes.append(h - (1 << 64) if h >> 63 else h)
        sizes.append(len(parts))
    return (len(ws), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dups,
            repeat_words(ws), hashes, sizes)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, host) with the measures and lines of each text."""
    types = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["doc_id", "host", *MEASURES, "lines", "line_words"]

    def run(batches):
        for b in batches:
            got = [measure(t) for t in b.column(1).to_pylist()]
            cols = list(zip(*got, strict=True)) if got else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2).cast(pa.string()), *[pa.array(c, t) for c, t in zip(cols, types[2:], strict=True)]], names)

    return docs.mapInArrow(run, "doc_id long, host string, " + ", ".join(f"{m} long" for m in MEASURES)
                           + ", lines array<long>, line_words array<long>")


def judge(df: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT, id_col: str = "doc_id",
          text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: doc_id, the five measures, base_failed, kept,
    n_removed_words (words in lines of more than ``max_docs`` documents of the
    host) and n_removed_lines.

    A document is base_failed with under 10 words, or over 20 % of them in
    repeated windows; it is kept if it is not, and the lines left hold
    ``min_left`` of its words and 10 words at least. NULL texts have no words.
    NULL hosts are one host. A row is a document, also where doc_id is NULL or
    repeated. Lines with no word are never counted. An empty table gives no rows.
    """
    docs = id_text(df, id_col, text_col, host_col).withColumnRenamed(host_col, "host")
    docs = docs.select("doc_id", "text", F.col("host").cast("string").alias("host"))
    base = stored(measured(docs).withColumn("row", F.monotonically_increasing_id()), "quality")
    frequent = (base.select("host", F.explode(F.array_distinct("lines")).alias("line"))
                    .groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs)
                    .select(F.col("host").alias("_host"), F.col("line").alias("_line")))
    each = base.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
    lost = (each.join(frequent, each["host"].eqNullSafe(F.col("_host")) & (F.col("l.lines") == F.col("_line")))
                .groupBy("row").agg(F.sum("l.line_words").alias("lost"), F.count("*").alias("gone")))
    left = F.col("n_words") - F.col("n_removed_words")
    return (base.select("row", "doc_id", *MEASURES).join(lost, "row", "left")
                .select("doc_id", *MEASURES,
                        F.coalesce("lost", F.lit(0)).alias("n_removed_words"),
                        F.coalesce("gone", F.lit(0)).alias("n_removed_lines"))
                .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
                .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= min_left * F.col("n_words")))
                .select("doc_id", *MEASURES, "base_failed", "kept", "n_removed_words", "n_removed_lines"))
