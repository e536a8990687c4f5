"""Benchmark decontamination by SimHash over item-sized windows.

Everything is DataFrame work. A benchmark item of n shingles is compared with
windows of n shingles of the documents:

1. Only windows that hold one of the item's first and one of its last few
   shingles are formed. An item similar to a window lacks so few of its
   shingles there that each of these two groups must be represented, so this
   loses no match. A window is a candidate for the items that formed it only.
2. Windows and items get 64-bit SimHashes over their shingles (repeats count).
   The bits are cut into blocks; items are expanded to all values within a
   block radius, so every pair within ``BLOCKS * (BLOCK_RADIUS + 1) - 1`` bits
   meets in a block (pigeonhole), and then the whole distance is checked. The
   item is part of the block's key: items of one length do not meet each
   other's windows, however many there are.
3. Exact weighted-shingle similarity (sum of least over sum of greatest
   counts) decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, words

WIDTH = 5
SIMILARITY = 0.8
BLOCKS = 8
BLOCK_BITS = 8
BLOCK_RADIUS = 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # all pairs up to here are found
BROADCAST_BYTES = 32 << 20  # of benchmark data that may be broadcast; beyond, Spark shuffles


def shingle_hashes(word_array: Column, width: int = WIDTH) -> Column:
    """Hashes of the word shingles in order; a text of fewer words is one
    shingle, one with no word has none."""
    n = F.size(word_array)
    each = F.transform(word_array, lambda w: F.xxhash64(w))

    def of(h: Column) -> Column:
        full = F.transform(F.sequence(F.lit(1), F.size(h) - (width - 1)),
                           lambda i: F.xxhash64(*[F.element_at(h, (i + k).cast("int")) for k in range(width)]))
        return F.when(n >= width, full).when(n > 0, F.array(F.xxhash64(F.lit(7), F.concat_ws(" ", word_array)))).otherwise(
            F.expr("cast(array() as array<bigint>)"))

    return F.element_at(F.transform(F.array(each), of), 1)  # hash each word once


def _lanes() -> list[Column]:
    """Sums that count each bit of ``h``: 32 sums of two 32-bit counters."""
    mask = (1 << 32) | 1
    return [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(mask))).alias(f"_l{j}") for j in range(32)]


def _fold(n: Column) -> Column:
    """The SimHash of counted bits: a bit is 1 if set in over half of ``n``."""
    bits = []
    for j in range(32):
        low = F.col(f"_l{j}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"_l{j}"), 32)
        bits.append(F.when(low * 2 > n, F.lit(1 << j)).otherwise(F.lit(0)).cast("long"))
        top = (1 << (j + 32)) if j < 31 else -(1 << 63)
        bits.append(F.when(high * 2 > n, F.lit(top)).otherwise(F.lit(0)).cast("long"))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` have ``keys`` and an array ``hs``: keys and long column fp."""
    return (rows.select(*keys, F.explode("hs").alias("h")).groupBy(*keys)
                .agg(F.count("*").alias("_n"), *_lanes())
                .select(*keys, _fold(F.col("_n")).alias("fp")))


def _block(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def _masks() -> list[int]:
    return [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= BLOCK_RADIUS]


def _small(df: DataFrame, size: int) -> DataFrame:
    """``df`` marked for broadcast if its measured ``size`` in bytes is within
    bounds; else Spark joins it by shuffle."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _shared(a: Column, b: Column) -> Column:
    """How many shingles two arrays have in common, repeats included."""
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, x: acc + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))


def matches(df: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The leaks: one row per document and item with a window of weighted
    similarity ``similarity`` or more: doc_id, item_id, start (word where the
    best window begins, the first of equals), n_words of it, bits (SimHash
    distance) and similarity.

    Words are lower-cased. A document shorter than an item is one window. An
    item of under five words is one shingle and must occur as a whole as a
    document's whole text. NULL and empty texts match nothing. A repeated
    doc_id or item_id is reported once with its best window; rows with NULL
    ids are reported under NULL. Empty tables give no rows.
    """
    docs = id_text(df, id_col, text_col).select("doc_id", F.lower("text").alias("text"))
    docs = docs.withColumn("copy", F.xxhash64("text", F.length("text")))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("t"))
    items = (items.select("item_id", shingle_hashes(words(F.lower(F.coalesce("t", F.lit(""))))).alias("hs"))
                  .where(F.size("hs") > 0).distinct()
                  .withColumn("item", F.xxhash64("hs", F.size("hs"))).withColumn("n", F.size("hs")))
    texts = items.select("item", "n", "hs").distinct()
    # what a similar window may lack of the item's shingles, and one more (rounding may not make it less)
    need = F.least(F.floor(F.col("n") * (1 - similarity) + 1e-6) + 1, F.col("n")).cast("int")
    ends = texts.select("item", "n", F.explode(F.array(
        F.struct(F.lit(1).alias("side"), F.slice("hs", 1, need).alias("part")),
        F.struct(F.lit(2).alias("side"), F.slice("hs", F.col("n") - need + 1, need).alias("part")))).alias("e"))
    seeds = (ends.select("item", "n", "e.side", F.explode("e.part").alias("h"))
                 .groupBy("h", "item", "n").agg(F.bit_or("side").alias("side")).checkpoint())
    held, items = texts.checkpoint(), items.select("item", "item_id").checkpoint()
    row = 48  # bytes of a row of a few numbers, with its overhead
    seeds = _small(seeds, seeds.count() * row)
    n_texts, n_shingles = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    hashed = docs.select("doc_id", "copy", shingle_hashes(words(F.col("text"))).alias("hs"))
    at = hashed.select("doc_id", "copy", F.size("hs").alias("len"), F.posexplode("hs").alias("p", "h"))
    hits = at.join(seeds, "h")
    # every window of the item's size that holds this seed
    last = F.greatest(F.col("len") - F.col("n"), F.lit(0))
    spread = hits.select("doc_id", "copy", "item", "n", "side", F.explode(F.sequence(
        F.least(F.greatest(F.col("p") - F.col("n") + 1, F.lit(0)), last), F.least("p", last))).alias("s"))
    windows = (spread.groupBy("doc_id", "copy", "item", "n", "s").agg(F.bit_or("side").alias("sides"))
                     .where("sides = 3"))
    per_doc = windows.groupBy("doc_id", "copy", F.floor(F.col("s") / 4096).alias("_stretch")).agg(
        F.collect_list(F.struct("s", "n", "item")).alias("ws"))
    with_hits = (docs.join(per_doc.withColumnsRenamed({"doc_id": "_d", "copy": "_c"}),
                           docs["doc_id"].eqNullSafe(F.col("_d")) & (docs["copy"] == F.col("_c")))
                     .select("doc_id", "copy", "ws", shingle_hashes(words(F.col("text"))).alias("hs")))
    cut = (with_hits.select("doc_id", "copy", "hs", F.explode("ws").alias("w"))
                    .select("doc_id", "copy", F.col("w.s").alias("s"), F.col("w.n").alias("n"), "w.item",
                            F.slice("hs", F.col("w.s") + 1, F.col("w.n")).alias("hs")))
    # a window's content is worked on once, however many documents hold it
    cut = cut.withColumn("win", F.xxhash64("hs", F.size("hs"))).checkpoint()
    contents = cut.groupBy("win", "n").agg(F.first("hs").alias("hs"))
    fps = simhash(contents, ["win", "n"])
    item_fps = simhash(held.select("item", "n", "hs"), ["item", "n"])
    blocks = F.array(*[_block(F.col("fp"), k) for k in range(BLOCKS)])
    keys = (item_fps.select("item", "n", F.col("fp").alias("ifp"), F.posexplode(blocks).alias("k", "own"))
                    .withColumn("mask", F.explode(F.array(*map(F.lit, _masks()))))
                    .select("item", "n", "ifp", "k", F.col("own").bitwiseXOR(F.col("mask")).alias("v")))
    candidates = cut.select("item", "n", "win").distinct()
    probes = candidates.join(fps, ["win", "n"]).select("item", "n", "win", "fp", F.posexplode(blocks).alias("k", "v"))
    near = (probes.join(_small(keys, n_texts * BLOCKS * len(_masks()) * row), ["item", "n", "k", "v"])
                  .withColumn("bits", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))))
                  .where(F.col("bits") <= RADIUS).select("win", "n", "item", "bits").distinct())
    pairs = (near.join(contents, ["win", "n"])
                 .join(_small(held.select("item", "n", F.col("hs").alias("ihs")), n_texts * row + n_shingles * 8), ["item", "n"]))
    common = _shared(F.col("hs"), F.col("ihs"))
    alike = (pairs.withColumn("common", common)
                  .withColumn("similarity", F.col("common") / (F.size("hs") + F.size("ihs") - F.col("common")))
                  .where(F.col("similarity") >= similarity).select("win", "n", "item", "bits", "similarity"))
    found = (cut.select("doc_id", "s", "n", "win", "item").join(alike, ["item", "win", "n"])
                .join(_small(items, items.count() * row), "item"))
    best = found.groupBy("doc_id", "item_id").agg(F.min(F.struct(
        (-F.col("similarity")).alias("minus"), "s", "n", "bits")).alias("w"))
    return best.select("doc_id", "item_id", F.col("w.s").cast("long").alias("start"),
                       (F.col("w.n") + WIDTH - 1).cast("long").alias("n_words"), F.col("w.bits").alias("bits"),
                       (-F.col("w.minus")).alias("similarity"))


def without_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``leaks`` names. A NULL id stays."""
    gone = leaks.select(F.col("doc_id").alias("_gone")).where("_gone is not null").distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
