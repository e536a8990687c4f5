"""Connected components of a graph given as links, by alternating stars.

Each round points every node's larger neighbours at its smallest neighbour
(large star), then its smaller neighbours at the smallest (small star), until
the links no longer change. Minima are aggregated before they are joined back,
so a node with many links is no single task's work; every round is cut off
with ``checkpoint()`` on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has long columns ``a`` and ``b``. Returns (node, component)
    for every node with a link to another one; component is the smallest node
    reachable. NULLs and self links are ignored, repeated links count once."""
    ensure_checkpoint_dir(links.sparkSession)
    cur = (links.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct().checkpoint())
    seen = _digest(cur)
    while True:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).union(cur.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .union(low.select("a", "m")))
        cur = small.distinct().checkpoint()
        now = _digest(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select("b", "b")).distinct()
