"""Mixing sources to target weights by hash thresholds.

Every document has a hash of its id and text. Of a source that is to give less
than it has, the documents below a threshold are taken; one that is to give
more is taken whole as often as it fits, and the rest by a threshold. Nothing
is sorted: tokens are summed by source and the first bits of the hash, the
bucket in which the sum passes the budget is found, and only its documents are
summed again by more bits, down to the single hash. What the document
at the edge leaves of the budget is filled the same way from the smaller
documents behind it, so the thresholds are nested: a larger budget takes what a
smaller one takes, up to this filling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, rank_within, stored, words

WEIGHTS = (1, 2, 3)
MOST = 3           # times a source may be taken
TOLERANCE = 0.001  # of its target; a source this near is not filled any further
BITS = 60           # of a hash
SHIFTS = (48, 36, 0)  # bits cut off at each level: buckets of the first 12, then 24, then the hashes of one such bucket
ALL = 1 << BITS


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``key`` (the source, never NULL), ``size`` (words of the
    text, NULL: 0) and ``h`` (60 bits of the MD5 of doc_id and text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return (docs.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
                .withColumn("size", F.size(words(text)).cast("long"))
                .withColumn("h", F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` (key, source_size) with ``target``. Sources in code-point order,
    NULL last, weigh as ``weights`` repeated and share the whole size by weight;
    what would be over ``most`` times a source's size goes to the others by
    weight, until none is above. Only sums come to the driver, one job a round."""
    ranked = rank_within(sources.withColumn("none", F.col("key") == ""), [], ["none", "key"], "rank")
    weighed = stored(ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))),
                     "mix-weights")
    cap = most * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        over = level * F.col("weight") > cap
        capped, weight, n = weighed.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                                        F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
                                        F.count(F.when(over, 1))).first()
        if n == full:
            break
        full, level = n, float(total - capped) / weight if weight else level
    return weighed.select("key", "source_size", F.least(F.lit(level) * F.col("weight"), cap.cast("double")).alias("target"))


def _edges(sums: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` (key, left, ...) with ``edge``, the first bucket of ``sums``
    (key, bucket, size) that does not fit, NULL where all do, and ``before``, the
    size of the buckets before it."""
    upto = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("key").orderBy("bucket")))
    found = (upto.join(budgets.select("key", "left"), "key")
                 .groupBy("key").agg(F.min(F.when(F.col("upto") > F.col("left"), F.col("bucket"))).alias("edge"),
                                     F.coalesce(F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))), F.lit(0)).alias("before")))
    return budgets.join(found, "key")


def _sums(docs: DataFrame, level: int) -> DataFrame:
    """Sizes by source and the bits of the hash that count at this level."""
    return docs.groupBy("key", F.shiftright("h", SHIFTS[level]).alias("bucket")).agg(F.sum("size").alias("size"))


def _threshold(docs: DataFrame, budgets: DataFrame, sums: DataFrame) -> DataFrame:
    """Of ``budgets`` (key, floor, left): floor, high and cap, so that documents
    with floor < h < high of at most cap words fit into left; the hash ``edge``
    of the document that does not (high, NULL where all fit), how many ``copies``
    of it do, and what is left then. ``docs`` are those that may be taken,
    ``sums`` their sums by the first bits."""
    cur = stored(_edges(sums, budgets), "mix-edges")
    done = cur.where("edge is null").select("key", "floor", F.col("left").alias("cap"), F.lit(ALL).cast("long").alias("high"),
                                            F.lit(0).cast("long").alias("copies"), (F.col("left") - F.col("before")).alias("left"))
    some = docs
    cur = cur.where("edge is not null").select("key", "floor", F.col("left").alias("cap"), "edge", (F.col("left") - F.col("before")).alias("left"))
    for level in range(1, len(SHIFTS)):  # only the bucket at the edge, by more bits
        at = F.shiftright("h", SHIFTS[level - 1])
        some = stored(some.join(cur.select("key", "edge"), "key").where(at == F.col("edge")).drop("edge"), "mix-bucket")
        nxt = _edges(_sums(some, level), cur.drop("edge"))
        cur = stored(nxt.withColumn("left", F.col("left") - F.col("before")).drop("before"), "mix-edges")
    one = some.groupBy("key", F.col("h").alias("edge")).agg(F.max("size").alias("one"))
    last = cur.join(one, ["key", "edge"]).withColumn("copies", F.floor(F.col("left") / F.col("one")))
    return done.unionByName(last.select("key", "floor", "cap", F.col("edge").alias("high"), "copies",
                                        (F.col("left") - F.col("copies") * F.col("one")).alias("left")))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, tolerance: float = TOLERANCE) -> DataFrame:
    """What to take of ``docs`` (key, size, h; read several times, so a stored
    table), one row per source: key, source_size, target, ``times`` (how often
    all of it is taken), ``picks`` (floor, high, cap: taken once more are the
    documents with floor < h < high of at most cap words) and ``edges`` (h,
    copies: as many of equal documents with this hash). Picks are few: each
    round of filling at least leaves less than the document that did not fit."""
    first = stored(_sums(docs, 0), "mix-sums")
    sources = first.groupBy("key").agg(F.sum("size").alias("source_size"))
    goal = targets(sources, weights, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = stored(goal.withColumn("times", times), "mix-targets")
    budgets = goal.select("key", F.lit(-1).cast("long").alias("floor"),
                          F.floor(F.col("target") - F.col("times") * F.col("source_size")).alias("left"))
    rounds, sums, open_docs = [], first, docs
    while True:
        found = stored(_threshold(open_docs, budgets, sums), "mix-round")
        rounds.append(found)
        more = found.where("left > 0").join(goal.select("key", "target"), "key").where(F.col("left") > tolerance * F.col("target"))
        budgets = stored(more.select("key", F.col("high").alias("floor"), "left"), "mix-left")
        fit = (docs.join(budgets.select("key", "floor", "left"), "key").where("h > floor and size <= left and size > 0").drop("floor", "left"))
        open_docs = fit.select(*docs.columns)
        sums = stored(_sums(open_docs, 0), "mix-sums")
        if sums.isEmpty():
            break
    every = reduce(DataFrame.unionByName, rounds)
    picked = every.groupBy("key").agg(F.collect_list(F.struct("floor", "high", "cap")).alias("picks"),
                                      F.collect_list(F.when(F.col("copies") > 0, F.struct(F.col("high").alias("h"), "copies"))).alias("edges"))
    return stored(goal.join(picked, "key"), "mix-plan")


def apply(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """``docs`` (with key, size and h) with source_size, target and ``taken``: the
    words that the mix takes of each, repeats counted. Which of equal documents
    are taken, where not all are, is left open."""
    own = docs.columns
    joined = docs.join(planned, "key")
    inside = F.exists("picks", lambda p: (F.col("h") > p["floor"]) & (F.col("h") < p["high"]) & (F.col("size") <= p["cap"]))
    taken = F.col("size") * (F.col("times") + inside.cast("long"))
    edge = F.filter("edges", lambda e: e["h"] == F.col("h"))
    marked = joined.select(*own, "source_size", "target", taken.alias("taken"), F.get(edge, F.lit(0))["copies"].alias("copies"))
    if planned.where(F.size("edges") > 0).isEmpty():
        return marked.drop("copies")
    # copies of one document at an edge: the first so many in any order, dealt by a random number
    ranked = rank_within(marked.where("copies is not null").withColumn("_any", F.rand(7)), ["key", "h"], ["_any"], "_nth")
    some = ranked.withColumn("taken", F.col("taken") + F.when(F.col("_nth") < F.col("copies"), F.col("size")).otherwise(0))
    return marked.where("copies is null").drop("copies").unionByName(some.drop("copies", "_any", "_nth"))


def mix(df: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, tolerance: float = TOLERANCE, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size (words), source_size, target and taken of every row.

    Documents are taken whole: a source's taken words stay below its target by
    at most ``tolerance`` of it or, if more, by less than its smallest document
    not taken. No document is taken more than ``most`` times. Runs agree, except
    on which of equal rows (doc_id and text) are taken. NULL sources are one
    source, NULL and empty texts have size 0, NULL doc_ids are documents like
    others; other columns are left behind. An empty table gives no rows.
    """
    docs = id_text(df.withColumnRenamed(source_col, "source"), id_col, text_col, "source")
    narrow = stored(sized(docs).drop("text"), "mix-sizes")
    return apply(narrow, plan(narrow, weights, most, tolerance)).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_texts(df: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows (doc_id, text, source) of the mix itself, as often as they are
    taken; documents without words are left out."""
    docs = id_text(df, "doc_id", "text", "source")
    marked = sized(docs)
    narrow = stored(marked.drop("text"), "mix-sizes")
    taken = apply(marked, plan(narrow, weights, most, tolerance)).where("taken > 0")
    return taken.select("doc_id", "text", "source", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))).alias("repeat"))
