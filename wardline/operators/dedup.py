"""Duplicate removal.

``keep_first`` is ``row_number() OVER (PARTITION BY keys ORDER BY ...) = 1``.
Spark plans that shape as a ``WindowGroupLimit``: each map task first keeps
only its own best row per key, so a key holding a third of all rows is cut
down to one row per task *before* the shuffle, and the final window sorts a
handful of rows per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .._col import as_col


def keep_first(df: DataFrame, keys, order_by, tie_break=()) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` then ``tie_break``.

    ``order_by`` items are Columns (use ``F.col(x).asc_nulls_last()`` etc.)
    or names (ascending). Add ``tie_break`` columns to make the survivor
    deterministic when ``order_by`` ties.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [as_col(c) for c in list(order_by) + list(tie_break)]
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def distinct_on_key(df: DataFrame, keys, order_by=None) -> DataFrame:
    """One row per key.

    Without ``order_by`` this is ``dropDuplicates`` (an aggregate with a
    map-side partial step; which row survives is up to Spark). With
    ``order_by`` the survivor is the smallest ``order_by`` value (NULLs
    last, never dropped), picked by ``min_by`` — also a partial aggregate,
    so hot keys shrink before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order_by is None:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in rest])
    return (df.groupBy(*keys)
              .agg(F.min_by(packed, F.struct(as_col(order_by).isNull(), as_col(order_by))).alias("__row"))
              .select(*keys, *[F.col("__row")[c].alias(c) for c in rest]))


def dropped_duplicates(df: DataFrame, keys, order_by, tie_break=(), chunk: int = 100_000) -> DataFrame:
    """The rows ``keep_first`` removes (input minus survivors, as a multiset).

    Same result as ``df.exceptAll(keep_first(...))`` but safe when one group
    of identical copies holds a large share of the rows: ``exceptAll``
    re-emits all surplus copies of a row from one aggregated row, i.e. from
    one task. Here rows that differ from their key's survivor pass straight
    through a join on the key (AQE can split a hot key there); copies equal
    to the survivor are counted map-side and regenerated in chunks of at
    most ``chunk`` rows, the chunks hash-spread over tasks.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    surv = keep_first(df, keys, order_by, tie_break)
    rk = [f"__s_{i}" for i in range(len(keys))]
    s = surv.select(*[F.col(k).alias(r) for k, r in zip(keys, rk)], F.struct(*cols).alias("_s"))

    def on(left):  # NULL-safe key equality (a NULL key is one group, as in the dedup)
        cond = None
        for k, r in zip(keys, rk):
            c = left[k].eqNullSafe(s[r])
            cond = c if cond is None else cond & c
        return cond

    rows = df.select(*keys, F.struct(*cols).alias("_r"))
    j = rows.join(s, on(rows), "inner")
    same = F.col("_r").eqNullSafe(F.col("_s"))
    differ = j.where(~same).select("_r.*")
    # surplus copies of each survivor: (copies - 1), generated in chunks
    surplus = (j.where(same).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1))
    n_chunks = ((F.col("_n") - 2) / F.lit(chunk)).cast("long") + 1
    chunks = (surplus.select(*keys, "_n", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("_c"))
                     .repartition(*keys, "_c"))
    size = F.least(F.lit(chunk).cast("long"), F.col("_n") - 1 - F.col("_c") * chunk)
    copies = (chunks.join(s, on(chunks), "inner")
                    .select(F.explode(F.array_repeat(F.col("_s"), size.cast("int"))).alias("_r"))
                    .select("_r.*"))
    return differ.unionByName(copies)
