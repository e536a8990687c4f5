"""Change feeds between snapshots and incremental refresh of views.

Three ways to keep a view: :func:`refresh_rowwise` (a row in, a row out),
:func:`refresh_by_key` (recompute the keys that changed) and, for counts and
sums, :func:`apply_group_delta`, which adds what came and takes away what went
without reading the rows that stayed.

All operators are joins on the key. Diffs move narrow rows (key plus a row
digest or a per-key signature) through the shuffle and touch full rows only
for the keys that changed; refreshes replace only the affected keys with
anti/semi joins. ``change_feed`` assumes a key is unique within a snapshot
(business keys are); ``key_signatures`` does not.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INSERT, DELETE, PRE, POST = "insert", "delete", "update_preimage", "update_postimage"
CHANGE_COL = "_change_type"
DIGEST_BYTES = 32


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner", right_keys=None) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL. The right side's keys are
    dropped; in a full outer join a key is taken from the side that has it."""
    keys, right_keys = list(keys), list(right_keys or keys)
    r = right.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(right_keys)],
                     *[c for c in right.columns if c not in right_keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & left[k].eqNullSafe(r[f"__k{i}"])
    j = left.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return j
    for i, k in enumerate(keys):
        if how == "full_outer":
            j = j.withColumn(k, F.coalesce(F.col(k), F.col(f"__k{i}")))
        j = j.drop(f"__k{i}")
    return j


def row_digest(cols) -> "F.Column":
    """128-bit digest of a row's values (md5 of their JSON form; field names
    keep NULLs and empty strings apart). Two rows with equal values always
    get equal digests; unequal rows collide with probability ~2^-128."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in cols])))


def _narrow(df: DataFrame, cols) -> bool:
    """Whether the values of ``cols`` take no more room in a row than a digest
    of them. Only kinds that are equal exactly when their digests are."""
    room = 0
    for c in cols:
        kind = df.schema[c].dataType
        if kind.typeName() == "decimal":
            room += 8 if kind.precision <= 18 else 16
        elif kind.typeName() in ("byte", "short", "integer", "long", "date", "boolean"):
            room += 8
        else:
            return False
    return room <= DIGEST_BYTES


def change_feed(before: DataFrame, after: DataFrame, keys, compare=None, by_digest: bool | None = None) -> DataFrame:
    """Row-level diff of two snapshots with the same columns.

    Output: the snapshot columns plus ``_change_type`` in
    ``insert | delete | update_preimage | update_postimage``; unchanged rows
    are not emitted. Values are compared over ``compare`` columns (default:
    all non-key columns), NULL-safely; a NULL key is a key like any other.

    ``by_digest=True``: only ``(key, digest)`` pairs go through the full
    outer join, so the shuffle carries a key and 32 bytes per row instead of
    whole rows; full rows are then fetched for the changed keys only (a join
    with the changed-key set, broadcast by AQE when it is small, which is the
    usual case of a daily diff). The changed-key set is staged in the
    checkpoint folder, so calling this runs one job over the two digests.
    ``by_digest=False`` compares whole rows in the join (exact, lazy,
    shuffles both snapshots in full, once). By default rows whose values are no
    wider than a digest are compared whole, others by digest.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = before.columns
    vals = [c for c in cols if c not in keys]
    compare = list(compare) if compare else vals
    if by_digest is None:
        if all(_narrow(df, vals) for df in (before, after)):
            return _change_feed_narrow(before, after, keys, cols, compare)
        by_digest = True
    if by_digest:
        return _change_feed_by_digest(before, after, keys, cols, compare)
    b = before.select(*keys, F.struct(*cols).alias("_b"), F.lit(True).alias("_in_b"))
    a = after.select(*keys, F.struct(*cols).alias("_a"), F.lit(True).alias("_in_a"))
    return _changes(join_null_safe(b, a, keys, "full_outer"), cols, compare)


def _change_feed_narrow(before, after, keys, cols, compare) -> DataFrame:
    """Rows whose values are few bytes: both snapshots meet by key in one shuffle,
    each row moved once. A key that repeats gives what it gives by digest: each
    of its rows once for every pair of rows that differ (with the key in one
    snapshot only, for every row)."""
    rows = before.select(*cols, F.lit(True).alias("_old")).unionByName(after.select(*cols, F.lit(False).alias("_old")))
    key, alike = Window.partitionBy(*keys), Window.partitionBy(*keys, *[c for c in compare if c not in keys])
    old = F.col("_old")
    n = (rows.select("*", F.count_if(old).over(key).alias("_nb"), F.count_if(~old).over(key).alias("_na"))
             .withColumn("_twins", F.count_if(~old).over(alike))
             .withColumn("_same", F.sum(F.when(old, F.col("_twins")).otherwise(0)).over(key)))
    kind = (F.when(old & (F.col("_na") == 0), F.lit(DELETE)).when(old, F.lit(PRE))
             .when(F.col("_nb") == 0, F.lit(INSERT)).otherwise(F.lit(POST)))
    times = F.when((F.col("_nb") > 0) & (F.col("_na") > 0), F.col("_nb") * F.col("_na") - F.col("_same")).otherwise(F.col("_nb") + F.col("_na"))
    each = n.where(times > 0).withColumn("_times", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    return each.select(*cols, kind.alias(CHANGE_COL))


def _changes(j: DataFrame, cols, compare) -> DataFrame:
    """The change rows of two snapshots joined in full by key (``_b``, ``_in_b``,
    ``_a``, ``_in_a``)."""
    same = F.struct(*[F.col("_b")[c] for c in compare]).eqNullSafe(
        F.struct(*[F.col("_a")[c] for c in compare]))
    in_b, in_a = F.col("_in_b").isNotNull(), F.col("_in_a").isNotNull()
    # Each joined row yields 0, 1 or 2 change rows: build them as an array
    # of (type, row) pairs and explode; no row pairs beyond the key match.
    pre = F.struct(F.lit(PRE).alias("t"), F.col("_b").alias("r"))
    post = F.struct(F.lit(POST).alias("t"), F.col("_a").alias("r"))
    ins = F.struct(F.lit(INSERT).alias("t"), F.col("_a").alias("r"))
    dele = F.struct(F.lit(DELETE).alias("t"), F.col("_b").alias("r"))
    first = (F.when(in_b & ~in_a, dele).when(~in_b & in_a, ins).when(~same, pre))
    second = F.when(in_b & in_a & ~same, post)
    changes = F.filter(F.array(first, second), lambda x: x.isNotNull())
    return (j.select(F.explode(changes).alias("_c"))
             .select(*[F.col("_c.r")[c].alias(c) for c in cols], F.col("_c.t").alias(CHANGE_COL)))


def store_snapshot(df: DataFrame, key: str, path: str, buckets: int) -> DataFrame:
    """Write a snapshot to ``path`` bucketed and sorted by ``key``, one file a
    bucket, and return it as read back. Snapshots with the same number of buckets
    meet by key without a shuffle; choose it for files of some 100 MB and keep it.
    """
    spark = df.sparkSession
    name = f"snapshot_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return open_snapshot(spark, path, key, buckets, df.schema, name)


def open_snapshot(spark, path: str, key: str, buckets: int, schema, name: str | None = None) -> DataFrame:
    """A stored snapshot by its path. The layout of a bucketed table is known to
    the session's catalog only, so it is entered there and taken out again; the
    files stay."""
    if name is None:
        name = f"snapshot_{uuid.uuid4().hex[:12]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
                  f"LOCATION '{where}'")
    df = spark.table(name)
    df.schema  # resolved now, with its layout
    spark.sql(f"DROP TABLE {name}")
    return df


def change_feed_stored(before: DataFrame, after: DataFrame, key: str, compare=None) -> DataFrame:
    """:func:`change_feed` of two snapshots from :func:`store_snapshot` with the
    same number of buckets: lazy, whole rows compared, nothing shuffled. Rows
    with a NULL key, of which a snapshot has one at most, are compared apart."""
    cols = before.columns
    compare = list(compare) if compare else [c for c in cols if c != key]
    known = F.col(key).isNotNull()

    def side(df, tag):
        return df.where(known).select(F.col(key).alias(f"__k{tag}"), F.struct(*cols).alias(f"_{tag}"), F.lit(True).alias(f"_in_{tag}"))

    j = side(before, "b").join(side(after, "a"), F.col("__kb") == F.col("__ka"), "full_outer")
    without = change_feed(before.where(~known), after.where(~known), key, compare, by_digest=False)
    return _changes(j, cols, compare).unionByName(without)


def _change_feed_by_digest(before, after, keys, cols, compare) -> DataFrame:
    hb = before.select(*keys, row_digest(compare).alias("_hb"))
    ha = after.select(*keys, row_digest(compare).alias("_ha"))
    changed = join_null_safe(hb, ha, keys, "full_outer").where(~F.col("_hb").eqNullSafe(F.col("_ha")))
    # Stage the changed keys (narrow: key and two digests) in the checkpoint
    # folder: the digest join runs once, and the next join sees the set's real
    # size, so it is broadcast when small instead of re-shuffling full rows.
    from ..sources.sinks import materialize  # noqa: PLC0415
    changed = materialize(changed, "changed-keys")
    # One join of both snapshots' rows (tagged by side) with the changed keys.
    rows = (before.select(*cols, F.lit(True).alias("_old"))
                  .unionByName(after.select(*cols, F.lit(False).alias("_old"))))
    j = join_null_safe(rows, changed, keys)
    kind = (F.when(F.col("_old") & F.col("_ha").isNull(), F.lit(DELETE))
             .when(F.col("_old"), F.lit(PRE))
             .when(F.col("_hb").isNull(), F.lit(INSERT))
             .otherwise(F.lit(POST)))
    return j.select(*cols, kind.alias(CHANGE_COL))


def key_signatures(df: DataFrame, key: str) -> DataFrame:
    """Per key: row count and two independent 64-bit hash sums over the
    key's rows. Equal multisets of rows give equal signatures; the sums are
    partial aggregates, so a key holding a third of the rows is combined on
    each map task before the shuffle."""
    j = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.xxhash64(j).cast("decimal(38,0)")).alias("_h1"),
        F.sum(F.xxhash64(j, F.lit("#2")).cast("decimal(38,0)")).alias("_h2"))


def changed_keys(changes: DataFrame, keys) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return changes.select(*keys).distinct()


def refresh_rowwise(view_fn: Callable[[DataFrame], DataFrame], old: DataFrame, changes: DataFrame,
                    in_keys, out_keys=None) -> DataFrame:
    """Refresh a row-wise view (projection, casts, per-row filters).

    Each output row depends only on the input row with the same key, so:
    drop the old output rows of every changed key, then append the view of
    the post-images (inserts and update post-images). ``in_keys`` name the
    key in the input, ``out_keys`` the same key in the view's output.
    """
    in_keys = [in_keys] if isinstance(in_keys, str) else list(in_keys)
    out_keys = in_keys if out_keys is None else ([out_keys] if isinstance(out_keys, str) else list(out_keys))
    touched = changed_keys(changes, in_keys)
    for i, o in zip(in_keys, out_keys):
        touched = touched.withColumnRenamed(i, o)
    kept = join_null_safe(old, touched, out_keys, "left_anti")
    post = changes.where(F.col(CHANGE_COL).isin(INSERT, POST)).drop(CHANGE_COL)
    return kept.unionByName(view_fn(post))


def refresh_by_key(view_fn: Callable[..., DataFrame], old: DataFrame, inputs: dict,
                   touched: DataFrame, key: str, input_keys: dict | None = None) -> DataFrame:
    """Refresh a view whose output rows for ``key`` depend only on input rows
    with the same key (GROUP BY key, LEFT JOIN on key).

    ``inputs``: the *current* input DataFrames by name; ``touched``: keys
    whose inputs changed (a one-column DataFrame named ``key``). The view is
    recomputed on the inputs restricted (left-semi join) to the touched
    keys; old rows of those keys are replaced. A key whose inputs all
    disappeared simply yields no recomputed row; a left-joined side that
    emptied yields the view's defaults.
    """
    input_keys = input_keys or {}
    touched = touched.select(key).distinct()
    scoped = {}
    for name, df in inputs.items():
        k = input_keys.get(name, key)
        scoped[name] = join_null_safe(df, touched, [k], "left_semi", right_keys=[key])
    fresh = view_fn(**scoped)
    return join_null_safe(old, touched, [key], "left_anti").unionByName(fresh)


def _exact(df: DataFrame, sums) -> None:
    for c in sums:
        kind = df.schema[c].dataType.typeName()
        if kind in ("float", "double"):
            raise ValueError(f"{c} is {kind}: sums that are added to and taken from must be exact (integers or decimals)")


def group_state(df: DataFrame, keys, sums=()) -> DataFrame:
    """What has to be kept of a GROUP BY with counts and sums so that it can be
    maintained: the keys, ``n`` (rows), and per summed column ``<c>_n`` (values
    that are not NULL) and ``<c>_sum`` (0 without any). Partial aggregates, so a hot key is combined
    before the shuffle. Sums are taken over integers and decimals only."""
    return _signed_groups(df.withColumn("__sign", F.lit(1)), keys, sums)


def _signed_groups(df: DataFrame, keys, sums) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    _exact(df, sums)
    sign = F.col("__sign")
    aggs = [F.sum(sign.cast("long")).alias("n")]
    for c in sums:
        kind = df.schema[c].dataType
        wide = f"decimal(38,{kind.scale})" if kind.typeName() == "decimal" else "decimal(38,0)"
        value = F.when(sign > 0, F.col(c).cast(wide)).otherwise(-F.col(c).cast(wide))
        aggs += [F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign.cast("long"))), F.lit(0)).cast("long").alias(f"{c}_n"),
                 F.coalesce(F.sum(value).cast(wide), F.lit(0).cast(wide)).alias(f"{c}_sum")]
    return df.groupBy(*keys).agg(*aggs)


def group_delta(changes: DataFrame, keys, sums=()) -> DataFrame:
    """What a change feed does to a :func:`group_state`: rows that came (insert,
    update_postimage) count plus, rows that went (delete, update_preimage)
    minus. Groups whose changes cancel out are left out."""
    sign = F.when(F.col(CHANGE_COL).isin(INSERT, POST), 1).otherwise(-1)
    delta = _signed_groups(changes.withColumn("__sign", sign), keys, sums)
    moved = F.col("n") != 0
    for c in sums:
        moved = moved | (F.col(f"{c}_n") != 0) | (F.col(f"{c}_sum") != 0)
    return delta.where(moved)


def apply_group_delta(state: DataFrame, delta: DataFrame, keys) -> DataFrame:
    """``state`` after ``delta`` (both as :func:`group_state` has them; every
    group once). Groups that are down to no rows are gone, new ones are added, a
    NULL key is a key like others. A group that would have fewer than no rows
    was not in the state that the changes were made on: the job fails.

    The state is not shuffled when the delta is small enough to broadcast (it
    should be stored, so that Spark knows its size); otherwise both meet by key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in state.columns if c not in keys]
    kinds = {f.name: f.dataType for f in state.schema}
    change = delta.select(*keys, *[F.col(c).alias(f"__d_{c}") for c in values])
    joined = join_null_safe(state, change, keys, "left")
    both = joined.select(*keys, *[(F.col(c) + F.coalesce(F.col(f"__d_{c}"), F.lit(0))).cast(kinds[c]).alias(c) for c in values])
    known = join_null_safe(state.select(*keys), delta.select(*keys), keys, "left_semi").withColumn("__known", F.lit(True))
    new = join_null_safe(delta, known, keys, "left").where("__known is null")

    def counted(known):  # the test names a column of the join, so that it is not made before it
        return F.when(known & (F.col("n") < 0), F.raise_error(F.lit("the changes take rows away that the state does not have"))) \
                .otherwise(F.col("n"))

    new = new.withColumn("n", counted(F.col("__known").isNull())).select(*keys, *[F.col(c).cast(kinds[c]).alias(c) for c in values])
    return both.withColumn("n", counted(F.lit(True))).unionByName(new).where("n <> 0")


def group_result(state: DataFrame, keys, count: str, sums: dict) -> DataFrame:
    """The aggregate that a state stands for: the keys, ``count`` and per entry
    (column: name) of ``sums`` its sum, NULL where all values are."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return state.select(*keys, F.col("n").alias(count),
                        *[F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum")).alias(name) for c, name in sums.items()])


def multiset_minus(a: DataFrame, b: DataFrame, chunk: int = 100_000) -> DataFrame:
    """``a.exceptAll(b)`` (rows of ``a`` not matched one-for-one in ``b``),
    safe when a group of identical rows holds a large share of the data.

    Identical rows are counted per row digest on both sides (partial
    aggregates, so a hot group is combined map-side); the surplus copies are
    then regenerated in chunks of at most ``chunk`` rows spread over tasks,
    instead of being emitted from one aggregated row by one task.
    """
    cols = a.columns
    da = a.select(row_digest(cols).alias("_d"), F.struct(*cols).alias("_r"))
    db = b.select(*cols).select(row_digest(cols).alias("_d"))
    ca = da.groupBy("_d").agg(F.count(F.lit(1)).alias("_na"), F.any_value("_r").alias("_r"))
    cb = db.groupBy("_d").agg(F.count(F.lit(1)).alias("_nb"))
    diff = (ca.join(cb, "_d", "left")
              .select("_d", "_r", (F.col("_na") - F.coalesce(F.col("_nb"), F.lit(0))).alias("_n"))
              .where(F.col("_n") > 0))
    n_chunks = ((F.col("_n") - 1) / F.lit(chunk)).cast("long") + 1
    parts = (diff.select("_d", "_r", "_n", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("_c"))
                 .repartition("_d", "_c"))
    size = F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_c") * chunk)
    return parts.select(F.explode(F.array_repeat("_r", size.cast("int"))).alias("_r")).select("_r.*")
