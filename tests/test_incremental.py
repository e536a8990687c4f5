from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardline.operators import incremental as inc


def test_change_feed_kinds(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, v string, n int")
    after = spark.createDataFrame([(1, "a", None), (2, "B", 1), (4, "d", 2)], "k int, v string, n int")
    got = sorted((r.k, r.v, r._change_type) for r in inc.change_feed(before, after, "k").collect())
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"),
                   (3, "c", "delete"), (4, "d", "insert")]


def test_refresh_rowwise_equals_full(spark):
    before = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    after = spark.createDataFrame([(1, 10), (2, 25), (4, 40)], "k int, v int")
    view = lambda df: df.select("k", (F.col("v") * 2).alias("v2"))
    ch = inc.change_feed(before, after, "k")
    got = sorted(tuple(r) for r in inc.refresh_rowwise(view, view(before), ch, "k").collect())
    assert got == sorted(tuple(r) for r in view(after).collect())


def test_refresh_by_key_handles_emptied_groups(spark):
    hdr = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    lines_old = spark.createDataFrame([(1, 5), (2, 7), (2, 1)], "k int, x int")
    lines_new = spark.createDataFrame([(1, 5), (3, 2)], "k int, x int")  # k=2 emptied, k=3 new

    def view(hdr, lines):
        agg = lines.groupBy("k").agg(F.sum("x").alias("s"))
        return hdr.join(agg, "k", "left").select("k", F.coalesce("s", F.lit(0)).alias("s"))

    old = view(hdr, lines_old)
    touched = lines_old.select("k").unionByName(lines_new.select("k"))
    got = inc.refresh_by_key(view, old, {"hdr": hdr, "lines": lines_new}, touched, "k")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5), (2, 0), (3, 2)]


def test_digest_and_exact_change_feeds_agree(spark):
    before = spark.range(2000).select("id", (F.col("id") % 7).alias("a"),
                                      F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id").cast("string")).alias("s"))
    after = (before.where("id % 11 <> 3")
                   .withColumn("a", F.when(F.col("id") % 13 == 1, F.col("a") + 1).otherwise(F.col("a")))
                   .withColumn("s", F.when(F.col("id") % 17 == 2, F.lit(None)).otherwise(F.col("s")))
                   .unionByName(spark.range(5000, 5050).select("id", F.lit(1).cast("long").alias("a"),
                                                               F.lit("x").alias("s"))))
    x = inc.change_feed(before, after, "id", by_digest=True)
    y = inc.change_feed(before, after, "id", by_digest=False)
    assert x.count() == y.count() > 0
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_changed_keys_with_duplicate_rows(spark):
    from wardline.plans.refresh import changed_keys
    old = spark.createDataFrame([("p1", "a"), ("p1", "a"), ("p2", "b"), ("p3", None)], "k string, v string")
    new = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", None), ("p4", "d")], "k string, v string")
    assert sorted(r.k for r in changed_keys(old, new, "k").collect()) == ["p1", "p4"]


def test_distinct_on_key_keeps_keys_whose_order_values_are_all_null(spark):
    from wardline.operators.dedup import distinct_on_key
    df = spark.createDataFrame([("p1", "x", None), ("p1", "y", "2001"), ("p2", "z", None)],
                               "k string, v string, o string")
    got = sorted(tuple(r) for r in distinct_on_key(df, "k", order_by="o").collect())
    assert got == [("p1", "y", "2001"), ("p2", "z", None)]


def test_null_keys_are_keys(spark):
    before = spark.createDataFrame([(1, "a"), (None, "x"), (2, "b")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (None, "y"), (3, "c")], "k int, v string")
    want = sorted([(None, "x", "update_preimage"), (None, "y", "update_postimage"), (2, "b", "delete"), (3, "c", "insert")], key=str)
    for by_digest in (True, False):
        got = inc.change_feed(before, after, "k", by_digest=by_digest)
        assert sorted(map(tuple, got.collect()), key=str) == want
    view = lambda df: df.select("k", F.upper("v").alias("u"))
    ch = inc.change_feed(before, after, "k")
    got = inc.refresh_rowwise(view, view(before), ch, "k")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, view(after).collect()), key=str)
    totals = lambda lines: lines.groupBy("k").agg(F.max("v").alias("m"))
    got = inc.refresh_by_key(lambda lines: totals(lines), totals(before), {"lines": after}, ch.select("k"), "k")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, totals(after).collect()), key=str)


def test_signed_delta_equals_full_aggregate(spark):
    from wardline.operators.incremental import apply_group_delta, change_feed, group_delta, group_result, group_state

    schema = "id int, g string, v decimal(10,2), w long"
    before = [(1, "a", "1.50", 1), (2, "a", None, 2), (3, "b", "2.00", 3), (4, "c", "7.00", None), (5, None, "1.00", 5),
              (6, "d", None, None), (7, "e", "1.00", 7), (8, "e", "-1.00", -7)]
    after = [(1, "a", "1.50", 1), (2, "a", "4.00", 2), (4, "c", None, 9), (5, None, "2.25", 5), (9, None, "1.00", 1),
             (10, "new", "3.00", 3), (3, "a", "2.00", 3), (6, "d", None, 4)]  # b and e lose all rows, 3 moves to a

    def frame(rows):
        return spark.createDataFrame([(i, g, None if v is None else Decimal(v), w) for i, g, v, w in rows], schema).repartition(3)

    old, new = frame(before), frame(after)
    changes = change_feed(old, new, "id")
    state = apply_group_delta(group_state(old, "g", ["v", "w"]), group_delta(changes, "g", ["v", "w"]), "g")
    assert sorted(map(tuple, state.collect()), key=str) == sorted(map(tuple, group_state(new, "g", ["v", "w"]).collect()), key=str)
    got = group_result(state, "g", "n", {"v": "total", "w": "weight"})
    want = new.groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.sum("w").alias("weight"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert {"b", "e"}.isdisjoint(r["g"] for r in got.collect())
    # nothing changed: the state stays; everything went: no groups are left
    same = group_delta(change_feed(old, old, "id"), "g", ["v", "w"])
    assert same.count() == 0 and apply_group_delta(group_state(old, "g", ["v"]), group_delta(change_feed(old, old, "id"), "g", ["v"]), "g").count() == 6
    gone = group_delta(change_feed(old, old.where("false"), "id"), "g", ["v", "w"])
    assert apply_group_delta(group_state(old, "g", ["v", "w"]), gone, "g").count() == 0
    # taking away what was never there is an error, not a wrong number
    with pytest.raises(Exception, match="does not have"):
        apply_group_delta(group_state(old.where("g = 'a'"), "g", ["v", "w"]), gone, "g").collect()
    with pytest.raises(ValueError, match="exact"):
        group_state(old.withColumn("v", F.col("v").cast("double")), "g", ["v"])


def test_small_delta_leaves_the_state_unshuffled(spark, tmp_path):
    from wardline.operators.incremental import apply_group_delta, group_state

    rows = spark.range(20000).select((F.col("id") % 5000).alias("g"), F.col("id").alias("v"))
    group_state(rows, "g", ["v"]).write.parquet(str(tmp_path / "state"))
    group_state(rows.where("g < 10"), "g", ["v"]).write.parquet(str(tmp_path / "delta"))
    state, delta = spark.read.parquet(str(tmp_path / "state")), spark.read.parquet(str(tmp_path / "delta"))
    out = apply_group_delta(state, delta, "g")
    assert out.count() == 5000 and out.where("n = 8").count() == 10
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_narrow_rows_are_compared_whole_and_moved_once(spark):
    kinds = "k string, g string, v decimal(18,2), d date"
    before = spark.createDataFrame([("a", "x", Decimal("1.00"), None), ("b", "x", Decimal("2.00"), None), ("c", None, None, None),
                                    (None, "x", Decimal("4.00"), None), ("e", "y", Decimal("5.00"), None)], kinds)
    after = spark.createDataFrame([("a", "x", Decimal("1.00"), None), ("b", "x", Decimal("2.50"), None), ("c", None, Decimal("0.00"), None),
                                   (None, "x", None, None), ("f", "y", Decimal("5.00"), None)], kinds)
    got = inc.change_feed(before, after, ["k", "g"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert got.columns == ["k", "g", "v", "d", inc.CHANGE_COL]
    key = lambda r: str(tuple(r))
    for by_digest in (True, False):
        want = inc.change_feed(before, after, ["k", "g"], by_digest=by_digest)
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "Join" not in plan
    # Keys that repeat give the same either way.
    twice = [before.unionByName(before.where("k <> 'e' or k is null")), after.unionByName(after)]
    for b, a in (twice, twice[::-1], (twice[0], after)):
        got, want = inc.change_feed(b, a, ["k", "g"]), inc.change_feed(b, a, ["k", "g"], by_digest=True)
        assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    # Text has no bound, so it is still compared by digest.
    wide = inc.change_feed(before.withColumn("t", F.col("k")), after.withColumn("t", F.col("k")), ["k", "g"])
    assert "changed-keys" in str(wide.inputFiles())
