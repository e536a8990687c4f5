"""Places over whole tables, samples that no partitioning changes, snapshots that meet without a shuffle."""
from pyspark.sql import functions as F

from wardline.operators import incremental as inc
from wardline.operators.order import sample_fraction, sample_rows, with_position


def test_position(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 100).alias("v"))
    order = [F.col("v").desc_nulls_last(), F.col("k").asc()]
    got = {r["k"]: r["POSITION"] for r in with_position(df, order).collect()}
    rows = sorted(df.collect(), key=lambda r: (r["v"] is None, -(r["v"] or 0), r["k"]))
    assert got == {r["k"]: n + 1 for n, r in enumerate(rows)}
    tied = with_position(df, [F.col("v").asc()], "n").collect()
    assert sorted(r["n"] for r in tied) == list(range(1, 5001))
    assert with_position(df.where("false"), order).count() == 0
    one = with_position(spark.range(10).select(F.lit(1).alias("x")), [F.col("x").asc()])
    assert sorted(r["POSITION"] for r in one.collect()) == list(range(1, 11))


def test_sample_is_exact_nested_and_the_same_in_any_layout(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    want = [r["k"] for r in sample_rows(df, "k", 777, seed=3).collect()]
    assert len(set(want)) == 777
    for other in (df.repartition(13), df.repartitionByRange(3, F.desc("v")), df.coalesce(1)):
        assert sorted(r["k"] for r in sample_rows(other, "k", 777, seed=3).collect()) == sorted(want)
    assert {r["k"] for r in sample_rows(df, "k", 100, seed=3).collect()} < set(want)
    assert {r["k"] for r in sample_rows(df, "k", 777, seed=4).collect()} != set(want)
    assert sample_fraction(df, "k", 0.05).count() == 1000
    assert sample_rows(df, "k", 0).count() == 0 and sample_rows(df, "k", 30_000).count() == 20_000
    assert sample_rows(df.where("false"), "k", 5).count() == 0
    copies = spark.createDataFrame([(None, 1)] * 50 + [(1, 2)] * 50, "k long, v int")  # equal rows, exact all the same
    assert sample_rows(copies, "k", 70).count() == 70


def test_stored_snapshots_meet_without_a_shuffle(spark, tmp_path):
    before = spark.createDataFrame([(k, f"v{k}", k % 3) for k in range(500)] + [(None, "n", 1)], "k int, v string, n int")
    after = before.where("k is null or k % 10 <> 1").withColumn("v", F.when(F.col("k") % 10 == 2, "changed").otherwise(F.col("v"))) \
                  .unionByName(spark.createDataFrame([(900, "new", None)], "k int, v string, n int"))
    a = inc.store_snapshot(before, "k", str(tmp_path / "a"), 4)
    b = inc.store_snapshot(after, "k", str(tmp_path / "b"), 4)
    reopened = inc.open_snapshot(spark, str(tmp_path / "a"), "k", 4, before.schema)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for x in (a, reopened):
            got = inc.change_feed_stored(x, b, "k")
            want = inc.change_feed(before, after, "k")
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        # the keyed comparison has no exchange at all
        keyed = a.where("k is not null").join(b.where("k is not null").withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "full_outer")
        assert "Exchange" not in keyed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("snapshot_")]
    nothing = inc.change_feed_stored(a, inc.store_snapshot(before, "k", str(tmp_path / "c"), 4), "k")
    assert nothing.count() == 0  # a row with a NULL key that stayed is no change
