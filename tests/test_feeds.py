import datetime as dt

from pyspark.sql import functions as F

from wardline.operators import feeds

T = dt.datetime(2024, 1, 1, 12, 0)


def feed(spark):
    rows = [("a", T), ("b", T), ("c", T), ("d", T + dt.timedelta(hours=1)), ("e", None)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz")


def test_pages_split_equal_times_without_loss_or_repeat(spark):
    df = feed(spark)
    seen, cursor = [], None
    while True:
        page = feeds.read_since(df, "ts", "k", cursor=cursor, limit=2)
        rows = [r.k for r in page.collect()]
        if not rows:
            break
        seen += rows
        cursor = feeds.next_cursor(page, "ts", "k", previous=cursor)
    assert seen == ["a", "b", "c", "d"]  # NULL time never delivered, ties once each


def test_time_only_cursor_is_strict(spark):
    got = sorted(r.k for r in feeds.read_since(feed(spark), "ts", cursor=T).collect())
    assert got == ["d"]


def test_removed_rows_detects_rewrites(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", 4)], "k string, v int")
    assert [tuple(r) for r in feeds.removed_rows(old, new).collect()] == [("b", 2)]
    assert feeds.removed_rows(old, old.unionByName(new)).count() == 0


def test_tenant_scope_is_a_partition_prune(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 4).cast("string").alias("tenant"), "id")
    df.write.partitionBy("tenant").parquet(str(tmp_path / "t"))
    scoped = feeds.scope_to_tenant(spark.read.parquet(str(tmp_path / "t")), "tenant", "2")
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant" in plan and "= 2)" in plan
    assert scoped.count() == 25


def test_hmo_feed_has_no_patient_name(spark, small_root):
    from wardline.plans.queries import catalog
    hmo = catalog(spark, small_root).table("graphql.hmo_encounter_summary")
    feeds.forbid_columns(hmo, ["FULL_NAME", "PHONE", "DATE_OF_BIRTH"])
    try:
        feeds.forbid_columns(hmo.withColumn("full_name", F.lit("x")), ["FULL_NAME"])
        raise AssertionError("expected refusal")
    except ValueError:
        pass


def test_removed_rows_by_key_digest(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 4)], "k string, v int")
    assert [tuple(r) for r in feeds.removed_rows(old, new, key="k").collect()] == [("b", 2)]


def test_until_keeps_the_cursor_behind_the_clock(spark):
    now = T + dt.timedelta(minutes=30)
    df = feed(spark)
    page = feeds.read_since(df, "ts", "k", cursor=None, limit=10, until=now)
    assert [r.k for r in page.collect()] == ["a", "b", "c"]  # "d" is in the future
    cursor = feeds.next_cursor(page, "ts", "k")
    assert cursor[0] <= now
    # a row that arrives later with a time before "d" but after the cursor is not lost
    late = df.unionByName(spark.createDataFrame([("c2", T + dt.timedelta(minutes=40))], "k string, ts timestamp_ntz"))
    nxt = feeds.read_since(late, "ts", "k", cursor=cursor, limit=10, until=T + dt.timedelta(hours=2))
    assert [r.k for r in nxt.collect()] == ["c2", "d"]
