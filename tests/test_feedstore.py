"""Feeds stored by time: polls skip row groups, append-only checks skip what has not changed."""
import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wardline.operators import feeds, feedstore

START = dt.datetime(2024, 3, 1)
COLS = ["k", "ts", "v"]


def rows_scanned(df):
    """(rows, files) that the scans of an executed plan gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "Adaptive" in plan.getClass().getName():
        plan = plan.executedPlan()
    rows = files = 0
    it = plan.collectLeaves().iterator()
    while it.hasNext():
        leaf = it.next()
        if "QueryStage" in leaf.getClass().getName():
            raise AssertionError("look below the stage")
        m = leaf.metrics()
        if m.contains("numFiles"):
            rows += m.get("numOutputRows").get().value()
            files += m.get("numFiles").get().value()
    return rows, files


@pytest.fixture(scope="module")
def rows(spark):
    minute = F.col("id") * 7 % 40_000  # ties: several rows a minute, out of order
    ts = F.when(F.col("id") % 501 == 500, None).otherwise(F.timestamp_seconds(minute * 60 + int(START.replace(tzinfo=dt.UTC).timestamp())))
    return spark.range(60_000).select(F.col("id").alias("k"), ts.cast("timestamp_ntz").alias("ts"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


@pytest.fixture(scope="module")
def path(rows, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("feed") / "feed")
    feedstore.write_feed(rows, p, "ts", "k", unit="day", row_group_bytes=16 << 10)
    return p


def test_poll_reads_the_new_end_only(spark, rows, path):
    feed = feedstore.open_feed(spark, path, rows.schema)
    cursor = (START + dt.timedelta(days=20, hours=13), 100)
    got = feedstore.poll(feed, "ts", "k", cursor, unit="day")
    want = feeds.read_since(rows, "ts", "k", cursor)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # what the footers say has to be read: days after the cursor's, and of its day the row groups that reach it
    at, groups, least = feedstore._micros(cursor[0]), 0, 0
    for f in glob.glob(f"{path}/_from=2024*/*.parquet"):
        day = dt.date.fromisoformat(f.split("_from=")[1][:10])
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            col = [c for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == "_at"][0]
            if day >= cursor[0].date() and meta.row_group(g).column(col).statistics.max >= at:
                least += meta.row_group(g).num_rows
    scanned, _ = rows_scanned(got)
    assert groups > 100 and scanned <= least < rows.count() // 3
    day_rows = rows.where(F.to_date("ts") >= F.lit(cursor[0].date())).count()
    assert scanned < day_rows  # of the cursor's own day, row groups before it are skipped


def test_page_ends_at_the_day_that_fills_it(spark, rows, path):
    feed = feedstore.open_feed(spark, path, rows.schema)
    days = feedstore.digests(feed, COLS)
    for cursor in (None, (START + dt.timedelta(days=3, hours=1), 5), (START + dt.timedelta(days=27, hours=18), 0)):
        for until in (None, START + dt.timedelta(days=6)):
            got = feedstore.poll(feed, "ts", "k", cursor, limit=1500, until=until, digest=days, unit="day").collect()
            want = feeds.read_since(rows, "ts", "k", cursor, limit=1500, until=until).collect()
            assert got == want
    page = feedstore.poll(feed, "ts", "k", (START + dt.timedelta(days=3, hours=1), 5), limit=1500, digest=days, unit="day")
    text = page._jdf.queryExecution().toString()
    assert "PartitionFilters" in text and "2024-03-05" in text  # a page ends a day later, not at the feed's end


def test_months_and_years(spark, rows, tmp_path):
    cursor = (START + dt.timedelta(days=20, hours=13), 100)
    want = sorted(map(tuple, feeds.read_since(rows, "ts", "k", cursor).collect()))
    for unit in ("month", "year"):
        p = str(tmp_path / unit)
        feedstore.write_feed(rows, p, "ts", "k", unit=unit, row_group_bytes=16 << 10)
        got = feedstore.poll(feedstore.open_feed(spark, p, rows.schema), "ts", "k", cursor, unit=unit)
        assert sorted(map(tuple, got.collect())) == want
        assert rows_scanned(got)[0] < rows.count() // 2
    with pytest.raises(ValueError):
        feedstore.write_feed(rows, str(tmp_path / "x"), "ts", "k", unit="week")


def test_append(spark, rows, path, tmp_path):
    p = str(tmp_path / "feed")
    half = F.col("k") < 20_000
    feedstore.write_feed(rows.where(half), p, "ts", "k", unit="day")
    feedstore.write_feed(rows.where(~half), p, "ts", "k", unit="day", mode="append")
    a, b = (feedstore.digests(feedstore.open_feed(spark, x, rows.schema), COLS) for x in (path, p))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_append_only_check_reads_changed_days_only(spark, rows, path, tmp_path):
    old = feedstore.open_feed(spark, path, rows.schema)
    changed = (rows.withColumn("v", F.when(F.col("k") == 70, "other").otherwise(F.col("v")))      # one row changed
                   .where("k <> 500 and k <> 71")                                                 # one without a time and one other gone
                   .unionByName(rows.where("k < 30").withColumn("k", F.col("k") + 1_000_000)))    # rows that came
    p = str(tmp_path / "new")
    feedstore.write_feed(changed, p, "ts", "k", unit="day")
    new = feedstore.open_feed(spark, p, rows.schema)
    a, b = feedstore.digests(old, COLS), feedstore.digests(new, COLS)
    gone = feedstore.removed_from_feed(old, new, COLS, "k", a, b)
    assert sorted(r["k"] for r in gone.collect()) == [70, 71, 500]
    days = feedstore.differing(a, b)
    assert None in days and 1 < len(days) <= 4  # the first day got rows: it differs, and nothing of it is gone
    read = feedstore.of_stretches(old, days)
    scanned, _ = rows_scanned(read)
    assert 0 < scanned < rows.count() // 5
    same = feedstore.removed_from_feed(old, old, COLS, "k", a, a)
    assert same.count() == 0 and rows_scanned(feedstore.of_stretches(old, feedstore.differing(a, a)))[0] == 0
    assert feedstore.removed_from_feed(old, new, COLS).count() == 3  # by whole rows, digests made on the way


def test_empty_feed(spark, rows, tmp_path):
    p = str(tmp_path / "none")
    feedstore.write_feed(rows.where("false"), p, "ts", "k")
    feed = feedstore.open_feed(spark, p, rows.schema)
    assert feedstore.poll(feed, "ts", "k", limit=5, digest=feedstore.digests(feed, COLS)).count() == 0
    assert feedstore.removed_from_feed(feed, feed, COLS, "k").count() == 0


def test_append_only_check_cleanses_the_lab_lines_once(spark, small_root, monkeypatch):
    from wardline.plans import operator_queries  # noqa: PLC0415
    fed = []

    def recorded(rows, *args, **kw):
        fed.append(rows.inputFiles())
        return write_feed(rows, *args, **kw)

    write_feed = feedstore.write_feed
    monkeypatch.setattr(feedstore, "write_feed", recorded)
    operator_queries.feed_append_only_check(spark, small_root)
    assert len(fed) == 2 and not any("lineitem" in f for files in fed for f in files)
