"""The alert feed with a watermark: late rows go to the side table, nothing is lost, state stays small."""
import datetime as dt
import os

import pytest

from wardline.plans.queries import catalog
from wardline.streaming import late
from wardline.streaming.late import AlertFolders, read, run_cycle


@pytest.fixture(scope="module")
def setup(spark, small_root):
    cat = catalog(spark, small_root)
    args = {"encounters": cat.table("silver.encounter_silver"),
            "providers": cat.table("silver.provider_silver"), "departments": cat.table("silver.department_silver"),
            "diagnoses": cat.table("silver.diagnosis_silver")}
    enc = args["encounters"].where("STATUS <> 'Cancelled'").select("ENCOUNTER_BK").first()[0]
    return cat.table("silver.lab_order_silver").schema, args, enc


def keys(df):
    return sorted(r["ALERT_BK"] for r in df.collect())


def test_late_duplicate_and_replayed_rows(spark, setup, tmp_path):
    schema, args, enc = setup
    src, root = str(tmp_path / "labs"), str(tmp_path / "alerts")
    folders = AlertFolders(root)

    def lab(key, day, hour=12, flag="Abnormal"):
        return (key, enc, "CBC", None, flag, dt.datetime(2000, 1, 1, hour) + dt.timedelta(days=day))

    def cycle(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"part{n}"))
        return run_cycle(spark, os.path.join(src, "*"), schema, root=root, delay="2 days", **args)

    cycle(0, [lab("A", 10), lab("A", 10), lab("B", 11), lab("N", 11, flag="Normal"), ("X", enc, "CBC", None, "Abnormal", None)])
    assert keys(read(spark, folders.feed)) == ["A", "B"] and read(spark, folders.late).isEmpty()
    cycle(1, [lab("B", 11), lab("C", 10), lab("D", 40)])           # B again, C out of order but in time, D moves time on
    assert keys(read(spark, folders.feed)) == ["A", "B", "C", "D"] and read(spark, folders.late).isEmpty()
    got = cycle(2, [lab("L1", 1), lab("L1", 1), lab("A", 10), lab("E", 39)])   # L1 late and twice; A replayed, far too late
    assert got["watermark"] == dt.datetime(2000, 1, 1, 12) + dt.timedelta(days=38) and got["dropped"] >= 2
    assert keys(read(spark, folders.feed)) == ["A", "B", "C", "D", "E"]
    assert keys(read(spark, folders.late)) == ["L1"]
    cycle(3, [lab("L1", 1), lab("L2", 2), lab("F", 80)])           # the late row replayed
    assert keys(read(spark, folders.feed)) == ["A", "B", "C", "D", "E", "F"]
    assert keys(read(spark, folders.late)) == ["L1", "L2"]
    got = cycle(4, [lab("G", 81)])
    assert got["state_rows"] <= 2                                    # the keys of long ago are forgotten
    # a cycle without arrivals changes nothing
    before = keys(read(spark, folders.feed)), keys(read(spark, folders.late))
    run_cycle(spark, os.path.join(src, "*"), schema, root=root, delay="2 days", **args)
    assert (keys(read(spark, folders.feed)), keys(read(spark, folders.late))) == before


def test_side_stage_taken_up_after_a_crash(spark, setup, tmp_path, monkeypatch):
    schema, args, enc = setup
    src, root = str(tmp_path / "labs"), str(tmp_path / "alerts")

    def put(n, *rows):
        data = [(k, enc, "CBC", None, "Abnormal", dt.datetime(2000, 1, 1) + dt.timedelta(days=d)) for k, d in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(os.path.join(src, f"part{n}"))

    def cycle():
        return run_cycle(spark, os.path.join(src, "*"), schema, root=root, delay="1 day", **args)

    put(0, ("A", 50))
    cycle()
    put(1, ("late", 3), ("B", 51))
    real = late.side
    monkeypatch.setattr(late, "side", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        cycle()
    monkeypatch.setattr(late, "side", real)
    put(2, ("C", 52))
    cycle()
    assert keys(read(spark, AlertFolders(root).late)) == ["late"] and keys(read(spark, AlertFolders(root).feed)) == ["A", "B", "C"]


def test_all_labs_of_the_table_arrive_once(spark, setup, small_root, tmp_path):
    """The whole table in files of mixed times: feed and side table together are the batch view."""
    schema, args, _ = setup
    cat = catalog(spark, small_root)
    src, root = str(tmp_path / "labs"), str(tmp_path / "alerts")
    labs = cat.table("silver.lab_order_silver").where("RESULT_FLAG = 'Abnormal'")
    for n in range(3):
        labs.where(f"pmod(crc32(LAB_ORDER_BK), 3) = {n}").coalesce(2).write.parquet(os.path.join(src, f"part{n}"))
        run_cycle(spark, os.path.join(src, "*"), schema, root=root, delay="400 days", **args)
    feed, side = read(spark, AlertFolders(root).feed), read(spark, AlertFolders(root).late)
    want = cat.table("graphql.abnormal_lab_alerts")
    both = feed.unionByName(side).select(want.columns)
    assert side.count() > 0 and both.count() == want.count()
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty()
