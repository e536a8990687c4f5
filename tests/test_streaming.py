import os

from wardline.plans.queries import catalog
from wardline.streaming.alerts import read_alert_feed, start_alert_stream


def test_alert_stream_equals_batch_feed(spark, small_root, tmp_path):
    cat = catalog(spark, small_root)
    labs = cat.table("silver.lab_order_silver")
    src = str(tmp_path / "labs")
    # two arrivals in time order; the second re-delivers the last day of the
    # first (the copies are left out)
    labs.where("RESULTED_TS < TIMESTAMP_NTZ'1999-01-01 00:00:00'").write.parquet(os.path.join(src, "part1"))
    args = dict(encounters=cat.table("silver.encounter_silver"), providers=cat.table("silver.provider_silver"),
                departments=cat.table("silver.department_silver"), diagnoses=cat.table("silver.diagnosis_silver"))
    sink, ck = str(tmp_path / "alerts"), str(tmp_path / "ck")
    q = start_alert_stream(spark, os.path.join(src, "*"), labs.schema, sink_dir=sink, checkpoint=ck, **args)
    q.awaitTermination(300)
    labs.where("RESULTED_TS >= TIMESTAMP_NTZ'1998-12-31 00:00:00'").write.parquet(os.path.join(src, "part2"))
    q = start_alert_stream(spark, os.path.join(src, "*"), labs.schema, sink_dir=sink, checkpoint=ck, **args)
    q.awaitTermination(300)
    got = read_alert_feed(spark, sink).drop("batch")
    want = cat.table("graphql.abnormal_lab_alerts")
    assert got.count() == want.count()
    assert got.select("ALERT_BK").distinct().count() == got.count()
    assert got.select(want.columns).exceptAll(want).count() == 0


def test_stream_leaves_out_copies_and_keeps_late_rows(spark, small_root, tmp_path):
    import datetime as dt

    cat = catalog(spark, small_root)
    labs = cat.table("silver.lab_order_silver")
    enc = cat.table("silver.encounter_silver").where("STATUS <> 'Cancelled'").select("ENCOUNTER_BK").first()[0]
    schema = labs.schema

    def lab(key, day):
        return (key, enc, "CBC", None, "Abnormal", dt.datetime(2000, 1, day, 12, 0))

    src = str(tmp_path / "labs")
    args = dict(encounters=cat.table("silver.encounter_silver"), providers=cat.table("silver.provider_silver"),
                departments=cat.table("silver.department_silver"), diagnoses=cat.table("silver.diagnosis_silver"))
    sink, ck = str(tmp_path / "alerts"), str(tmp_path / "ck")
    arrivals = [[lab("L1", 10)],
                [lab("L1", 10), lab("L2", 11), lab("L2", 11)],   # L1 re-delivered
                [lab("L0", 1), lab("L3", 12), lab("L1", 10)]]    # L0 is 10 days late
    for i, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(src, f"part{i}"))
        q = start_alert_stream(spark, os.path.join(src, "*"), schema, sink_dir=sink, checkpoint=ck, **args)
        q.awaitTermination(300)
    got = sorted(r.ALERT_BK for r in read_alert_feed(spark, sink).collect())
    assert got == ["L0", "L1", "L2", "L3"]
