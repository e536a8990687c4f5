"""Refreshes publish all tables at once or nothing; readers keep the version they began with."""
import dataclasses
import os
import signal
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from wardline.operators.quality import Check, CheckFailed
from wardline.plans import VIEWS
from wardline.plans.pipeline import run_pipeline
from wardline.plans.queries import QUERY_AS_OF
from wardline.plans.refresh import refresh_incremental
from wardline.plans.registry import Catalog
from wardline.sources import fs, synth, versions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SOME = ["silver.encounter_silver", "silver.bed_assignment_silver"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Two states of small inputs; in the second some bills differ, some encounters are gone."""
    folder = tmp_path_factory.mktemp("inputs")
    a = synth.write_inputs(spark, str(folder / "a"), n_patients=60, n_providers=8, n_departments=4, n_diagnoses=9, n_encounters=300)
    b = str(folder / "b")
    for name in ("region", "nation", "customer", "supplier", "part", "lineitem"):
        spark.read.parquet(f"{a}/{name}.parquet").write.parquet(f"{b}/{name}.parquet")
    orders = spark.read.parquet(f"{a}/orders.parquet").where("o_orderkey % 17 <> 3")
    orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 3).otherwise(F.col("o_totalprice"))) \
          .write.parquet(f"{b}/orders.parquet")
    return a, b


def test_killed_between_stage_and_publish(spark, inputs, tmp_path):
    a, b = inputs
    wh = str(tmp_path / "wh")
    run_pipeline(spark, a, wh, as_of=QUERY_AS_OF, register=False)
    reader = Catalog(spark, a, warehouse=wh, as_of=QUERY_AS_OF)
    before = {n: rows(reader.table(n)) for n in VIEWS if n != "gold.dim_date"}
    script = tmp_path / "killed.py"
    script.write_text(f"""
import os, signal, sys
sys.path.insert(0, {ROOT!r})
from wardline.plans.queries import QUERY_AS_OF
from wardline.plans.refresh import refresh_incremental
from wardline.session import build_session
from wardline.sources import versions
versions.Staging.publish = lambda self: os.kill(os.getpid(), signal.SIGKILL)
refresh_incremental(build_session("local[4]", 4), {b!r}, {wh!r}, as_of=QUERY_AS_OF, register=False)
""")
    done = subprocess.run([sys.executable, str(script)], capture_output=True, timeout=900, check=False)
    assert done.returncode == -signal.SIGKILL, done.stderr[-2000:]
    # all was staged, none of it is seen, by readers old and new
    assert len(os.listdir(os.path.join(wh, "silver", "encounter_silver"))) == 2
    late = Catalog(spark, a, warehouse=wh, as_of=QUERY_AS_OF)
    for cat in (reader, late):
        cat._cache.clear()
        assert {n: rows(cat.table(n)) for n in before} == before
    # the next refresh works as if nothing had been, and the leftovers can be cleaned
    refresh_incremental(spark, b, wh, as_of=QUERY_AS_OF, register=False)
    new = Catalog(spark, b, warehouse=wh, as_of=QUERY_AS_OF)
    assert new.version.number == 2 and rows(new.table("gold.fact_encounter")) != before["gold.fact_encounter"]
    assert rows(late.table("silver.encounter_silver")) == before["silver.encounter_silver"]
    full = str(tmp_path / "full")
    run_pipeline(spark, b, full, as_of=QUERY_AS_OF, register=False)
    want = Catalog(spark, b, warehouse=full, as_of=QUERY_AS_OF)
    for n in before:
        cols = sorted(want.table(n).columns)
        assert rows(new.table(n).select(cols)) == rows(want.table(n).select(cols)), n
    assert versions.clean(spark, wh, keep=1, abandoned_hours=24)  # version 1 goes where 2 does not share it
    gone = versions.clean(spark, wh, keep=1, abandoned_hours=0)   # and then what the killed run left
    assert any(g.startswith("silver/encounter_silver/") for g in gone)
    cat = Catalog(spark, b, warehouse=wh, as_of=QUERY_AS_OF)
    assert rows(cat.table("gold.fact_encounter")) == rows(new.table("gold.fact_encounter"))


@pytest.mark.parametrize("incremental", [False, True])
def test_a_failing_check_publishes_nothing(spark, inputs, tmp_path, monkeypatch, incremental):
    a, b = inputs
    wh = str(tmp_path / "wh")
    run_pipeline(spark, a, wh, as_of=QUERY_AS_OF, register=False)
    spec = VIEWS["silver.encounter_silver"]
    bad = Check("none_over_ten", "BILLED_AMOUNT < 10", action="fail")
    monkeypatch.setitem(VIEWS, spec.name, dataclasses.replace(spec, checks=(*spec.checks, bad)))
    folders = {n: os.listdir(os.path.join(wh, *n.split("."))) for n in VIEWS}
    with pytest.raises(CheckFailed):
        if incremental:
            refresh_incremental(spark, b, wh, as_of=QUERY_AS_OF, register=False)
        else:
            run_pipeline(spark, b, wh, as_of=QUERY_AS_OF, register=False)
    assert versions.current(spark, wh).number == 1
    assert folders == {n: os.listdir(os.path.join(wh, *n.split("."))) for n in VIEWS}


def test_two_refreshes_at_once(spark, tmp_path):
    wh = str(tmp_path / "wh")
    one, two = versions.Staging(spark, wh), versions.Staging(spark, wh)
    one.write("silver.t", spark.range(3))
    two.write("silver.t", spark.range(5))
    one.publish()
    with pytest.raises(versions.PublishConflict):
        two.publish()
    assert versions.read(spark, wh, versions.current(spark, wh).tables["silver.t"]).count() == 3
    # a pointer that was not written to its end is no version, and its number is not used again
    fs.write_text(spark, f"{wh}/_versions/00000002.json", '{"version": 2, "tab')
    assert versions.current(spark, wh).number == 1
    three = versions.Staging(spark, wh)
    three.write("silver.u", spark.range(1))
    assert three.publish().number == 3 and set(versions.current(spark, wh).tables) == {"silver.t", "silver.u"}


def test_partitions_are_replaced_by_version(spark, tmp_path):
    wh = str(tmp_path / "wh")
    data = [(i, None if i % 4 == 3 else i % 4, "a/b c" if i % 4 == 1 else "x") for i in range(40)]
    base = versions.Staging(spark, wh)
    base.write("silver.t", spark.createDataFrame(data, "id long, y int, s string"), partition_by=("y", "s"))
    base.publish()
    want = {r for r in data if r[1] not in (1, None)} | {(100, 1, "a/b c"), (101, 1, "a/b c")}
    step = versions.Staging(spark, wh)
    new = spark.createDataFrame([(100, 1, "a/b c"), (101, 1, "a/b c")], "id long, y int, s string")
    assert step.write_partitions("silver.t", new, ("y", "s"), [{"y": "1", "s": "a/b c"}, {"y": None, "s": "x"}])
    step.publish()
    entry = versions.current(spark, wh).tables["silver.t"]
    got = versions.read(spark, wh, entry)
    assert len(entry["parts"]) == 2 and {(r["id"], r["y"], r["s"]) for r in got.collect()} == want
    assert {(r["id"], r["y"], r["s"]) for r in spark.sql(versions.select_sql(wh, entry)).collect()} == want
    # replaced folders are pruned, not read and filtered
    assert not any("y=1" in f and entry["parts"][0]["path"] in f for f in got.where("y = 1").inputFiles()) or \
        "PartitionFilters" in got._jdf.queryExecution().executedPlan().toString()
    # a partition that only loses rows leaves no part behind
    gone = versions.Staging(spark, wh)
    assert gone.write_partitions("silver.t", new.where("false"), ("y", "s"), [{"y": "1", "s": "a/b c"}])
    gone.publish()
    entry = versions.current(spark, wh).tables["silver.t"]
    assert len(entry["parts"]) == 2 and versions.read(spark, wh, entry).where("y = 1").isEmpty()
    for k in range(versions.MAX_PARTS):  # beyond some parts a table has to be written whole
        s = versions.Staging(spark, wh)
        if not s.write_partitions("silver.t", new, ("y", "s"), [{"y": "1", "s": "a/b c"}]):
            break
        s.publish()
    assert len(versions.current(spark, wh).tables["silver.t"]["parts"]) == versions.MAX_PARTS


def test_registered_names_never_vanish(spark, tmp_path):
    from wardline.plans.pipeline import register_table
    wh = str(tmp_path / "wh")
    for n in (3, 5):
        s = versions.Staging(spark, wh)
        s.write("silver.swap", spark.range(n).withColumnRenamed("id", f"c{n}"))
        entry = s.publish().tables["silver.swap"]
        if n == 5:
            assert spark.table("silver.swap").count() == 3  # until it is registered
        register_table(spark, "silver.swap", wh, entry, f"swap {n}", {"k": str(n)})
        assert spark.table("silver.swap").columns == [f"c{n}"] and spark.table("silver.swap").count() == n
        assert spark.catalog.getTable("silver.swap").description == f"swap {n}"
    spark.sql("DROP VIEW silver.swap")
