"""Incremental refresh after inserts, updates and deletes equals a full run."""
import datetime as dt
import os

from pyspark.sql import functions as F

from wardline.plans import VIEWS
from wardline.plans.pipeline import BRONZE_TABLES, run_pipeline
from wardline.plans.queries import QUERY_AS_OF
from wardline.plans.refresh import refresh_incremental
from wardline.plans.registry import Catalog
from wardline.sources import synth


def changed_copy(spark, src, dst):
    """The same inputs after a day of changes."""
    os.makedirs(dst, exist_ok=True)
    for name in ("region", "nation", "supplier", "part"):
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{dst}/{name}.parquet")
    cust = spark.read.parquet(f"{src}/customer.parquet")
    cust = cust.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 == 3, F.lit("BUILDING"))
                           .otherwise(F.col("c_mktsegment")))                       # updates
    cust.write.parquet(f"{dst}/customer.parquet")
    orders = spark.read.parquet(f"{src}/orders.parquet")
    new = orders.where("o_orderkey < 40").withColumn("o_orderkey", F.col("o_orderkey") + 100000)
    orders = (orders.where(F.col("o_orderkey") % 17 != 5)                             # deletes
                    .withColumn("o_totalprice", F.when(F.col("o_orderkey") % 13 == 1, F.col("o_totalprice") + 1)
                                .otherwise(F.col("o_totalprice")))                    # updates
                    .unionByName(new))                                                # inserts
    orders.write.parquet(f"{dst}/orders.parquet")
    li = spark.read.parquet(f"{src}/lineitem.parquet")
    li = (li.where(F.col("l_orderkey") % 19 != 2)
            .withColumn("l_returnflag", F.when(F.col("l_orderkey") % 7 == 0, F.lit("A"))
                        .otherwise(F.col("l_returnflag"))))
    li.write.parquet(f"{dst}/lineitem.parquet")


def test_incremental_refresh_equals_full_run(spark, tmp_path):
    a = synth.write_inputs(spark, str(tmp_path / "a"), n_patients=300, n_providers=20, n_departments=15,
                           n_diagnoses=40, n_encounters=1500)
    b = str(tmp_path / "b")
    changed_copy(spark, a, b)
    inc_wh, full_wh = str(tmp_path / "inc"), str(tmp_path / "full")
    cal = (dt.date(1990, 1, 1), dt.date(1993, 12, 31))
    run_pipeline(spark, a, inc_wh, as_of=QUERY_AS_OF, register=False, calendar=cal)
    audit = {r["table"]: r for r in refresh_incremental(spark, b, inc_wh, as_of=QUERY_AS_OF, register=False, calendar=cal)}
    run_pipeline(spark, b, full_wh, as_of=QUERY_AS_OF, register=False, calendar=cal)
    assert Catalog(spark, b, warehouse=inc_wh).table("gold.dim_date").count() == 1461

    assert audit["bronze.raw_departments"]["mode"] == "unchanged"
    assert audit["silver.encounter_silver"]["mode"] == "by_key"
    assert audit["gold.fact_encounter"]["mode"] == "by_key"
    assert 0 < audit["gold.fact_encounter"]["partitions_rewritten"] <= 3  # years of the changed keys
    assert audit["silver.encounter_silver"]["partitions_rewritten"] > 0
    assert audit["gold.dim_provider"]["mode"] == "unchanged"
    assert audit["silver.patient_silver"]["mode"] == "full"  # ages depend on the date
    assert audit["graphql.current_ward_census"]["mode"] == "full"
    inc = Catalog(spark, b, warehouse=inc_wh, as_of=QUERY_AS_OF)
    full = Catalog(spark, b, warehouse=full_wh, as_of=QUERY_AS_OF)
    for name in [f"bronze.{t}" for t in BRONZE_TABLES] + list(VIEWS):
        x, y = inc.table(name), full.table(name)
        cols = sorted(y.columns)
        x, y = x.select(cols), y.select(cols)
        assert x.count() == y.count(), name
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name


def test_refresh_rewrites_only_the_changed_year(spark, tmp_path):
    a = synth.write_inputs(spark, str(tmp_path / "a"), n_patients=200, n_providers=10, n_departments=15,
                           n_diagnoses=20, n_encounters=1200, start="2021-01-01", span_days=3 * 365)
    b = str(tmp_path / "b")
    os.makedirs(b, exist_ok=True)
    for name in ("region", "nation", "customer", "supplier", "part", "lineitem"):
        spark.read.parquet(f"{a}/{name}.parquet").write.parquet(f"{b}/{name}.parquet")
    orders = spark.read.parquet(f"{a}/orders.parquet")
    in_2022 = (F.year("o_orderdate") == 2022) & (F.col("o_orderkey") % 5 == 0)
    orders.withColumn("o_totalprice", F.when(in_2022, F.col("o_totalprice") + 7).otherwise(F.col("o_totalprice"))) \
          .write.parquet(f"{b}/orders.parquet")
    inc_wh, full_wh = str(tmp_path / "inc"), str(tmp_path / "full")
    run_pipeline(spark, a, inc_wh, as_of=QUERY_AS_OF, register=False)
    audit = {r["table"]: r for r in refresh_incremental(spark, b, inc_wh, as_of=QUERY_AS_OF, register=False)}
    run_pipeline(spark, b, full_wh, as_of=QUERY_AS_OF, register=False)
    assert audit["silver.encounter_silver"]["partitions_rewritten"] == 1
    assert audit["gold.fact_encounter"]["partitions_rewritten"] == 1
    for name in ("silver.encounter_silver", "gold.fact_encounter"):
        x = Catalog(spark, b, warehouse=inc_wh).table(name)
        y = Catalog(spark, b, warehouse=full_wh).table(name)
        cols = sorted(y.columns)
        assert x.select(cols).exceptAll(y.select(cols)).count() == 0
        assert y.select(cols).exceptAll(x.select(cols)).count() == 0
