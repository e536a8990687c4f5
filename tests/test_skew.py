"""A key holding a third of all rows: joins split it, aggregates and the
dedup shrink it before the shuffle."""
from pyspark.sql import functions as F

from wardline.operators.dedup import keep_first
from wardline.plans import serving


def skewed(spark, n=60_000):
    # one third of the encounters belong to patient PAT000000
    return spark.range(n).select(
        F.format_string("ENC%08d", "id").alias("ENCOUNTER_BK"),
        F.when(F.col("id") % 3 == 0, F.lit("PAT000000"))
         .otherwise(F.format_string("PAT%06d", F.col("id") % 5000)).alias("PATIENT_BK"),
        (F.col("id") % 97).alias("v"))


def test_hot_key_join_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        enc = skewed(spark)
        pat = spark.range(5000).select(F.format_string("PAT%06d", "id").alias("PATIENT_BK"),
                                       (F.col("id") * 2).alias("w"))
        j = enc.join(pat, "PATIENT_BK", "left")
        assert len(j.collect()) == 60_000  # runs this plan, so AQE finalizes it
        final = j._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final, final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_aggregate_combines_map_side(spark):
    agg = serving.admission_counts(skewed(spark))
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    want = sum(1 for i in range(60_000) if i % 3 == 0 or i % 5000 == 0)
    assert agg.where("PATIENT_BK = 'PAT000000'").first()["ADMISSION_COUNT"] == want


def test_hot_key_dedup_limits_before_shuffle(spark):
    one = keep_first(skewed(spark), "PATIENT_BK", [F.col("v").asc_nulls_last()], tie_break=["ENCOUNTER_BK"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final
    assert one.count() == 5000


def test_hot_group_of_identical_copies(spark):
    from wardline.operators.dedup import dropped_duplicates
    # a third of the rows are identical copies of one row
    hot = spark.range(30_000).select(F.lit("K0").alias("k"), F.lit("x").alias("v"), F.lit(None).cast("string").alias("n"))
    rest = spark.range(60_000).select(F.format_string("K%d", F.col("id") % 7000 + 1).alias("k"),
                                      (F.col("id") % 3).cast("string").alias("v"),
                                      F.when(F.col("id") % 5 == 0, F.lit("a")).alias("n"))
    nulls = spark.range(50).select(F.lit(None).cast("string").alias("k"), (F.col("id") % 2).cast("string").alias("v"),
                                   F.lit(None).cast("string").alias("n"))
    df = hot.unionByName(rest).unionByName(nulls)
    got = dropped_duplicates(df, "k", [F.col("v").asc_nulls_last()], tie_break=["n"], chunk=1000)
    want = df.exceptAll(keep_first(df, "k", [F.col("v").asc_nulls_last()], tie_break=["n"]))
    assert got.count() == want.count() == 90_050 - 7002
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_multiset_minus_matches_except_all_with_hot_copies(spark):
    from wardline.operators.incremental import multiset_minus
    a = (spark.range(40_000).select(F.lit("hot").alias("k"), F.lit(None).cast("int").alias("v"))
         .unionByName(spark.range(5000).select(F.format_string("k%d", F.col("id") % 900).alias("k"),
                                               (F.col("id") % 4).cast("int").alias("v"))))
    b = (spark.range(15_000).select(F.lit("hot").alias("k"), F.lit(None).cast("int").alias("v"))
         .unionByName(spark.range(3000).select(F.format_string("k%d", F.col("id") % 700).alias("k"),
                                               (F.col("id") % 4).cast("int").alias("v"))))
    got, want = multiset_minus(a, b, chunk=1000), a.exceptAll(b)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_ward_board_splits_a_hot_patient(spark, tmp_path):
    """The real view over stored silver in which one patient has a third of the encounters."""
    from wardline.plans.pipeline import run_pipeline
    from wardline.plans.queries import QUERY_AS_OF
    from wardline.plans.registry import Catalog
    from wardline.sources import synth
    root = synth.write_inputs(spark, str(tmp_path / "in"), n_patients=400, n_providers=30, n_departments=9, n_diagnoses=20,
                              n_encounters=30_000)
    orders = spark.read.parquet(f"{root}/orders.parquet")
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast(orders.schema["o_custkey"].dataType))
                      .otherwise(F.col("o_custkey"))).write.parquet(f"{root}/hot.parquet")
    spark.read.parquet(f"{root}/hot.parquet").write.mode("overwrite").parquet(f"{root}/orders.parquet")
    wh = str(tmp_path / "wh")
    run_pipeline(spark, root, wh, as_of=QUERY_AS_OF, register=False, views=[v for v in _silver_views()])
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        board = Catalog(spark, root, warehouse=wh, as_of=QUERY_AS_OF).build("graphql.current_ward_census")
        assert board.collect()
        assert "isSkewJoin=true" in (p := board._jdf.queryExecution().executedPlan().toString()) or "skew=true" in p
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _silver_views():
    from wardline.plans.registry import VIEWS
    return [v for v in VIEWS if v.startswith("silver.")]
