"""Physical-plan properties the design relies on."""
from wardline.plans.queries import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    """``explain("formatted")`` as a string (one line per scan property)."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_dedup_is_a_group_limit_before_the_shuffle(spark, small_root):
    p = plan(catalog(spark, small_root).table("silver.patient_silver"))
    assert "WindowGroupLimit" in p


def test_lab_rollup_aggregates_partially_before_the_shuffle(spark, small_root):
    from wardline.plans import gold
    p = plan(gold.labs_per_encounter(catalog(spark, small_root).table("silver.lab_order_silver")))
    assert "partial_count" in p and "partial_sum" in p


def test_fact_checks_run_below_the_join(spark, small_root):
    p = plan(catalog(spark, small_root).table("gold.fact_encounter"))
    join_at = p.find("Join")
    filt_at = p.find("Cancelled", join_at)
    assert join_at >= 0 and filt_at > join_at  # the filter sits under the join


def test_scans_read_only_needed_columns(spark, small_root):
    p = plan(catalog(spark, small_root).table("graphql.hmo_encounter_summary"))
    assert "o_orderpriority" not in p and "c_acctbal" not in p


def test_over_written_silver_checks_and_scoping_reach_the_scan(spark, small_root, tmp_path):
    from wardline.operators.feeds import scope_to_tenant
    from wardline.plans.pipeline import run_pipeline
    from wardline.plans.queries import QUERY_AS_OF
    from wardline.plans.registry import Catalog

    wh = str(tmp_path / "wh")
    run_pipeline(spark, small_root, wh, as_of=QUERY_AS_OF, register=False,
                 views=["gold.fact_encounter", "graphql.hmo_encounter_summary"])
    cat = Catalog(spark, small_root, warehouse=wh, as_of=QUERY_AS_OF)
    fact = cat.build("gold.fact_encounter")  # rebuilt over the written silver tables
    pushed = [ln for ln in formatted(fact).splitlines() if ln.startswith("PushedFilters")]
    # all three checks, NULL-passing, become parquet filters
    assert any("BILLED_AMOUNT" in ln and "LENGTH_OF_STAY_DAYS" in ln and "STATUS" in ln for ln in pushed), pushed
    # a year filter on the stored fact is a partition prune
    p = plan(cat.table("gold.fact_encounter").where("ADMIT_YEAR = 1998"))
    assert "PartitionFilters: [isnotnull(ADMIT_YEAR" in p
    p = plan(scope_to_tenant(cat.table("graphql.hmo_encounter_summary"), "HMO_CODE", "HMO-SOUTH"))
    assert "PartitionFilters: [isnotnull(HMO_CODE" in p
