"""A filtered side too large to broadcast cuts the other one down before its shuffle."""
from pyspark.sql import functions as F

from wardline.plans.pipeline import run_pipeline
from wardline.plans.queries import QUERY_AS_OF
from wardline.plans.registry import Catalog
from wardline.session import DEFAULT_CONF

BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        f"{BLOOM}.applicationSideScanSizeThreshold": "1KB"}


def shuffled(plan) -> int:
    """Rows written by the exchanges of an executed plan."""
    name = plan.getClass().getSimpleName()
    if "AdaptiveSparkPlan" in name:
        return shuffled(plan.executedPlan())
    if "QueryStage" in name:
        return shuffled(plan.plan())
    own = plan.metrics().get("shuffleRecordsWritten").get().value() if plan.metrics().contains("shuffleRecordsWritten") else 0
    kids = plan.children()
    return own + sum(shuffled(kids.apply(i)) for i in range(kids.size()))


def test_alerts_of_a_few_encounters(spark, small_root, tmp_path):
    wh = str(tmp_path / "wh")
    run_pipeline(spark, small_root, wh, as_of=QUERY_AS_OF, register=False, views=["silver.lab_order_silver", "silver.encounter_silver"])
    cat = Catalog(spark, small_root, warehouse=wh, as_of=QUERY_AS_OF)

    def joined():
        few = cat.table("silver.encounter_silver").where("BILLED_AMOUNT > 400000 and STATUS <> 'Cancelled'").select("ENCOUNTER_BK", "PATIENT_BK")
        return cat.table("silver.lab_order_silver").select("ENCOUNTER_BK", "LAB_ORDER_BK", "TEST_NAME").join(few, "ENCOUNTER_BK")

    old = {k: spark.conf.get(k, None) for k in [*CONF, f"{BLOOM}.enabled"]}
    found, rows = {}, {}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        for on in ("false", "true"):
            spark.conf.set(f"{BLOOM}.enabled", on)
            df = joined()
            rows[on] = sorted(map(tuple, df.collect()))
            plan = df._jdf.queryExecution().executedPlan()
            found[on] = shuffled(plan)
            text = plan.toString()
            assert ("might_contain" in text) == (on == "true")
            if on == "true":  # below the exchange, at the scan of the large side
                assert text.index("Exchange hashpartitioning") < text.index("might_contain")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows["true"] == rows["false"] and rows["true"]
    assert found["true"] < found["false"] / 2
    assert f"{BLOOM}.creationSideThreshold" in DEFAULT_CONF
    assert joined().agg(F.count("*")).first()[0] == len(rows["true"])
