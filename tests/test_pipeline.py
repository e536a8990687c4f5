import datetime as dt
import json
import os

from wardline.plans import VIEWS
from wardline.plans.pipeline import run_pipeline
from wardline.plans.queries import QUERY_AS_OF, catalog
from wardline.plans.registry import Catalog


def test_pipeline_writes_every_layer_and_matches_query_mode(spark, small_root, tmp_path):
    wh = str(tmp_path / "wh")
    audit = run_pipeline(spark, small_root, wh, as_of=QUERY_AS_OF)
    names = {a["table"] for a in audit}
    assert set(VIEWS) <= names and "bronze.raw_patients" in names
    assert json.load(open(os.path.join(wh, "_audit.json")))
    fact = [a for a in audit if a["table"] == "gold.fact_encounter"][0]
    assert fact["violations"]["not_cancelled"] > 0
    # partitioned by ADMIT_YEAR on disk
    [run] = os.listdir(os.path.join(wh, "gold", "fact_encounter"))
    assert any(d.startswith("ADMIT_YEAR=") for d in os.listdir(os.path.join(wh, "gold", "fact_encounter", run)))
    stored = Catalog(spark, small_root, warehouse=wh, as_of=QUERY_AS_OF).table("gold.fact_encounter")
    # registered in the session catalog with its comment and check list
    assert spark.table("gold.fact_encounter").count() == stored.count()
    assert "hashed dimension keys" in spark.catalog.getTable("gold.fact_encounter").description
    props = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES gold.fact_encounter").collect()}
    assert "not_cancelled" in props["wardline.checks"]
    live = catalog(spark, small_root).table("gold.fact_encounter")
    cols = sorted(live.columns)
    assert stored.select(cols).exceptAll(live.select(cols)).count() == 0
    assert live.select(cols).exceptAll(stored.select(cols)).count() == 0


def test_fact_keeps_open_stays_by_default(spark, small_root):
    fact = catalog(spark, small_root).table("gold.fact_encounter")
    assert fact.where("LENGTH_OF_STAY_DAYS IS NULL").count() > 0
    assert fact.where("STATUS = 'Cancelled' OR BILLED_AMOUNT < 0").count() == 0


def test_dimension_keys_unique(spark, small_root):
    cat = catalog(spark, small_root)
    for name, key in [("gold.dim_patient", "PATIENT_BK"), ("gold.dim_provider", "PROVIDER_BK"),
                      ("gold.dim_department", "DEPARTMENT_BK"), ("gold.dim_diagnosis", "DIAGNOSIS_BK"),
                      ("gold.dim_date", "DATE_SK"), ("silver.lab_order_silver", "LAB_ORDER_BK")]:
        df = cat.table(name)
        assert df.count() == df.select(key).distinct().count(), name


def test_calendar_fixed_range(spark):
    from wardline.sources.calendar import dim_date
    cal = dim_date(spark, dt.date(2023, 1, 1), dt.date(2026, 12, 31))
    assert cal.count() == 1461
    first = cal.orderBy("DATE_VALUE").first()
    assert first.WEEK_OF_YEAR == 52 and first.IS_WEEKEND and first.DAY_NAME == "Sunday"


def test_pipeline_fixed_calendar(spark, small_root, tmp_path):
    audit = run_pipeline(spark, small_root, str(tmp_path / "wh"), as_of=QUERY_AS_OF, register=False,
                         views=["gold.dim_date"], with_bronze=False,
                         calendar=(dt.date(2023, 1, 1), dt.date(2026, 12, 31)))
    assert [a["table"] for a in audit][-1] == "gold.dim_date"
    cal = Catalog(spark, small_root, warehouse=str(tmp_path / "wh")).table("gold.dim_date")
    assert cal.count() == 1461
