"""The query catalog: one callable ``(spark, root) -> DataFrame`` per operator.

Every query reads the input tables under ``root`` (through the bronze
derivation) and runs over all of their rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import Catalog
from .oracle import AS_OF

QUERY_AS_OF = _dt.date.fromisoformat(AS_OF)

SK_COLUMNS = ("PATIENT_SK", "PROVIDER_SK", "DEPARTMENT_SK", "DIAGNOSIS_SK", "ENCOUNTER_SK")


def catalog(spark: SparkSession, root: str) -> Catalog:
    return Catalog(spark, root, as_of=QUERY_AS_OF)


def _view(name: str, drop=()):
    def q(spark: SparkSession, root: str) -> DataFrame:
        df = catalog(spark, root).table(name)
        return df.drop(*[c for c in drop if c in df.columns])
    q.__name__ = name.split(".", 1)[1]
    return q


def sk_referential(spark: SparkSession, root: str) -> DataFrame:
    """Resolve each fact row's dimension members through the surrogate keys."""
    cat = catalog(spark, root)
    f = cat.table("gold.fact_encounter")
    pat = cat.table("gold.dim_patient").select("PATIENT_SK", "PATIENT_BK")
    prov = cat.table("gold.dim_provider").select("PROVIDER_SK", "PROVIDER_BK")
    dept = cat.table("gold.dim_department").select("DEPARTMENT_SK", "DEPARTMENT_BK")
    dx = cat.table("gold.dim_diagnosis").select("DIAGNOSIS_SK", "DIAGNOSIS_BK")
    cal = cat.table("gold.dim_date").select(F.col("DATE_SK").alias("ADMIT_DATE_SK"), "DATE_VALUE")
    j = (f.join(pat, "PATIENT_SK", "left").join(prov, "PROVIDER_SK", "left")
          .join(dept, "DEPARTMENT_SK", "left").join(dx, "DIAGNOSIS_SK", "left")
          .join(cal, "ADMIT_DATE_SK", "left"))
    return j.select("ENCOUNTER_BK", "PATIENT_BK", "PROVIDER_BK", "DEPARTMENT_BK", "DIAGNOSIS_BK", "DATE_VALUE")


VIEW_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_patient": _view("silver.patient_silver"),
    "silver_department": _view("silver.department_silver"),
    "silver_provider": _view("silver.provider_silver"),
    "silver_diagnosis": _view("silver.diagnosis_silver"),
    "silver_lab_order": _view("silver.lab_order_silver"),
    "silver_encounter": _view("silver.encounter_silver"),
    "silver_bed_assignment": _view("silver.bed_assignment_silver"),
    "silver_patient_coverage": _view("silver.patient_coverage_silver"),
    "dim_patient": _view("gold.dim_patient", drop=SK_COLUMNS),
    "dim_provider": _view("gold.dim_provider", drop=SK_COLUMNS),
    "dim_department": _view("gold.dim_department", drop=SK_COLUMNS),
    "dim_diagnosis": _view("gold.dim_diagnosis", drop=SK_COLUMNS),
    "dim_date": _view("gold.dim_date"),
    "fact_encounter": _view("gold.fact_encounter", drop=SK_COLUMNS),
    "ward_census": _view("graphql.current_ward_census", drop=SK_COLUMNS),
    "hmo_summary": _view("graphql.hmo_encounter_summary"),
    "lab_alerts": _view("graphql.abnormal_lab_alerts"),
    "sk_referential": sk_referential,
}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .operator_queries import OPERATOR_QUERIES  # noqa: PLC0415
    out = dict(VIEW_QUERIES)
    out.update(OPERATOR_QUERIES)
    return out
