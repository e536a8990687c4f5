"""Incremental refresh of a written warehouse after the inputs changed.

Chooses a refresh mode per table, the way a view host would:

* ``unchanged``: no input row of the table changed; the table is kept.
* ``by_key``: the table's rows for a key depend only on input rows with the
  same key (every silver view; the encounter fact, keyed by encounter). The
  changed keys are those whose per-key signature (row count and two hash
  sums, so duplicate rows are handled) differs between old and new bronze,
  and
  :func:`wardline.operators.incremental.refresh_by_key` recomputes only those
  keys and keeps every other row.
* ``full``: everything else whose inputs changed (dimensions joined to other
  dimensions, the calendar, the serving tables), and every view that
  depends on the current date (patient ages, the ward board), which is
  rebuilt on every refresh.

Everything is staged beside the published tables and published in one step at
the end, so a refresh that fails or dies changes nothing for readers, who see
all tables of one version (:mod:`wardline.sources.versions`). For a
partitioned table refreshed by key, only the partitions holding a changed key
are written; the next version takes the others from the folders that already
hold them, so I/O follows the change, not the table. Unpartitioned tables with
a change are rewritten whole (parquet has no in-place update), unchanged ones
keep their folder.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import join_null_safe, key_signatures, refresh_by_key
from ..operators.quality import CheckFailed, apply_checks, raise_on_failures
from ..sources import versions
from ..sources.sinks import materialize
from .pipeline import BRONZE_TABLES, _levels, register_view
from .registry import VIEWS, Catalog, Given, enforce

BRONZE_KEYS = {
    "raw_patients": "patient_bk",
    "raw_departments": "department_bk",
    "raw_providers": "provider_bk",
    "raw_diagnoses": "diagnosis_bk",
    "raw_encounters": "encounter_bk",
    "raw_lab_orders": "lab_order_bk",
    "raw_bed_assignments": "bed_assignment_bk",
    "raw_patient_coverage": "coverage_bk",
}
# silver view -> (its bronze input, output key)
SILVER_BY_KEY = {
    "silver.patient_silver": ("raw_patients", "PATIENT_BK"),
    "silver.department_silver": ("raw_departments", "DEPARTMENT_BK"),
    "silver.provider_silver": ("raw_providers", "PROVIDER_BK"),
    "silver.diagnosis_silver": ("raw_diagnoses", "DIAGNOSIS_BK"),
    "silver.lab_order_silver": ("raw_lab_orders", "LAB_ORDER_BK"),
    "silver.encounter_silver": ("raw_encounters", "ENCOUNTER_BK"),
    "silver.bed_assignment_silver": ("raw_bed_assignments", "BED_ASSIGNMENT_BK"),
    "silver.patient_coverage_silver": ("raw_patient_coverage", "COVERAGE_BK"),
}


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two snapshots (inserted, deleted or
    updated; duplicate rows counted), one row per key. Only per-key
    signatures (count and two hash sums, partially aggregated) are shuffled
    and joined, never whole rows."""
    cols = new.columns
    so = key_signatures(old.select(cols), key).select(key, F.struct("_n", "_h1", "_h2").alias("_so"))
    sn = key_signatures(new.select(cols), key).select(key, F.struct("_n", "_h1", "_h2").alias("_sn"))
    return join_null_safe(so, sn, [key], "full_outer").where(~F.col("_so").eqNullSafe(F.col("_sn"))).select(key)


def _semi_null_safe(df: DataFrame, keys: DataFrame, cols) -> DataFrame:
    """Rows of ``df`` whose ``cols`` values occur in ``keys`` (NULL matches NULL)."""
    k = keys.select(*[F.col(c).alias(f"__p_{i}") for i, c in enumerate(cols)])
    cond = None
    for i, c in enumerate(cols):
        e = df[c].eqNullSafe(k[f"__p_{i}"])
        cond = e if cond is None else cond & e
    return df.join(k, cond, "left_semi")


def _stage_partitions(staging: versions.Staging, name: str, new: DataFrame, old: DataFrame, touched: DataFrame,
                      key: str) -> int | None:
    """Stage only the partitions of ``new`` that hold a changed key (in the old
    or the new rows). Returns their number, or None when the table has to be
    written whole. The driver learns which partitions these are, as it does of
    any partitioned write."""
    pcols = list(VIEWS[name].partition_by)
    affected = materialize(join_null_safe(old, touched, [key], "left_semi").select(*pcols)
                           .unionByName(join_null_safe(new, touched, [key], "left_semi").select(*pcols)).distinct(),
                           name.replace(".", "-") + "-parts")
    replaced = [r.asDict() for r in affected.select(*[F.col(c).cast("string").alias(c) for c in pcols]).collect()]
    if not staging.write_partitions(name, _semi_null_safe(new, affected, pcols), pcols, replaced):
        return None
    for c in VIEWS[name].checks:
        if c.action == "fail" and not staging.read(name).where(c.violates).isEmpty():
            raise CheckFailed(f"checks failed: {c.name} of {name}")
    return len(replaced)


def _checked(df: DataFrame, checks, failed: list, name: str) -> DataFrame:
    """``df`` with its checks applied; their counts are there once it is written."""
    kept, obs = apply_checks(df, checks, observe_as=f"refresh {name}")
    if obs is not None:
        failed.append((obs, checks))
    return kept


def refresh_incremental(spark: SparkSession, root: str, warehouse: str, as_of=None,
                        fmt: str = "parquet", register: bool = True, calendar=None) -> list[dict]:
    """Bring ``warehouse`` (written by ``run_pipeline``) up to date with the
    inputs under ``root``; returns one audit record per table. ``calendar``
    must be the range that the warehouse was built with."""
    staging = versions.Staging(spark, warehouse, fmt)
    try:
        audit = _refresh(spark, root, warehouse, as_of, fmt, calendar, staging)
        if staging.entries:
            staging.publish()
    except Exception:
        staging.abandon()
        raise
    if register:
        for rec in audit:
            if rec["table"] in staging.entries:
                register_view(spark, rec["table"], warehouse, staging.entries[rec["table"]])
    return audit


def _refresh(spark, root, warehouse, as_of, fmt, calendar, staging) -> list[dict]:
    old = Catalog(spark, root, warehouse=warehouse, as_of=as_of, fmt=fmt, calendar=calendar)
    fresh = Catalog(spark, root, as_of=as_of, fmt=fmt, calendar=calendar)
    audit: list[dict] = []
    failed: list = []
    changed: dict[str, DataFrame] = {}
    counts: dict[str, int] = {}

    # 1. Which business keys changed in each bronze table (kept in scratch
    #    storage: read several times below); the new bronze of those that did.
    for t in BRONZE_TABLES:
        start = time.time()
        keys = materialize(changed_keys(old.table(f"bronze.{t}"), fresh.table(f"bronze.{t}"),
                                        BRONZE_KEYS[t]), f"changed-{t}")
        changed[t], counts[t] = keys, keys.count()
        if counts[t]:
            staging.write(f"bronze.{t}", fresh.table(f"bronze.{t}"))
        audit.append({"table": f"bronze.{t}", "mode": "by_key" if counts[t] else "unchanged",
                      "changed_keys": counts[t], "seconds": round(time.time() - start, 3)})

    def now() -> Catalog:
        """Staged tables, else published ones."""
        return Catalog(spark, root, warehouse=warehouse, as_of=as_of, fmt=fmt, calendar=calendar, staged=staging)

    # Encounters touched through their lab lines (old or new line of a changed lab key).
    cur = now()
    lab_enc = (old.table("bronze.raw_lab_orders").select("lab_order_bk", "encounter_bk")
               .unionByName(cur.table("bronze.raw_lab_orders").select("lab_order_bk", "encounter_bk")))
    lab_enc = join_null_safe(lab_enc, changed["raw_lab_orders"], ["lab_order_bk"], "left_semi").select("encounter_bk")
    fact_keys = materialize(changed["raw_encounters"].unionByName(lab_enc).distinct()
                            .withColumnRenamed("encounter_bk", "ENCOUNTER_BK"), "changed-fact")
    n_fact = fact_keys.count()

    # 2. Silver, key by key, from the new bronze rows of the changed keys.
    dirty: set[str] = set()
    for name, (t, key) in SILVER_BY_KEY.items():
        spec = VIEWS[name]
        if not counts[t] and not spec.uses_as_of:
            continue
        start = time.time()

        def view_fn(raw, spec=spec, t=t, name=name):
            return _checked(spec.fn(Given({f"bronze.{t}": raw}, fresh.as_of_col())), spec.checks, failed, name)

        raw = cur.table(f"bronze.{t}")
        if spec.uses_as_of:
            # Depends on the current date (ages): every row may change, so
            # the view is rebuilt in full from the new bronze.
            staging.write(name, view_fn(raw), partition_by=spec.partition_by)
            rec = {"mode": "full"}
        else:
            touched = changed[t].withColumnRenamed(BRONZE_KEYS[t], key)

            def enforced(raw, spec=spec, t=t):
                return enforce(spec.fn(Given({f"bronze.{t}": raw}, fresh.as_of_col())), spec.checks)

            rec = {"mode": "by_key", "changed_keys": counts[t]}
            n_parts = None
            if spec.partition_by:
                df = refresh_by_key(enforced, old.table(name), {"raw": raw}, touched, key, input_keys={"raw": BRONZE_KEYS[t]})
                n_parts = _stage_partitions(staging, name, df, old.table(name), touched, key)
            if n_parts is None:
                df = refresh_by_key(view_fn, old.table(name), {"raw": raw}, touched, key, input_keys={"raw": BRONZE_KEYS[t]})
                staging.write(name, df, partition_by=spec.partition_by)
            else:
                rec["partitions_rewritten"] = n_parts
        dirty.add(name)
        audit.append({"table": name, **rec, "seconds": round(time.time() - start, 3)})

    # 3. Gold and serving over the refreshed silver.
    for level in _levels([n for n in VIEWS if not n.startswith("silver.")]):
        cur = now()
        for name in level:
            if name in SILVER_BY_KEY:
                continue  # done above
            spec = VIEWS[name]
            if not (set(spec.inputs) & dirty) and not spec.uses_as_of:
                audit.append({"table": name, "mode": "unchanged", "seconds": 0.0})
                continue
            start = time.time()
            rec, n_parts = {"mode": "full"}, None
            if name == "gold.fact_encounter":
                def fact_fn(enc, labs, spec=spec):
                    g = Given({"silver.encounter_silver": enc, "silver.lab_order_silver": labs},
                               cur.as_of_col())
                    return enforce(spec.fn(g), spec.checks)
                df = refresh_by_key(fact_fn, old.table(name),
                                    {"enc": cur.table("silver.encounter_silver"),
                                     "labs": cur.table("silver.lab_order_silver")},
                                    fact_keys, "ENCOUNTER_BK")
                rec = {"mode": "by_key", "changed_keys": n_fact}
                n_parts = _stage_partitions(staging, name, df, old.table(name), fact_keys, "ENCOUNTER_BK")
                if n_parts is None:
                    staging.write(name, df, partition_by=spec.partition_by)
                else:
                    rec["partitions_rewritten"] = n_parts
            else:
                staging.write(name, _checked(spec.fn(cur), spec.checks, failed, name), partition_by=spec.partition_by)
            dirty.add(name)
            audit.append({"table": name, **rec, "seconds": round(time.time() - start, 3)})
    for obs, checks in failed:
        raise_on_failures(obs, checks)
    return audit
