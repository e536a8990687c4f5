"""Run the whole medallion: write bronze, then every view in dependency order.

All tables are staged aside and published together once the last one is written
and no ``fail`` check is violated; until then readers see the version before,
and a run that dies changes nothing (:mod:`wardline.sources.versions`).

Each view reads its inputs from the tables already written (not from the
upstream plans), so every layer is a short plan over stored files: a lost
executor only costs the tasks of the current table, and no plan grows with
the depth of the pipeline. Check violation counts are collected by
``observe`` inside the same write job.
"""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import apply_checks, raise_on_failures
from ..sources import fs, versions
from .registry import VIEWS, Catalog, topo_order

BRONZE_TABLES = ("raw_patients", "raw_departments", "raw_providers", "raw_diagnoses",
                 "raw_encounters", "raw_lab_orders", "raw_bed_assignments", "raw_patient_coverage")


def register_table(spark: SparkSession, name: str, warehouse: str, entry: dict, comment: str = "",
                   properties: dict | None = None) -> None:
    """Expose a published table in the session catalog as ``layer.table``
    (schema per layer, comment, properties). A view over the published files is
    replaced in one step, so ``layer.table`` never is missing; Delta tables
    keep their folder and are created once, then only altered."""
    layer = name.split(".", 1)[0]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
    props = dict(properties or {})
    if entry["fmt"] == "delta":
        props.setdefault("delta.enableChangeDataFeed", "true")
    pairs = ", ".join(f"{versions.quote(k)} = {versions.quote(v)}" for k, v in props.items())
    if entry["fmt"] == "delta":
        path = fs.join(warehouse, entry["parts"][0]["path"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING delta LOCATION {versions.quote(path)}")
        if comment:
            spark.sql(f"COMMENT ON TABLE {name} IS {versions.quote(comment)}")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
        return
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # registered as a table by an earlier release
    spark.sql(f"CREATE OR REPLACE VIEW {name}" + (f" COMMENT {versions.quote(comment)}" if comment else "")
              + (f" TBLPROPERTIES ({pairs})" if pairs else "") + f" AS {versions.select_sql(warehouse, entry)}")


def register_view(spark: SparkSession, name: str, warehouse: str, entry: dict) -> None:
    """:func:`register_table` with the comment and the checks of a registered view."""
    spec = VIEWS.get(name)
    checks = "; ".join(f"{c.name}: {c.predicate}" for c in spec.checks) if spec else ""
    register_table(spark, name, warehouse, entry, spec.comment if spec else "", {"wardline.checks": checks} if checks else None)


def layer_tables(spark: SparkSession, layer: str) -> list[str]:
    """Names of the tables registered in one layer (the load audit's table list)."""
    return sorted(t.name for t in spark.catalog.listTables(layer))


def _levels(names) -> list[list[str]]:
    """Group views by dependency depth; a level only reads lower levels."""
    depth: dict[str, int] = {}
    for n in topo_order(names):
        depth[n] = 1 + max([depth.get(i, 0) for i in VIEWS[n].inputs] or [0])
    out: dict[int, list[str]] = {}
    for n, d in depth.items():
        out.setdefault(d, []).append(n)
    return [out[d] for d in sorted(out)]


def run_pipeline(spark: SparkSession, root: str, warehouse: str, as_of=None, fmt: str = "parquet",
                 views=None, with_bronze: bool = True, register: bool = True,
                 parallel: int = 4, calendar=None) -> list[dict]:
    """Materialize bronze and the selected views and publish them as the next
    version of ``warehouse``.

    Tables of one dependency level are independent, so up to ``parallel``
    of them are written at once (concurrent Spark jobs share the cluster;
    small tables no longer wait for each other). Each level reads the
    levels below from storage. A violated ``fail`` check raises CheckFailed and
    a version published meanwhile PublishConflict; nothing is published then,
    and what was staged is removed.

    Returns one audit record per table: rows written, check violations,
    seconds. The audit is also written as ``<warehouse>/_audit.json``.
    """
    audit: list[dict] = []
    failed: list = []
    staging = versions.Staging(spark, warehouse, fmt)

    def write_bronze(cat: Catalog, t: str) -> dict:
        name = f"bronze.{t}"
        start = time.time()
        o = Observation(name)
        df = cat.table(name)  # derived from the inputs
        staging.write(name, df.observe(o, F.count(F.lit(1)).alias("rows")), change_feed=True)
        return {"table": name, "rows": o.get["rows"], "violations": {},
                "seconds": round(time.time() - start, 3)}

    def write_view(cat: Catalog, name: str) -> dict:
        spec = VIEWS[name]
        start = time.time()
        kept, obs = apply_checks(spec.fn(cat), spec.checks, observe_as=name)
        staging.write(name, kept, partition_by=spec.partition_by)
        vals = obs.get if obs is not None else {}
        if obs is not None:
            failed.append((obs, spec.checks))
        return {"table": name, "comment": spec.comment, "partition_by": list(spec.partition_by),
                "input_rows": vals.get("_input_rows"),
                "violations": {c.name: vals.get(c.name, 0) for c in spec.checks},
                "seconds": round(time.time() - start, 3)}

    def run_level(fn, names, published):
        cat = Catalog(spark, root, warehouse=warehouse, as_of=as_of, fmt=fmt, calendar=calendar, staged=staging,
                      published=published)
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            audit.extend(pool.map(lambda n: fn(cat, n), names))

    try:
        if with_bronze:
            run_level(write_bronze, [t for t in BRONZE_TABLES if t != "raw_patient_coverage"], False)
            run_level(write_bronze, ["raw_patient_coverage"], False)  # derived from raw_patients
        for level in _levels(views):
            run_level(write_view, level, not with_bronze)
        for obs, checks in failed:
            raise_on_failures(obs, checks)
        staging.publish()
    except Exception:
        staging.abandon()
        raise
    if register:
        for rec in audit:
            register_view(spark, rec["table"], warehouse, staging.entries[rec["table"]])
    fs.write_text(spark, fs.join(warehouse, "_audit.json"), json.dumps(audit, indent=1, default=str))
    return audit
