"""End-to-end walk through the library.

    python examples/demo.py [workdir]

1. generate input tables at the original demo sizes (3,000 patients,
   25,000 encounters, ...),
2. build bronze, silver, gold and serving tables and register them,
3. read the serving tables the way their consumers do: the ward board,
   one insurer's feed (a partition prune), abnormal alerts page by page,
4. change some inputs and refresh incrementally.

The work folder defaults to a fresh folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from wardline import build_session, refresh_incremental, run_pipeline  # noqa: E402
from wardline.operators import feeds  # noqa: E402
from wardline.plans.pipeline import layer_tables  # noqa: E402
from wardline.sources import synth  # noqa: E402
from wardline.sources.sinks import scratch_path  # noqa: E402

AS_OF = dt.date(2025, 1, 1)


def main() -> None:
    spark = build_session("local[*]", 8, app_name="wardline-demo")
    work = sys.argv[1] if len(sys.argv) > 1 else scratch_path(spark, "demo")
    inputs, warehouse = os.path.join(work, "inputs"), os.path.join(work, "warehouse")

    synth.write_inputs(spark, inputs)  # original sizes by default
    audit = run_pipeline(spark, inputs, warehouse, as_of=AS_OF)
    for rec in audit:
        if rec.get("violations"):
            print(f"{rec['table']:<36} dropped by checks: {rec['violations']}")
    print("serving tables:", layer_tables(spark, "graphql"))

    spark.sql("SELECT hmo_code, count(*) AS patients FROM bronze.raw_patient_coverage "
              "GROUP BY hmo_code ORDER BY hmo_code").show()

    board = spark.table("graphql.current_ward_census")
    board.where("NEEDS_ATTENTION").orderBy(F.desc("CURRENT_LOS_DAYS")).select(
        "WARD_NO", "BED_NO", "FULL_NAME", "CURRENT_LOS_DAYS", "NUM_ABNORMAL_LABS").show(5)

    south = feeds.scope_to_tenant_sql(spark.table("graphql.hmo_encounter_summary"), "HMO_CODE", "HMO-SOUTH")
    print("HMO-SOUTH rows:", south.count())

    alerts = spark.table("graphql.abnormal_lab_alerts")
    cursor, pages = None, 0
    while pages < 3:
        page = feeds.read_since(alerts, "RESULTED_TS", "ALERT_BK", cursor=cursor, limit=1000)
        cursor = feeds.next_cursor(page, "RESULTED_TS", "ALERT_BK", previous=cursor)
        pages += 1
        print("alert page", pages, "ends at", cursor)

    # A day later: some bills corrected, a few new encounters.
    changed = os.path.join(work, "inputs_next")
    for name in ("region", "nation", "customer", "supplier", "part", "lineitem"):
        spark.read.parquet(os.path.join(inputs, f"{name}.parquet")).write.parquet(
            os.path.join(changed, f"{name}.parquet"))
    orders = spark.read.parquet(os.path.join(inputs, "orders.parquet"))
    fresh = orders.where("o_orderkey < 50").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000)
    (orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 100 == 0, F.col("o_totalprice") * 2)
                       .otherwise(F.col("o_totalprice")))
           .unionByName(fresh).write.parquet(os.path.join(changed, "orders.parquet")))
    for rec in refresh_incremental(spark, changed, warehouse, as_of=AS_OF):
        parts = f" partitions rewritten: {rec['partitions_rewritten']}" if "partitions_rewritten" in rec else ""
        print(f"{rec['table']:<36} {rec['mode']:<9} {rec.get('changed_keys', '')}{parts}")


if __name__ == "__main__":
    main()
