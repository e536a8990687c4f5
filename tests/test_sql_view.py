"""A view written as SQL text equals the DataFrame-built view."""
from pyspark.sql import functions as F

from wardline.operators.quality import Check
from wardline.plans.queries import catalog
from wardline.plans.registry import VIEWS, sql_view

SPEND_SQL = """
SELECT d.BUILDING, l.TEST_NAME, datediff(:as_of, max(e.ADMIT_DATE)) AS DAYS_QUIET,
       count(DISTINCT e.PROVIDER_BK) AS PROVIDERS, sum(l.TEST_COST) AS SPENT
FROM silver.lab_order_silver l, silver.encounter_silver e, silver.department_silver d
WHERE l.ENCOUNTER_BK = e.ENCOUNTER_BK AND e.DEPARTMENT_BK = d.DEPARTMENT_BK AND e.LENGTH_OF_STAY_DAYS > 2
GROUP BY ALL
"""


def test_sql_view_equals_dataframe_view(spark, small_root):
    name = "graphql.lab_spend_test"
    try:
        sql_view(name, SPEND_SQL,
                 inputs=["silver.encounter_silver", "silver.lab_order_silver", "silver.department_silver"],
                 checks=[Check("spent_something", "SPENT > 1000")], uses_as_of=True)
        cat = catalog(spark, small_root)
        a = cat.table(name)
        long = cat.table("silver.encounter_silver").where("LENGTH_OF_STAY_DAYS > 2")
        b = (cat.table("silver.lab_order_silver").join(long, "ENCOUNTER_BK")
                .join(cat.table("silver.department_silver"), "DEPARTMENT_BK").groupBy("BUILDING", "TEST_NAME")
                .agg(F.datediff(cat.as_of_col(), F.max("ADMIT_DATE")).alias("DAYS_QUIET"),
                     F.count_distinct("PROVIDER_BK").alias("PROVIDERS"), F.sum("TEST_COST").alias("SPENT"))
                .where("SPENT > 1000"))
        assert a.columns == b.columns
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        VIEWS.pop(name, None)
