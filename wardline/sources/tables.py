"""Readers for the input tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


class Tables:
    """Lazy access to ``<root>/<name>.parquet`` (or ``<root>/<name>``).

    ``root`` may be any path Spark can read. A table is resolved once per
    instance, so a plan that uses it several times sees one relation and can
    reuse its exchanges; nothing is kept beyond the instance.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._dfs: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        p = fs.join(self.root, f"{name}.parquet")
        return p if fs.exists(self.spark, p) else fs.join(self.root, name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = self.spark.read.parquet(self.path(name))
        return self._dfs[name]

    def count(self, name: str) -> Column:
        """Row count of an input table as a scalar subquery: taken when the
        query runs, from the files it reads then."""
        return self[name].agg(F.count(F.lit(1))).scalar()

    def register(self, *names: str) -> None:
        """Expose tables as temp views for ``spark.sql``."""
        for n in names or DRIVER_TABLES:
            self[n].createOrReplaceTempView(n)
