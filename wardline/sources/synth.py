"""Deterministic generator of input tables at any size (no input data needed).

Produces the seven input tables the bronze layer reads (customer, nation,
supplier, part, orders, lineitem, region) from ``spark.range`` spines. Every
value is a hash of the row id and a per-column salt, so the output is the
same for any partitioning and any cluster, and columns are independent.
Line items are 1..4 per order (``explode(sequence)``). Defaults follow the
workload sizes of the original demo: 3,000 patients, 150 providers,
15 departments, 120 diagnoses, 25,000 encounters.

Use :func:`write_inputs` to lay the tables out as ``<folder>/<name>.parquet``
and point :class:`wardline.plans.Catalog` (or any query) at that folder.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: small vocabularies for readable generated names.
GIVEN_NAMES = ["amara", "bola", "chidi", "dayo", "efe", "femi", "gbenga", "halima", "ife", "jide",
               "kemi", "lola", "musa", "nneka", "ola", "peju", "sade", "tayo", "uche", "zainab"]
FAMILY_NAMES = ["adeleke", "balogun", "chukwu", "danjuma", "ekwueme", "fashola", "garba", "ibe",
                "jaja", "kalu", "lawson", "mohammed", "nwachukwu", "ojo", "uba"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PART_TYPES = ["ECONOMY", "STANDARD", "SMALL", "MEDIUM", "LARGE", "PROMO"]
PART_WORDS = ["red", "blue", "small", "large", "old", "new", "hot", "cold"]
PART_NOUNS = ["anvil", "widget", "gizmo", "ring", "rod", "valve"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
RETURN_FLAGS = ["A", "N", "R"]


class _Hasher:
    """Column helpers bound to one seed."""

    def __init__(self, seed: int):
        self.seed = seed

    def h(self, id_col: Column, salt: int) -> Column:
        """Non-negative 62-bit hash of (id, salt, seed)."""
        return F.abs(F.xxhash64(id_col, F.lit(salt), F.lit(self.seed)) % F.lit(1 << 62))

    def pick(self, values, id_col: Column, salt: int) -> Column:
        arr = F.array(*[F.lit(v) for v in values])
        return F.element_at(arr, (F.pmod(self.h(id_col, salt), F.lit(len(values))) + 1).cast("int"))

    def uniform(self, id_col: Column, salt: int, lo: float, hi: float, scale: int = 2) -> Column:
        frac = F.pmod(self.h(id_col, salt), F.lit(1_000_000)) / F.lit(1_000_000.0)
        return F.round(F.lit(lo) + frac * F.lit(hi - lo), scale)


def _spine(spark: SparkSession, n: int, name: str, partitions: int | None) -> DataFrame:
    return spark.range(0, n, numPartitions=partitions).withColumnRenamed("id", name)


def generate_inputs(spark: SparkSession, n_patients: int = 3000, n_providers: int = 150,
                    n_departments: int = 15, n_diagnoses: int = 120, n_encounters: int = 25000,
                    start: str = "2023-01-01", span_days: int = 700,
                    partitions: int | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """The input tables as lazy DataFrames (nothing is computed here).
    Same ``seed``, same data; another seed gives other, equally
    deterministic values."""
    hs = _Hasher(seed)
    _h, _pick, _uniform = hs.h, hs.pick, hs.uniform
    id_ = F.col
    region = _spine(spark, len(REGIONS), "r_regionkey", 1).select(
        F.col("r_regionkey").cast("int").alias("r_regionkey"),
        F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col("r_regionkey") + 1).cast("int"))
         .alias("r_name"))
    nation = _spine(spark, n_departments, "k", 1).select(
        id_("k").cast("int").alias("n_nationkey"),
        F.concat(F.lit("DEPT_"), id_("k").cast("string")).alias("n_name"),
        F.pmod(id_("k"), F.lit(len(REGIONS))).cast("int").alias("n_regionkey"))
    first, last = _pick(GIVEN_NAMES, id_("k"), 1), _pick(FAMILY_NAMES, id_("k"), 2)
    customer = _spine(spark, n_patients, "k", partitions).select(
        id_("k").alias("c_custkey"),
        F.initcap(F.concat_ws(" ", first, last)).alias("c_name"),
        F.pmod(_h(id_("k"), 3), F.lit(n_departments)).cast("int").alias("c_nationkey"),
        _uniform(id_("k"), 4, -999.99, 9999.99).alias("c_acctbal"),
        _pick(SEGMENTS, id_("k"), 5).alias("c_mktsegment"))
    supplier = _spine(spark, n_providers, "k", partitions).select(
        id_("k").alias("s_suppkey"),
        F.initcap(F.concat_ws(" ", _pick(GIVEN_NAMES, id_("k"), 6), _pick(FAMILY_NAMES, id_("k"), 7)))
         .alias("s_name"),
        F.pmod(_h(id_("k"), 8), F.lit(n_departments)).cast("int").alias("s_nationkey"),
        _uniform(id_("k"), 9, -999.99, 9999.99).alias("s_acctbal"))
    part = _spine(spark, n_diagnoses, "k", partitions).select(
        id_("k").alias("p_partkey"),
        F.concat_ws(" ", _pick(PART_WORDS, id_("k"), 10), _pick(PART_NOUNS, id_("k"), 11)).alias("p_name"),
        F.concat(F.lit("Brand#"), (F.pmod(_h(id_("k"), 12), F.lit(50)) + 1).cast("string")).alias("p_brand"),
        _pick(PART_TYPES, id_("k"), 13).alias("p_type"),
        (F.pmod(_h(id_("k"), 14), F.lit(50)) + 1).cast("int").alias("p_size"),
        _uniform(id_("k"), 15, 900.0, 2000.0).alias("p_retailprice"))
    day0 = F.lit(start).cast("date")
    orders = _spine(spark, n_encounters, "k", partitions).select(
        id_("k").alias("o_orderkey"),
        F.pmod(_h(id_("k"), 16), F.lit(n_patients)).alias("o_custkey"),
        _pick(["F", "O", "P"], id_("k"), 17).alias("o_orderstatus"),
        _uniform(id_("k"), 18, 1000.0, 500000.0).alias("o_totalprice"),
        F.date_add(day0, F.pmod(_h(id_("k"), 19), F.lit(span_days)).cast("int"))
         .cast("timestamp_ntz").alias("o_orderdate"),
        _pick(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], id_("k"), 20)
         .alias("o_orderpriority"))
    lines = (orders.select("o_orderkey", "o_orderdate",
                           F.explode(F.sequence(F.lit(1), (F.pmod(_h(F.col("o_orderkey"), 21), F.lit(4)) + 1)
                                                .cast("int"))).alias("l_linenumber")))
    lid = F.col("o_orderkey") * 8 + F.col("l_linenumber")
    lineitem = lines.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.pmod(_h(lid, 22), F.lit(n_diagnoses)).alias("l_partkey"),
        F.pmod(_h(lid, 23), F.lit(n_providers)).alias("l_suppkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        (F.pmod(_h(lid, 24), F.lit(50)) + 1).cast("double").alias("l_quantity"),
        _uniform(lid, 25, 1500.0, 41500.0).alias("l_extendedprice"),
        (F.pmod(_h(lid, 26), F.lit(11)) / F.lit(100.0)).alias("l_discount"),
        (F.pmod(_h(lid, 27), F.lit(9)) / F.lit(100.0)).alias("l_tax"),
        _pick(RETURN_FLAGS, lid, 28).alias("l_returnflag"),
        _pick(["O", "F"], lid, 29).alias("l_linestatus"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.pmod(_h(lid, 30), F.lit(3)) + 1).cast("int"))
         .cast("timestamp_ntz").alias("l_shipdate"))
    return {"region": region, "nation": nation, "customer": customer, "supplier": supplier,
            "part": part, "orders": orders, "lineitem": lineitem}


def write_inputs(spark: SparkSession, folder: str, **sizes) -> str:
    """Write the generated tables as ``<folder>/<name>.parquet``; returns ``folder``."""
    for name, df in generate_inputs(spark, **sizes).items():
        df.write.mode("overwrite").parquet(os.path.join(folder, f"{name}.parquet"))
    return folder
