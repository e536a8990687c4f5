"""Source mixing: targets by hand, rows against the SQL, equal documents at an edge."""

import random
from collections import defaultdict

import pytest
from oracle_compare import compare, duckdb_conn
from pyspark.sql import functions as F

from wardline.llm import mixing
from wardline.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, source string, size long, h long, key string, target double, taken long, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", 0.5, 3, 4) for r in rows], SCHEMA).repartition(5)


def fill(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, the excess over the cap shared again among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    goal, open_, left = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in sorted(open_, key=str):
            goal[s] += share * weight[s]
            if goal[s] >= most * sizes[s]:
                left += goal[s] - most * sizes[s]
                goal[s] = float(most * sizes[s])
        open_ = {s for s in open_ if goal[s] < most * sizes[s]}
    return goal


def near_targets(rows, tolerance=0.001):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    goal = fill({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert all(r["target"] == pytest.approx(goal[s]) and r["source_size"] == sum(x["size"] for x in rs) for r in rs)
        times = [r["taken"] // r["size"] for r in rs if r["size"]]
        assert all(r["taken"] <= 3 * r["size"] and (r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0) for r in rs)
        assert not times or max(times) - min(times) <= 1
        short = goal[s] - sum(r["taken"] for r in rs)
        least = min([r["size"] for r in rs if r["size"] and r["taken"] // r["size"] == min(times)], default=0)
        assert -1e-6 <= short and (short <= tolerance * goal[s] + 1 or short < least + 1), (s, short, least)


def test_targets_and_rows(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join("w" * rnd.randint(1, 4) for _ in range(rnd.choice([0, 1, 5, 40, 400]))), rnd.choice(["b", "a", "Z", "é", None, "ab"]))
            for i in range(400)]
    rows += [(900 + i, "one two three", "tiny") for i in range(2)] + [(990, None, "none"), (991, " \t\n", "none"), (None, "a b", None), (None, None, "b")]
    got = mixing.mix(table(spark, rows))
    found = got.collect()
    assert len(found) == len(rows) and got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    near_targets(found)
    import duckdb
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    r = compare(got.drop("source"), con, ORACLE["op13_source_mixing"])
    assert r["match"], r


def test_one_hot_group_of_copies(spark):
    rows = [(7, "the same words again and again", "hot")] * 300 + [(i, f"other words {i}", "hot") for i in range(30)] + [(None, "x y z", "small")] * 9
    found = mixing.mix(table(spark, rows)).collect()
    near_targets(found)
    again = mixing.mix(table(spark, rows[::-1])).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)
    texts = mixing.mixed_texts(table(spark, rows)).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r["source"]: r["n"] for r in texts} == {s: sum(r["taken"] for r in found if r["source"] == s) for s in ("hot", "small")}


def test_edges(spark, odd_docs, no_docs):
    near_targets(mixing.mix(odd_docs).collect())
    assert mixing.mix(no_docs).count() == 0
    assert [r["taken"] for r in mixing.mix(table(spark, [(1, "", "a"), (2, None, None)])).collect()] == [0, 0]
    only = mixing.mix(table(spark, [(1, "a b", "a"), (2, "c", "a")])).collect()
    assert sorted((r["size"], r["target"], r["taken"]) for r in only) == [(1, 3.0, 1), (2, 3.0, 2)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    root = f"/root/testdata/{sf}"
    r = compare(QUERIES["op13_source_mixing"](spark, root), duckdb_conn(root), ORACLE["op13_source_mixing"])
    assert r["match"], r
