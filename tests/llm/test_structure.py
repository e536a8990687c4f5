"""Conversation repair: the search against all edit sequences, and the query against its SQL on odd tables."""

import hashlib
import random

import pytest
from oracle_compare import compare, duckdb_conn
from pyspark.sql import functions as F

from wardline.llm import structure as st
from wardline.llm.queries import ORACLE, QUERIES

ROOT = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, pos int, key string, fault string, block int"


def cheapest(letters):
    """Least (cost, audit), each row's edits put behind all ways to the row before."""
    ways = {0: (0, "")}

    def inserted(ways):
        for _ in range(3):
            more = [((2 if s in (0, 1, 3) else 3), (c + 5, a + "I")) for s, (c, a) in ways.items()]
            ways = {s: min(w for t, w in [*ways.items(), *more] if t == s) for s in {s for s, _ in [*ways.items(), *more]}}
        return ways

    for initial, fault in zip(letters[::2], letters[1::2], strict=True):
        new = []
        for s, (c, a) in inserted(ways).items():
            new.append((s, (c + 2, a + "D")))
            if fault in "bd":
                continue
            c += 5 * (fault == "t")
            if (s, initial) in st.NEXT:
                new.append((st.NEXT[s, initial], (c, a + "K")))
            new.append((2 if s in (0, 1, 3) else 3, (c + 1, a + "R")))
        ways = {s: min(w for t, w in new if t == s) for s, _ in new}
    return min(w for s, w in inserted(ways).items() if s in (0, 3))


def test_search_is_optimal():
    rnd = random.Random(5)
    for n in [*range(9)] * 40 + [50] * 5:
        letters = "".join(rnd.choice("suax") + rnd.choice("....bdt") for _ in range(n))
        want = cheapest(letters)
        assert st.search(letters, 0, st.NO_END) == want
        if not n:
            continue
        path = st._Path()  # the same, joined from blocks of three rows
        for k in range(0, len(letters), 6):
            part = letters[k:k + 6]
            found = [{"s": s, "e": e, "cost": g[0], "audit": g[1]} for s in range(4 if k else 1) for e in range(4)
                     if (g := st.search(part, s, (("", 0, e),)))]
            path.add(part[0], part[-2], st.illegal_pairs(part[::2]), found)
        cost, illegal, parts = path.close(5)
        assert (cost, "".join(a for _, a in parts)) == want and illegal == st.illegal_pairs(letters[::2])


def check(spark, rows, blocks=(64, 3)):
    import duckdb
    table = spark.createDataFrame([(*r, 1, "k", "f", 2) for r in rows], SCHEMA).repartition(3)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    for block in blocks:
        got = st.report(table, st.damaged(table), block=block, order=("copy",))
        r = compare(got, con, ORACLE["op11_structure_repair"])
        assert r["match"], r
    return {r["conv_id"]: r for r in got.collect()}


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "one."), (1, None, "assistant", "two"), (1, 5, "", "x."),
            (1, 5, "user", "x."), (1, 5, "user", "x."), (1, 9, "tool", "　"), (2, 0, "system", "s."), (2, 1, "system", "s!"),
            (2, 2, "assistant", "yes?\n \t"), (2, 4, "user", "long " * 30_000), (3, 1, "user", " \t\n"), (3, 1, "user", ""),
            (4, 7, "assistant", "é"), (5, 1, "Äffchen", "ü."), (5, 2, "user", "🙂."), (5, -4, "assistant", "🙂.")]
    rows += [(6, t, random.Random(t).choice(["user", "assistant", "system", "bot"]), f"t{t % 7}" + "." * (t % 3)) for t in range(200)]
    got = check(spark, rows)
    assert len(got) == 7 and len(got[6]["audit"]) >= 180
    assert check(spark, []) == {}


def test_every_row_dropped(spark):
    import zlib
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = check(spark, [(gone, 0, "user", "a.")])[gone]
    assert tuple(got)[1:7] == (0,) * 6 and got["audit"] == "" and got["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repaired_rows(spark):
    table = spark.createDataFrame([(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "user", "q?"), (1, 3, "user", "q?")],
                                  "conv_id long, turn long, role string, text string")
    rows = st.faults(table)
    for block in (2, 64):
        fixed = st.repaired(rows, st.solve(rows, block=block), block).orderBy("block", "place")
        assert [(r["role"], r["edit"], r["text"]) for r in fixed.collect()] == [("system", "K", "s."), ("user", "R", "a."), ("assistant", "R", "q?")]
    # with deletions as dear as that, rows are inserted instead: s, (u), a, u, the repeated row goes, (a)
    dear = st.solve(rows, st.Costs(rerole=9, delete=9)).agg(F.max("cost"), F.max("audit")).first()
    assert tuple(dear) == (19, "KIKKDI")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    root = f"/root/testdata/{sf}"
    r = compare(QUERIES["op11_structure_repair"](spark, root), duckdb_conn(root), ORACLE["op11_structure_repair"])
    assert r["match"], r
