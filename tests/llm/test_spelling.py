"""Spelling variants: the index against all pairs, odd rows against the SQL."""

import random
from collections import Counter

import pytest
from oracle_compare import compare, duckdb_conn

from wardline.llm import spelling as sp
from wardline.llm.queries import ORACLE, QUERIES

ROOT = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


@pytest.mark.parametrize("n,letters,low,high", [(60, "ab", 6, 9), (300, "abc", 6, 8), (200, "abéü", 2, 12), (40, "a", 6, 60), (50, "ab", 6, 90)])
def test_pairs(n, letters, low, high):
    rnd = random.Random(n)
    words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in range(n)})
    words = sorted({*words, *(w[:k] + w[k + 1:] for w in words[::7] for k in (0, len(w) // 2, len(w) - 1))} - {"", "a", "b", "é", "ü"})
    q, w = sp.near_pairs(words, words, words)
    assert sorted(zip(q, w, strict=True)) == [(a, b) for a in words for b in words if one_edit(a, b)]
    assert sp.near_pairs([], words, words) == ([], []) == sp.near_pairs(words, [], [])


def brute(count, ratio=5):
    out = {}
    for w, n in count.items():
        near = sorted((-m, v) for v, m in count.items() if v != w and one_edit(v, w))
        out[w] = (near[0][1] if near and -near[0][0] >= ratio * n else None, len(near))
    rows = []
    for w, n in count.items():
        form, root = out[w][0], w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, out[w][1], count[form] if form else None))
    return sorted(rows)


@pytest.mark.parametrize("hot,chars", [(20_000, 400_000), (3, 400_000), (20_000, 200)])
def test_variants_in_shards_and_blocks(spark, hot, chars):
    rnd = random.Random(hot + chars)
    count = {}
    for k in range(150):
        w = "common" + "".join(rnd.choice("xyz") for _ in range(rnd.randint(1, 4))) if k % 3 else "".join(rnd.choice("pqé") for _ in range(7))
        count[w] = rnd.choice([5, 5, 30, 200, 2000])
    table = spark.createDataFrame(list(count.items()), "word string, n long").repartition(4)
    assert sorted(map(tuple, sp.variants(table, hot=hot, shard_chars=chars).collect())) == brute(count)


def test_odd_rows(spark, odd_docs, no_docs):
    import duckdb
    rows = [(i, "Straße straßen STRASSE Mañana mañana mananas wordéé wordée ×÷×÷×÷ " * (1 + i % 3)) for i in range(40)]
    rows += [(None, "Straße" * 3000 + " straßen"), (1, None), (None, None), (2, ""), (3, "ab\u0000cdefg\nabcdefg"), (3, "ab\u0000cdefg\nabcdefg")]
    table = spark.createDataFrame([(*r, 1, "w", "f") for r in rows], "doc_id long, text string, n long, word string, form string").repartition(3)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    r = compare(sp.groups(table, slip=sp.slips()), con, ORACLE["op12_spelling_variants"])
    assert r["match"] and r["spark_rows"] > 5, r
    count = Counter()
    import re
    for r in odd_docs.collect():
        count.update(x.lower() for x in re.findall("[A-Za-zÀ-ÿ]{6,}", r["text"] or ""))
    assert sorted(map(tuple, sp.groups(odd_docs).collect())) == brute({w: n for w, n in count.items() if n >= 5})
    assert sp.groups(no_docs).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    root = f"/root/testdata/{sf}"
    r = compare(QUERIES["op12_spelling_variants"](spark, root), duckdb_conn(root), ORACLE["op12_spelling_variants"])
    assert r["match"], r
