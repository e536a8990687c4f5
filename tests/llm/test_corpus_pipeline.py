"""The corpus pipeline stage by stage, and its entry in the driver's table."""

import corpus_pipeline
import pytest
from test_operators import leaks, line_classes, packed_right, words

from wardline.llm import simhash, toxicity
from wardline.llm.queries import tokenizer_path

ROOT = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [f"op{n}" for n in range(1, 14)] == [k.split("_")[0] for k in __spark_entry__.queries() if k.startswith("op")
                                                and k[2].isdigit()]


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, ROOT)
        assert new.columns == docs.columns
        got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in new.collect()}
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity.score(docs, spark.read.parquet(f"{ROOT}/labels.parquet")).collect() if r["predicted"]}
            want = {i: t for i, t in kept.items() if i not in bad}
        elif name == "line_dedup":
            gone = line_classes(kept.items())
            want = {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in kept.items()}
            want = {i: t for i, t in want.items() if words(t) or t == kept[i]}
        elif name == "simhash_near_dedup":
            fps = sorted((i, simhash.fingerprint(t.encode())) for i, t in kept.items())
            root = {i: i for i, _ in fps}
            for _ in fps:
                for i, f in fps:
                    root[i] = min(root[j] for j, g in fps if (f ^ g).bit_count() <= 2)
            want = {i: kept[i] for i, _ in fps if root[i] == i}
        else:
            bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
            bad = {d for d, _ in leaks(kept.items(), bench)}
            want = {i: t for i, t in kept.items() if i not in bad}
        assert {i: t for i, (t, _) in got.items()} == want
        assert all(n == len(t) for i, (t, n) in got.items() if t != kept[i])
        kept, docs = want, spark.createDataFrame(new.collect(), new.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, ROOT)
    assert {r["doc_id"] for r in last.collect()} == set(kept)
    from wardline.llm import packing
    packed_right(list(kept.items()), packing.pack(docs, tokenizer_path()).collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, ROOT).collect())) == sorted(map(tuple, last.collect()))


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_stages_on_odd_rows(spark, which, request):
    docs = request.getfixturevalue(which)
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, ROOT)
        if name != "packing":
            assert out.columns == docs.columns
            assert out.count() <= n
            if n and name != "line_dedup":
                assert out.where("doc_id is null").count() == 2
