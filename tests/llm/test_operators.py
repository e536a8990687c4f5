"""The operators on Spark: odd rows, empty tables, and brute force on a small table."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from oracle_compare import compare, duckdb_conn
from pyspark.sql import functions as F

from wardline.llm import (chat, components, decontamination, extraction, lines, packing, quality, simhash, substrings,
                          suffixes, toxicity)
from wardline.llm.queries import ORACLE, QUERIES, tokenizer_path

ROOT = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]


def packed_right(docs, got, window=2048):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[(i, len(ids), b"".join(x.to_bytes(4, "little") for x in ids))] += 1
    parts, seqs = {}, {}
    for r in got:
        parts.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= window
    for (i, n), own in parts.items():
        copies = want[(i, n, b"".join(b for _, b in sorted(set(own))))]
        assert copies and all(c == copies for c in Counter(own).values())
    assert sum(r["length"] for r in got) == sum(k[1] * v for k, v in want.items())
    return len(seqs)


def test_packing(spark, documents, odd_docs, no_docs):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    got = packing.pack(docs, tokenizer_path()).collect()
    used = packed_right([d[:2] for d in documents], got)
    assert used <= 1.03 * sum(r["length"] for r in got) / 2048 + 1
    odd = packing.pack(odd_docs, tokenizer_path(), shard_bytes=3000)
    packed_right(rows(odd_docs.select("doc_id", "text")), odd.collect())
    for r in packing.sequences(odd).collect():
        assert len(r["ids"]) <= 4 * 2048 and r["doc_ids"] is not None
    assert packing.pack(no_docs, tokenizer_path()).count() == 0
    q = QUERIES["op1_packing"](spark, ROOT).collect()
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in q} == {
        (r["doc_id"], r["start"], zlib.crc32(bytes(r["ids"]))) for r in got}


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (3, 3), (5, 4), (4, 6), (6, 7), (7, 10), (2, 1), (None, 3), (11, 11)]
    got = dict(rows(components.connected_components(spark.createDataFrame(links, "a long, b long"))))
    want = components_of({1, 2, 3, 4, 5, 6, 7, 8, 9, 10}, [x for x in links if None not in x and x[0] != x[1]])
    assert got == want
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash(spark, documents, odd_docs, no_docs):
    def brute(docs):
        fps = [(i, simhash.fingerprint((t or "").encode())) for i, t in docs]
        of = {}
        for i, f in fps:
            of[f] = min([x for x in (i, of.get(f)) if x is not None], default=None)
        links = [(a, b) for a in of for b in of if a < b and (a ^ b).bit_count() <= 2]
        comp = components_of(of, links)
        least = {}
        for f, c in comp.items():
            least[c] = min([x for x in (of[f], least.get(c)) if x is not None], default=None)
        return sorted(((i, f"{f:016x}", least[comp[f]]) for i, f in fps), key=str)

    got = QUERIES["op6_simhash_near_dedup"](spark, ROOT)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(rows(got), key=str) == brute([d[:2] for d in documents])
    odd = rows(odd_docs.select("doc_id", "text"))
    near = simhash.near_duplicates(odd_docs)
    assert sorted(rows(near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")), key=str) == brute(odd)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one_per_group(odd_docs, near)
    assert kept.columns == odd_docs.columns
    assert sorted(r[0] for r in rows(kept) if r[0] is not None) == sorted(
        i for i, _, c in brute(odd) if i is not None and i == c)


def leaks(docs, items):
    inv = [(i, [tuple(w[k:k + 5]) for k in range(len(w) - 4)] or [tuple(w)]) for i, w in
           ((i, words((t or "").lower())) for i, t in items) if w]
    out = {}
    for d, t in docs:
        w = words((t or "").lower())
        if not w:
            continue
        sh = [tuple(w[k:k + 5]) for k in range(len(w) - 4)] or [tuple(w)]
        have = set(sh)
        for i, own in inv:
            if not have & set(own):
                continue
            n, c = len(own), Counter(own)
            for s in range(max(1, len(sh) - n + 1)):
                x = Counter(sh[s:s + n])
                both = sum((x & c).values())
                sim = both / (sum(x.values()) + n - both)
                if sim >= 0.8:
                    out[(d, i)] = max(out.get((d, i), 0), sim)
    return out


def test_decontamination(spark, documents, odd_docs, no_docs):
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet")
    items = rows(bench.select("item_id", "text"))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op3_decontamination"](spark, ROOT).collect()}
    assert got == pytest.approx(leaks([d[:2] for d in documents], items))
    base = rows(odd_docs.where("doc_id = 1").select("text"))[0][0]
    more = [(1, base[:300], 0), (2, base[:300], 1), (None, base, 2), (3, None, 3), (4, "", 4), (5, "ONE", 5), (6, "two words", 6),
            (7, " ".join(base.split()[40:100]) + " x", 7)]
    odd_items = spark.createDataFrame(more, "item_id long, text string, h int")
    docs = odd_docs.where("doc_id is not null or text is not null")
    want = leaks(rows(docs.select("doc_id", "text")), [m[:2] for m in more])
    found = decontamination.matches(docs, odd_items)
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()} == pytest.approx(want)
    assert len(want) > 8
    kept = decontamination.without_leaks(odd_docs, found)
    assert {r[0] for r in rows(kept)} == {r[0] for r in rows(odd_docs.select("doc_id"))} - {d for d, _ in want if d is not None}
    assert decontamination.matches(no_docs, odd_items).count() == 0
    assert decontamination.matches(docs, odd_items.where("false")).count() == 0


def test_decontamination_at_the_very_similarity(spark):
    """Short documents that lack an item's first or last fifth of shingles."""
    item = [f"word{i}" for i in range(44)]
    items = [(1, " ".join(item)), (2, " ".join(item[:24]))]
    docs = [(1, " ".join(item[8:])), (2, " ".join(item[:-8])), (3, " ".join(item[9:])), (4, " ".join(item[4:24])), (5, " ".join(item[:20]))]
    want = leaks(docs, items)
    assert want[(1, 1)] == want[(2, 1)] == want[(4, 2)] == want[(5, 2)] == 0.8 and (3, 1) not in want
    found = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"),
                                    spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()} == pytest.approx(want)


def removed_by_windows(docs, split, window=50):
    """(id, n, removed, runs, kept) by definition, ids of NULL last."""
    key = lambda d: (d[0] is None, d[0] or 0)
    first, out = {}, []
    for i, t in docs:
        seq = split(t)
        for k in range(len(seq) - window + 1):
            w = tuple(seq[k:k + window])
            first[w] = min(first.get(w, (True, 1 << 70)), key((i,)))
    for i, t in docs:
        seq = split(t)
        gone = [False] * len(seq)
        for k in range(len(seq) - window + 1):
            if first[tuple(seq[k:k + window])] < key((i,)):
                gone[k:k + window] = [True] * window
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(seq), sum(gone), runs, [x for x, g in zip(seq, gone, strict=True) if not g]))
    return out


def test_substrings(spark, documents, odd_docs, no_docs):
    split = lambda t: [w.encode() for w in words(t)]
    hashed = lambda k: hashlib.sha256(b" ".join(k)).hexdigest()
    want = sorted((i, n, g, hashed(k)) for i, n, g, _, k in removed_by_windows([d[:2] for d in documents], split))
    assert sorted(rows(QUERIES["op7_substring_dedup"](spark, ROOT))) == want and sum(w[2] for w in want) > 0
    want = sorted(((i, n, g, hashed(k)) for i, n, g, _, k in removed_by_windows(rows(odd_docs.select("doc_id", "text")), split)), key=str)
    assert sorted(rows(substrings.remove(odd_docs).select("doc_id", "n_words", "n_removed", "kept_sha256")), key=str) == want
    assert substrings.remove(no_docs).count() == 0
    assert substrings.levels(50) == [25, 50] and substrings.levels(50, 4) == [6, 12, 24, 48, 50]


def test_suffix_arrays(spark, documents, odd_docs, no_docs):
    split = lambda t: (t or "").encode()
    hashed = lambda k: hashlib.sha256(bytes(k)).hexdigest()
    some = [d for d in documents if len(d[1]) < 6000]
    table = spark.createDataFrame([d[:2] for d in some], "doc_id long, text string")
    for docs, plain in ((table, [d[:2] for d in some]), (odd_docs, None)):
        plain = plain or rows(docs.select("doc_id", "text"))
        want = sorted(((i, n, g, r, hashed(k)) for i, n, g, r, k in removed_by_windows(plain, split)), key=str)
        got = suffixes.remove(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long"), "kept_sha256")
        assert sorted(rows(got), key=str) == want
    assert suffixes.remove(no_docs).count() == 0
    q = QUERIES["op4_suffix_array_dedup"](spark, ROOT)
    assert q.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and q.count() == len(documents)


def test_repeats_with_ids_at_the_limits_and_shared(spark, documents):
    """The largest and smallest ids, NULL ids, one id for many rows: texts that
    repeat each other in part, whole, and not at all."""
    top, base = (1 << 63) - 1, " ".join(t for _, t, _ in documents[:40] if t).split()
    text = lambda a, n=70: " ".join(base[a:a + n])
    docs = [(top, text(0)), (None, text(0)), (None, text(10)), (top - 1, text(5)), (top - 3, text(300)), (-top - 1, text(340)),
            (None, text(300)), (5, text(600)), (5, text(610)), (7, text(590)), (top, text(620)), (top, text(900)), (None, ""), (None, None)]
    docs += [(None, text(900 + 3 * (k % 5))) for k in range(40)] + [(5, text(1200 + k % 3)) for k in range(30)] + [(6, text(1210))]
    for own in (docs, [d for d in docs if d[0] != top]):
        table = spark.createDataFrame(own, "doc_id long, text string").repartition(4)
        hashed = lambda k: hashlib.sha256(k).hexdigest()
        want = sorted(((i, n, g, hashed(b" ".join(k))) for i, n, g, _, k in
                       removed_by_windows(own, lambda t: [w.encode() for w in words(t)])), key=str)
        assert sorted(rows(substrings.remove(table).select("doc_id", "n_words", "n_removed", "kept_sha256")), key=str) == want
        want = sorted(((i, n, g, hashed(bytes(k))) for i, n, g, _, k in removed_by_windows(own, lambda t: (t or "").encode())), key=str)
        assert sorted(rows(suffixes.remove(table).select("doc_id", "n_bytes", "n_removed", "kept_sha256")), key=str) == want


def line_classes(docs, tau=2, near=48):
    """{(id, line number): first place of its class} by all pairs: lines of
    ``near`` characters and more within ``tau`` edits, shorter ones that are not
    blank if they are equal."""
    key = lambda p: (p[0] is not None, p[0] or 0, p[1])
    places = {}
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            if len(line) >= near or words(line):
                places.setdefault(line, set()).add((i, n))
    texts = sorted(places)
    long = [t for t in texts if len(t) >= near]
    links = [(a, b) for k, a in enumerate(long) for b in long[k + 1:] if abs(len(a) - len(b)) <= tau and lines.within(a, b, tau)]
    comp = components_of(texts, links)
    first = {}
    for t, c in comp.items():
        first[c] = min([*places[t], *([first[c]] if c in first else [])], key=key)
    return {p: first[comp[t]] for t in texts for p in places[t] if p != first[comp[t]]}


def test_lines(spark, documents, odd_docs, no_docs):
    want = line_classes([d[:2] for d in documents])
    got = QUERIES["op8_line_dedup"](spark, ROOT).collect()
    assert {(r["doc_id"], r["line_no"]): (r["kept_doc_id"], r["kept_line_no"]) for r in got} == want and len(got) == len(want)
    odd = rows(odd_docs.select("doc_id", "text"))
    found = lines.duplicate_lines(odd_docs)
    want = line_classes(odd)
    assert {tuple(r[:2]): tuple(r[2:4]) for r in rows(found)} == want
    kept = lines.without_lines(odd_docs, found)
    assert kept.columns == odd_docs.columns
    text = {}
    for i, t in odd:
        left = "\n".join(x for n, x in enumerate((t or "").split("\n")) if (i, n) not in want)
        if words(left) or left == (t or ""):
            text.setdefault(i, []).append(left if left != (t or "") else t)
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"] is not None) == sorted(
        (str(i), t) for i, ts in text.items() for t in ts if t is not None)
    assert lines.duplicate_lines(no_docs).count() == 0
    assert lines.without_lines(no_docs, found).count() == 0


def test_short_lines(spark, documents):
    plain = [d[:2] for d in documents]
    want = line_classes(plain)
    assert any(len(t.split("\n")[n]) < 48 for i, t in plain for d, n in want if d == i)
    got = QUERIES["op8_line_dedup"](spark, ROOT).collect()
    assert {tuple(r)[:2]: tuple(r)[2:4] for r in got} == want and len(got) == len(want)
    near = "Subscribe to our newsletter for more stories,"
    odd = [(1, "Menu\n\n \nstory one\nMenu"), (2, f"Menu\n\n \nstory two\n{near} a"), (None, "Menu\nmenu\n"), (3, None), (4, "\u3000\nx"),
           (5, f"\u3000\nx \n{near} b"), (6, f"{near} b\n{near} now\n{near} new")]
    found = lines.duplicate_lines(spark.createDataFrame(odd, "doc_id long, text string"))
    want = line_classes(odd)
    assert {tuple(r)[:2]: tuple(r)[2:4] for r in rows(found)} == want == {
        (1, 0): (None, 0), (1, 4): (None, 0), (2, 0): (None, 0), (5, 0): (4, 0), (6, 0): (5, 2), (6, 2): (6, 1)}
    assert all(r["exact"] == (tuple(r)[:2] != (6, 2)) for r in found.collect())


def test_rows_of_one_id_lose_their_own_lines(spark):
    line = "a line that is long enough to be compared with others by edits, "
    docs = spark.createDataFrame([(1, f"{line}A"), (2, f"{line}A\nnothing like it"), (2, "here is a clean line\nand one more of them")],
                                 "doc_id long, text string")
    kept = lines.without_lines(docs, lines.duplicate_lines(docs))
    assert sorted(rows(kept)) == [(1, f"{line}A"), (2, "here is a clean line\nand one more of them"), (2, "nothing like it")]


def test_rows_without_an_id_and_words_of_other_spaces(spark):
    """NULL ids lose the lines that were reported for them; U+3000 is no white space, so a line of it is a word."""
    docs = spark.createDataFrame([(None, "menu\nfirst of all"), (None, "menu\nsecond"), (5, "\u3000\nmenu"), (6, "menu\n \t"), (7, "menu")],
                                 "doc_id long, text string")
    kept = lines.without_lines(docs, lines.duplicate_lines(docs))
    got = sorted(rows(kept), key=str)
    assert sorted(t for i, t in got if i is None) in (["first of all", "menu\nsecond"], ["menu\nfirst of all", "second"], ["menu\nfirst of all", "menu\nsecond"])
    assert (5, "\u3000") in got and not [i for i, _ in got if i in (6, 7)]


def test_hot_segments_are_cut_into_blocks(spark):
    head = "a very common beginning that many different lines have in common "
    near = [f"{head}{i:04d} {'x' * (i % 5)} the end of the line" for i in range(60)] + [f"{head}0007 xx the end of the line."]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(near)], "line_id long, line string")
    links = rows(lines.line_links(table, 2, block=7))
    want = components_of(range(len(near)), [(i, j) for i in range(len(near)) for j in range(i) if lines.within(near[i], near[j], 2)])
    assert components_of(range(len(near)), links) == want


def test_quality(spark, documents, odd_docs, no_docs):
    def brute(docs, limit):
        hosts = Counter((s, line) for _, t, s in docs for line in {" ".join(words(x)).lower() for x in (t or "").split("\n")} if line)
        out = []
        for i, t, s in docs:
            ws, seen, dup = words(t), set(), 0
            for x in (t or "").split("\n"):
                if words(x):
                    dup += x in seen
                    seen.add(x)
            grams = [tuple(ws[k:k + 5]) for k in range(len(ws) - 4)]
            c = Counter(grams)
            rep = len({j for k, g in enumerate(grams) if c[g] > 1 for j in range(k, k + 5)})
            lost = sum(len(words(x)) for x in (t or "").split("\n") if hosts[(s, " ".join(words(x)).lower())] > limit)
            failed = len(ws) < 10 or 100 * rep > 20 * len(ws)
            left = len(ws) - lost
            out.append((i, len(ws), sum(map(len, ws)), sum((t or "").count(x) for x in "#*$%&|<>"), dup, rep, failed,
                        not failed and left >= 10 and left >= 0.5 * len(ws), lost))
        return sorted(out, key=str)

    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words"]
    assert sorted(rows(QUERIES["op5_quality_rules"](spark, ROOT).select(cols)), key=str) == brute(documents, 100)
    odd = rows(odd_docs.select("doc_id", "text", "source"))
    for docs, plain in ((spark.read.parquet(f"{ROOT}/documents.parquet"), documents), (odd_docs, odd)):
        assert sorted(rows(quality.judge(docs, max_docs=1).select(cols)), key=str) == brute(plain, 1)
    assert quality.judge(no_docs).count() == 0


def test_extraction(spark):
    table = spark.createDataFrame([(1, "u", "<article><p>a</p></article>", 1), (1, "u", "<article><p>a</p></article>", 1),
                                   (2, None, None, 2), (None, "v", "", 3)], "page_id long, url string, html string, text int")
    assert sorted(rows(extraction.extract(table)), key=str) == sorted(
        [(1, "u", "a", 1), (1, "u", "a", 1), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert extraction.extract(table.where("false")).count() == 0
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{ROOT}/pages.parquet").collect()}
    import html
    for r in QUERIES["op9_html_extraction"](spark, ROOT).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])


def test_chat(spark):
    long = "One two three four five. Six seven eight nine. Ten eleven"
    turns = [(1, 0, "u", "Hello there my friend\nHow are you?"), (1, 1, "a", "> How are you?\nFine thanks\nand you"),
             (1, 2, "u", "On Monday x wrote:\n> Hello there my friend\nAnother reply"),
             (1, 3, "a", ">> How are you?\n> Fine  THANKS\nok"),
             (None, None, None, None), (1, 3, "a", "> nothing known"), (2, 0, "u", "a\n> b"), (2, 0, "u", "a\n> b"),
             # wrapped anew; only the second level known; a sentence of a passage; a passage quoted twice
             (3, 0, "u", f"{long}\n\nOther words here."), (3, 1, "a", "Mine."),
             (3, 2, "u", "He wrote:\n> One two three\n> four five. Six seven\n> eight nine.\n> Ten eleven\n\nYes"),
             (3, 3, "a", "> not known\n>> Other words\n>> here.\nNo"), (3, 4, "u", "> Six seven\n> eight nine.\nSo"),
             (3, 5, "a", f"> she wrote:\n>> {long}\n>\n> Yes\nWell"), (3, 6, "u", f">>> {long}\n\n>> Yes"),
             (4, 0, "u", ""), (4, 1, "a", "> " + "long line " * 30_000), (4, 2, "u", ">" * 200 + " deep"), (4, 2, "u", "> >  >")]
    table = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn int, role string, text string, position int, own int")
    links = rows(chat.quotation_links(chat.ranked_messages(table)))
    assert sorted(links) == [("1", 1, 1, 0, 3), ("1", 2, 1, 0, 4), ("1", 4, 1, 1, 2), ("1", 4, 2, 1, 3),
                             ("3", 2, 1, 0, 11), ("3", 3, 2, 0, 3), ("3", 4, 1, 0, 4), ("3", 5, 1, 2, 1), ("3", 5, 2, 2, 11),
                             ("3", 6, 2, 5, 1), ("3", 6, 3, 5, 11)]
    con = __import__("duckdb").connect()
    con.execute("create table conversations (conv_id bigint, turn int, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", turns)
    assert compare(chat.conversations(table), con, chat.ORACLE_SQL)["match"]
    assert chat.conversations(table.where("false")).count() == 0
    assert compare(QUERIES["op2_chat_formatting"](spark, ROOT), duckdb_conn(ROOT), ORACLE["op2_chat_formatting"])["match"]


def test_toxicity(spark, odd_docs, no_docs):
    got = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.01")
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    right, n = 0, 0
    for r in got.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in labels:
            n += 1
            right += r["predicted"] == labels[r["doc_id"]]
    assert n > 50 and right / n > 0.93
    labels = spark.createDataFrame([(1, 1, 1), (3, 0, 1), (None, 1, 0), (4, None, 0), (3, 0, 0)], "doc_id long, toxic int, quality int")
    out = rows(toxicity.score(odd_docs, labels))
    assert len(out) == odd_docs.count() and all(0 <= r[2] <= 1 for r in out)
    assert toxicity.score(no_docs, labels).count() == 0
    assert {r[2] for r in rows(toxicity.score(odd_docs, labels.where("false")))} == {0.5}
