"""The operators' plain functions against brute force."""

import random

import numpy as np
import pyarrow as pa

from wardline.llm import extraction, lines, packing, quality, repeats, simhash, suffixes, toxicity
from wardline.llm.queries import tokenizer_path


def test_word_tokenizer_equals_the_tokenizer():
    from tokenizers import Tokenizer
    path = tokenizer_path()
    texts = ["", "  ", "Hello, world! it's <|endoftext|> a\x01b é É ÀÉ İ ΑΣ naïve 12ab ?!?! ...||  x　y\x1cz \x85 é ﬁ",
             "a\x00b don't", "𝒳 emoji 😀😀!! Ünïcödé ×÷ !? ;: |.", "Thonreing. thonreing, THONREING! ::: ;|"]
    ref = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    own = packing.WordTokenizer(path, cache_words=5)
    assert [x.tolist() for x in own.encode_all(texts)] == [r.ids for r in ref]
    assert own.encode(texts[2]).tolist() == ref[2].ids


def test_best_fit_decreasing_takes_the_tightest_window():
    rnd = random.Random(1)
    for _ in range(50):
        sizes = sorted((rnd.randint(1, 64) for _ in range(200)), reverse=True)
        at, off = packing.best_fit_decreasing(sizes, 64)
        rooms = []
        for n, w, o in zip(sizes, at.tolist(), off.tolist(), strict=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                assert rooms[w] == min(fits)
            else:
                assert w == len(rooms)
                rooms.append(64)
            assert o == 64 - rooms[w]
            rooms[w] -= n


def test_fingerprint_bit_by_bit():
    from xxhash import xxh64_intdigest
    text = "A b\tC d\n a b c D é É"
    ws = [w.lower() if w.isascii() else w for w in text.split()]
    hs = [xxh64_intdigest(" ".join(ws[i:i + 3]), 42) for i in range(len(ws) - 2)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(b"A b") == xxh64_intdigest("a b", 42)


def test_vantage_points_find_all_pairs():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for b in base for i, j in ((3, 3), (1, 60), (5, 6))]
    fps = np.unique(np.concatenate([base, np.array(near, dtype=np.uint64), rnd.integers(0, 1 << 63, 900, dtype=np.uint64)]))
    want = {(int(a), int(b)) for a in fps for b in fps[np.bitwise_count(fps ^ a) <= 2] if a < b}
    tree, leaves = simhash.number(simhash.grow(fps[::7], 8))
    got = set()
    homes = 0
    for _, home, guest in simhash.route(tree, fps, 2):
        homes += len(home)
        for a, b in simhash.pairs_between(fps[home], fps[np.concatenate([home, guest])], 2, leaf=16):
            got |= set(zip(a.tolist(), b.tolist(), strict=True))
    assert leaves > 4 and homes == len(fps) and got == want and len(want) > 100


def _distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def _edited(rnd, a, k):
    b = list(a)
    for _ in range(k):
        i, what = rnd.randint(0, len(b)), rnd.randint(0, 2)
        if what == 0:
            b.insert(i, rnd.choice("abc"))
        elif b and what == 1:
            b.pop(min(i, len(b) - 1))
        elif b:
            b[min(i, len(b) - 1)] = rnd.choice("abc")
    return "".join(b)


def test_banded_distance_and_segments():
    rnd = random.Random(3)
    for _ in range(4000):
        tau = rnd.choice([0, 1, 2, 3])
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 16)))
        b = _edited(rnd, a, rnd.randint(0, 4))
        assert lines.within(a, b, tau) == (_distance(a, b) <= tau)
        long, short = (a, b) if len(a) >= len(b) else (b, a)
        if len(short) > tau and _distance(a, b) <= tau:
            index = {(k, short[s:s + n]) for k, (s, n) in enumerate(lines.segments(len(short), tau))}
            probes = {(k, long[s:s + n]) for k, s, n in lines.windows(len(long), len(short), tau)}
            assert index & probes


def test_two_stage_suffix_order_and_prefixes():
    rnd = random.Random(4)
    for _ in range(200):
        parts = [bytes(rnd.choice(b"ab\x00") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 6))]
        text = (np.frombuffer(b"".join(p + b"\xff" for p in parts), dtype=np.uint8) + np.uint8(1)).astype(np.uint8)
        order = suffixes.suffix_order(text, 4)
        assert sorted(order.tolist()) == list(range(len(text)))
        cut = [bytes(text)[i:i + 4].split(b"\0")[0] for i in order.tolist()]
        assert cut == sorted(cut)
        full = [bytes(text)[i:i + 4].ljust(4, b"\0") for i in order.tolist()]
        for k, n in enumerate(suffixes.common_prefixes(text, order, 4).tolist()[1:], 1):
            same = next((j for j in range(4) if full[k][j] != full[k - 1][j]), 4)
            assert n == same


def test_selected_grams_cover_every_window():
    rnd = np.random.default_rng(5)
    h = repeats.mix(rnd.integers(0, 4, 3000).astype(np.uint64), np.ones(3000, dtype=np.uint64))
    ok = rnd.random(3000) < 0.9
    ends = np.array([0, 40, 90, 90, 1500, 1549, 3000])
    seen = np.zeros(3000, dtype=int)
    for first, count, at, _ in repeats.runs(h, ends, 50, 16, chunk=700, mask=ok):
        for f, c, a in zip(first.tolist(), count.tolist(), at.tolist(), strict=True):
            seen[f:f + c] += 1
            assert f + c - 1 <= a <= f + 50 - 16
    inside = np.array([i + 50 <= next(e for e in ends if e > i) for i in range(3000)])
    assert (seen == (ok & inside)).all()


def test_packed_parts_round_trip():
    n = 500
    rnd = np.random.default_rng(6)
    cols = [rnd.integers(-9, 9, n) * (1 << 40), rnd.integers(-(1 << 63), (1 << 63) - 1, 9)[rnd.integers(0, 9, n)], np.arange(n),
            rnd.integers(1, 36, n), rnd.integers(0, 49, n), rnd.integers(0, 1 << 63, n, dtype=np.uint64)]
    wide = repeats.unpack_part(repeats.pack_part(*cols, True), True)
    assert sorted(zip(*(c.tolist() for c in wide), strict=True)) == sorted(zip(*(c.tolist() for c in cols), strict=True))
    short = repeats.unpack_part(repeats.pack_part(*cols, False), False)
    want = [*cols[:5], cols[5] >> np.uint64(32)]
    assert sorted(zip(*(c.tolist() for c in short), strict=True)) == sorted(zip(*(c.tolist() for c in want), strict=True))


def test_repeat_words():
    rnd = random.Random(7)
    for _ in range(300):
        ws = [rnd.choice("ab") for _ in range(rnd.randint(0, 30))]
        grams = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
        want = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
        assert quality.repeat_words(ws) == len(want)


def test_measure_counts_code_points():
    m = quality.measure("é #b\n\né #b\nc$ ")
    assert m[:5] == (5, 8, 3, 1, 0) and len(m[5]) == 3 and m[5][0] == m[5][1] and m[6] == [2, 2, 1]


def test_chain_ratios_against_plain_recursion():
    rnd = np.random.default_rng(8)
    e, trans = rnd.normal(size=700), np.array([[0.0, 0.3], [-0.5, 0.8]])
    start = rnd.random(700) < 0.05
    start[0] = True
    p, _, _ = toxicity.forward_backward(e, start, trans)
    begins = [*np.flatnonzero(start).tolist(), 700]
    for a, b in zip(begins, begins[1:], strict=False):
        f = [np.array([1.0, np.exp(e[a])])]
        for t in range(a + 1, b):
            f.append((f[-1] @ np.exp(trans)) * [1.0, np.exp(e[t])])
        back = [np.ones(2)]
        for t in range(b - 1, a, -1):
            back.append(np.exp(trans) @ (back[-1] * [1.0, np.exp(e[t])]))
        want = [x * y for x, y in zip(f, back[::-1], strict=True)]
        assert np.allclose(p[a:b], [w[1] / w.sum() for w in want])


def test_field_learns_from_tagged_words():
    bad = {"idiot", "scum"}
    rnd = random.Random(9)
    seqs = [[rnd.choice(["the", "of", "and", "in", "idiot", "scum"]) for _ in range(20)] for _ in range(60)]
    feats = np.array([toxicity.features(w) for s in seqs for w in s])
    y = np.array([float(w in bad) for s in seqs for w in s])
    start = np.zeros(len(y), dtype=bool)
    start[::20] = True
    model = toxicity.Model(*toxicity.fit_field(feats, y, start), np.array([0.0, 1.0, 1.0]))
    (_, spans, top, expected), (_, none, low, _) = model.tag(["the  idiot scum of", "the of and"])
    assert spans == [{"start": 5, "end": 15}] and top > 0.9 and 1.8 < expected <= 2 and none == [] and low < 0.1


PAGES = [
    (None, ""), ("", ""),
    ("just text", "just text"),
    ("<nav><a href=x>menu</a></nav><article><h1>T &amp; t</h1><p><b>a<br><p>b &nbsp; c</p></article><footer>f</footer>", "T & t\n\na\n\nb c"),
    ("<body><div class='ad'>buy</div><main><p>one</p><aside>s</aside><form>f</form><div id=comments><p>c</p></div></main>", "one"),
    ("<div class='top-nav'><a>x</a></div><div><p>" + "long text here. " * 9 + "</p><p>short</p></div><script>var a='</p>'</script>",
     ("long text here. " * 9).strip() + "\n\nshort"),
    ("<article><p>x<style>p{}</style>y<![endif]><!-- c --></p><ul><li>i<li>j</ul><table><tr><td>k<td>l</table></article>",
     "xy\n\ni\n\nj\n\nk\n\nl"),
]


def test_main_text():
    for html, want in PAGES:
        assert extraction.main_text(html or "") == want, html


def test_deep_pages_do_not_recurse():
    assert extraction.main_text("<div>" * 5000 + "deep words" + "</div>" * 5000) == "deep words"


def test_density_search_inside_marked_elements():
    text = [f"Sentence number {i} of the text, which is long enough to count as prose." for i in range(8)]
    ps = "".join(f"<p>{t}</p>" for t in text)
    links = "<ul>" + "".join(f"<li><a href=x>another page {i}</a></li>" for i in range(6)) + "</ul>"
    assert extraction.main_text(f"<body><article><div>{ps}</div>{links}</article></body>") == "\n\n".join(text)
    halves = "".join(f"<article>{''.join(f'<p>{t}</p>' for t in part)}</article>" for part in (text[:5], text[5:]))
    assert extraction.main_text(f"<div>{links}{halves}</div><div><p>{'outside. ' * 40}</p></div>") == "\n\n".join(text)
    assert extraction.main_text(f"<main>Opening words.<br>More of them.<div>{ps}</div></main>").startswith("Opening words. More of them.\n\n")


def test_names_do_not_cut_the_content():
    text = [f"Sentence number {i} of the text, which is long enough to count as prose." for i in range(6)]
    ps, want = "".join(f"<p>{t}</p>" for t in text), "\n\n".join(text)
    for wrap in ("<div class='layout-with-sidebar'>{}</div>", "<div id='content-no-header'>{}</div>", "<div class='page hasComments'>{}</div>",
                 "<form action=x>{}</form>", "<div class='Widget'><div id=header>{}</div></div>", "<div role=form>{}</div>", "<header>{}</header>"):
        assert extraction.main_text(wrap.format(f"<article>{ps}</article>")) == want, wrap
        assert extraction.main_text(wrap.format(f"<div>{ps}</div>")) == want, wrap
        assert want in extraction.main_text("<div>" + wrap.format(f"<article>{ps}</article>") + f"<div>{ps}{ps}</div></div>"), wrap
    assert extraction.main_text(f"<article class='post comments-open'>{ps}</article>") == want
    beside = "<div class='box comments'><article><p>What a fine text this is, thank you.</p></article></div>"
    for more in (beside, "<form><p>Your name and your address, please.</p></form>", "<nav>Where you are now</nav>"):
        assert extraction.main_text(f"<main>{ps}{more}</main>") == want, more
    assert extraction.main_text(f"<div>{ps}</div>{beside}").startswith(want)


def test_toxicity_takes_texts_in_parts_of_bounded_size():
    texts = ["a"] * 1203 + ["x" * (3 * toxicity.PART_BYTES), "b", "é" * (toxicity.PART_BYTES // 2), "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    got = list(toxicity.parts(batch, 1))
    assert [t for _, part in got for t in part] == texts
    assert [at for at, _ in got] == [0, 500, 1000, 1203, 1204, 1205, 1206]
    assert list(toxicity.parts(batch.slice(0, 0), 1)) == []


def test_a_worker_forgets_the_words_of_a_task():
    tok = packing.WordTokenizer(tokenizer_path())
    once = [x.tolist() for x in tok.encode_all(["one two three", ""])]
    tok.forget()
    assert not tok.index and tok.used == 0
    assert [x.tolist() for x in tok.encode_all(["one two three", ""])] == once
