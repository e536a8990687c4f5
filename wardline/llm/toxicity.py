"""Toxic spans by a linear-chain conditional random field over words.

Training takes a bounded sample of labelled documents (``MAX_DOCS``; the other
bounds below hold for what reaches the driver). Document counts on that sample
find the words and word beginnings that mark toxic documents; words of toxic
documents that carry such a mark are the labelled tokens. The field has a
weight for each hashed feature of a word and one for each pair of neighbouring
tags, and is fitted by its exact likelihood.

Scoring maps over Arrow batches: forward-backward gives each word's marginal,
spans of words over one half are the offsets, and the highest marginal and the
expected number of toxic words give the document's score through a logistic
curve fitted on the same sample. The model is a bounded broadcast; no text is
shuffled.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, give_back, id_text

MAX_DOCS = 8192  # labelled documents that the model learns from, at most
MAX_MARKS = 20_000  # words and beginnings that mark toxic documents, at most
MAX_SEGMENTS = 6000  # training segments with and without a labelled token, each at most
SEGMENT = 64
BITS = 18
FOLDS = 5
MARK_LOG_ODDS = 3.0
MARK_SHARE = 0.01
MARK_EVIDENCE = 10.0  # a mark by chance alone is no likelier than exp of minus this
CACHE_WORDS = 100_000
PART_ROWS, PART_BYTES = 500, 1 << 20  # documents tagged at once, and their text: a long one goes alone
PART_SEGMENTS = 2000  # segments that a task holds before it gives them on
STRIP = ".,!?;:\"'()[]|*-_#$%&@+=<>/"
FLOOR = 1e-9


def held_out(doc_id):
    """Whether a row is kept from learning: its doc_id's CRC-32 as text is
    divisible by five. A NULL doc_id is not held out and has no label."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0, F.lit(False))


def marks_of(word: str) -> list[str]:
    """What may mark a word: itself and how it begins."""
    w = word.lower().strip(STRIP)
    return [f"{w}$", w[:4], w[:5]] if w else []


def features(word: str) -> list[int]:
    w = word.lower().strip(STRIP)
    return [zlib.crc32(f.encode("utf-8", "replace")) & ((1 << BITS) - 1)
            for f in (f"{w}$", f"4{w[:4]}", f"5{w[:5]}", f"e{w[-3:]}")]


def scan(x: np.ndarray, start: np.ndarray, t: np.ndarray, lane: int = 128) -> np.ndarray:
    """Ratios r of a two-tag chain: r = x at a start, else
    x * (t01 + t11 r) / (t00 + t10 r) of the r before. The chain is cut into
    lanes that run side by side: first each lane's map as a 2x2 matrix, then
    the lanes' ends one after the other, then all lanes with known beginnings."""
    n = len(x)
    k = -(-n // lane)
    xs = np.ones(k * lane)
    xs[:n] = x
    ss = np.zeros(k * lane, dtype=bool)
    ss[:n] = start
    xs, ss = np.ascontiguousarray(xs.reshape(k, lane).T), np.ascontiguousarray(ss.reshape(k, lane).T)
    (t00, t01), (t10, t11) = t
    na, da, nb, db = np.ones(k), np.zeros(k), np.zeros(k), np.ones(k)
    for i in range(lane):
        xi, s = xs[i], ss[i]
        na, da = xi * (t11 * na + t01 * da), t10 * na + t00 * da
        nb, db = xi * (t11 * nb + t01 * db), t10 * nb + t00 * db
        if s.any():
            na, nb = np.where(s, xi, na), np.where(s, xi, nb)
            da, db = np.where(s, 1.0, da), np.where(s, 1.0, db)
        scale = 1.0 / (na + da + nb + db)
        na, da, nb, db = na * scale, da * scale, nb * scale, db * scale
    first = np.empty(k)
    r = 1.0
    for j, (a, b, c, d) in enumerate(zip(na.tolist(), nb.tolist(), da.tolist(), db.tolist(), strict=True)):
        first[j] = r
        r = (a * r + b) / (c * r + d)
    out = np.empty((lane, k))
    r = first
    for i in range(lane):
        r = xs[i] * (t01 + t11 * r) / (t00 + t10 * r)
        if ss[i].any():
            r = np.where(ss[i], xs[i], r)
        out[i] = r
    return out.T.reshape(-1)[:n]


def forward_backward(e: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple:
    """For scores ``e`` of tag 1 over tag 0 and the transitions' logs: the
    marginals of tag 1, the forward ratios and x times the backward ratios."""
    x, t = np.exp(np.clip(e, -30, 30)), np.exp(trans)
    r = scan(x, start, t)
    end = np.roll(start, -1)
    if len(end):
        end[-1] = True
    y = scan(x[::-1], end[::-1], t.T)[::-1]
    odds = r * (y / x)
    return odds / (1 + odds), r, y


class Model:
    """Weights of the field and of the document curve; picklable."""

    def __init__(self, weights, bias, trans, curve):
        self.weights, self.bias, self.trans, self.curve = weights, bias, trans, curve
        self.cache: dict[bytes, float] = {}

    def word_score(self, w: bytes) -> float:
        return float(self.weights[features(w.decode("utf-8", "replace"))].sum()) + self.bias

    def emissions(self, ws: list[bytes]) -> np.ndarray:
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        get = self.cache.get
        got = [get(w) for w in ws]
        if None in got:
            for w, v in zip(ws, got, strict=True):
                if v is None and w not in self.cache:
                    self.cache[w] = self.word_score(w)
            got = [self.cache[w] for w in ws]
        return np.array(got, dtype=np.float64)

    def aggregate(self, p: np.ndarray) -> tuple[float, float]:
        """What a document's marginals come to: the highest, and the expected
        number of words over one half."""
        if not len(p):
            return 0.0, 0.0
        return float(p.max()), float(p[p >= 0.5].sum())

    def score(self, top: float, expected: float) -> float:
        z = self.curve @ np.array(curve_inputs(top, expected))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    def tag(self, texts: list[str]) -> list[tuple]:
        """(score, spans, highest marginal, expected words) of whole texts."""
        per = [t.encode("utf-8", "replace").split() for t in texts]
        sizes = np.array([len(w) for w in per], dtype=np.int64)
        if sizes.sum():
            e = np.concatenate([self.emissions(w) for w in per])
            start = np.zeros(len(e), dtype=bool)
            begins = np.cumsum(sizes) - sizes
            start[begins[sizes > 0]] = True
            p, _, _ = forward_backward(e, start, self.trans)
        else:
            p = np.zeros(0)
        out, at = [], 0
        for text, n in zip(texts, sizes.tolist(), strict=True):
            own = p[at:at + n]
            at += n
            top, expected = self.aggregate(own)
            out.append((self.score(top, expected), spans_of(text, own >= 0.5) if top >= 0.5 else [], top, expected))
        return out


def parts(batch: pa.RecordBatch, column: int):
    """(first row, texts) of a batch in parts of bounded rows and bytes of text."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    at, room = 0, PART_BYTES
    for k, n in enumerate(sizes):
        if k > at and (k - at == PART_ROWS or n > room):
            yield at, batch.column(column).slice(at, k - at).to_pylist()
            at, room = k, PART_BYTES
        room -= n
    if sizes:
        yield at, batch.column(column).slice(at).to_pylist()


def curve_inputs(top: float, expected: float) -> list[float]:
    top = min(max(top, FLOOR), 1 - FLOOR)
    return [1.0, float(np.log(top / (1 - top))) / 4, float(np.log1p(expected))]


def spans_of(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words as code point offsets, end exclusive."""
    out, last = [], -2
    for k, m in enumerate(re.finditer(WORD, text)):
        if hit[k]:
            if last == k - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = k
    return out


def fit_field(feats: np.ndarray, y: np.ndarray, start: np.ndarray, rounds: int = 60) -> tuple:
    """Weights, bias and transitions that maximise the likelihood of the tags,
    by Adam on the exact gradient with a small L2 term."""
    size = 1 << BITS
    w = np.zeros(size + 1 + 3)  # weights, bias, transitions 01, 10, 11
    m, v = np.zeros_like(w), np.zeros_like(w)
    flat, n = feats.ravel(), len(y)
    inner = ~start[1:]
    seen = [float(((y[:-1] == a) & (y[1:] == b) & inner).sum()) for a, b in ((0, 1), (1, 0), (1, 1))]
    for k in range(1, rounds + 1):
        trans = np.array([[0.0, w[-3]], [w[-2], w[-1]]])
        e = w[:size][feats].sum(axis=1) + w[size]
        p, r, back = forward_backward(e, start, trans)
        d = p - y
        g = np.zeros_like(w)
        g[:size] = np.bincount(flat, weights=np.repeat(d, feats.shape[1]), minlength=size)
        g[size] = d.sum()
        a, b, t = r[:-1][inner], back[1:][inner], np.exp(trans)
        q = np.stack([t[0, 0] * np.ones_like(a), t[0, 1] * b, t[1, 0] * a, t[1, 1] * a * b])
        q /= q.sum(axis=0)
        g[-3:] = q[1:].sum(axis=1) - seen
        g = g / n + 1e-7 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.3 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-12) * (1 - (k - 1) / rounds)
    return w[:size].astype(np.float32), float(w[size]), np.array([[0.0, w[-3]], [w[-2], w[-1]]])


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with an L2 term."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (p - y) + 0.1 * w)
    return w


def learn(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_marks: int = MAX_MARKS,
          max_segments: int = MAX_SEGMENTS) -> Model:
    """A model from the labelled documents that are not held out.

    With repeated labels the highest counts; repeated texts count once. With
    no label, or labels of one kind, every score is that share of toxic rows
    (one half with no label at all).
    """
    spark = docs.sparkSession
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                   .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
                   .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = [(int(r[0]), int(r[1])) for r in picked.collect()]
    share = sum(t for _, t in rows) / len(rows) if rows else 0.5
    flat = Model(np.zeros(1 << BITS, dtype=np.float32), -20.0, np.zeros((2, 2)),
                 np.array([np.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0]))
    if share in (0.0, 1.0) or not rows:
        return flat
    chosen = F.broadcast(spark.createDataFrame(rows, "doc_id long, toxic int"))
    sample = (docs.join(chosen, "doc_id").groupBy(F.xxhash64("text", F.length("text")).alias("copy"))
                  .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
                  .select("copy", "text", "toxic").checkpoint())
    tox, all_ = sample.agg(F.sum("toxic"), F.count("*")).first()
    if not tox or tox == all_:
        return flat
    word = F.lower(F.col("word"))
    bare = F.regexp_replace(word, r"^[\Q" + STRIP + r"\E]+|[\Q" + STRIP + r"\E]+$", "")
    each = (sample.select("copy", "toxic", F.explode(F.array_distinct(F.split("text", SPACE, -1))).alias("word"))
                  .select("copy", "toxic", bare.alias("w")).where("w <> ''")
                  .select("copy", "toxic", F.explode(F.array(F.concat("w", F.lit("$")), F.substring("w", 1, 4),
                                                             F.substring("w", 1, 5))).alias("mark")).distinct()
                  .groupBy("mark").agg(F.sum("toxic").alias("n1"), F.count("*").alias("n")))
    least = max(MARK_SHARE * tox, MARK_EVIDENCE / -np.log(tox / all_))
    odds = (F.log((F.col("n1") + 0.5) / (tox + 1)) - F.log((F.col("n") - F.col("n1") + 0.5) / (all_ - tox + 1)))
    marks = (each.where(F.col("n1") >= least).where(odds >= MARK_LOG_ODDS)
                 .orderBy(F.desc("n1"), "mark").limit(max_marks))
    lexicon = frozenset(r[0] for r in marks.collect())
    if not lexicon:
        return flat

    def cut(batches):
        names = ["copy", "at", "feats", "tags", "hit"]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

        out: list[list] = [[] for _ in names]
        for b in batches:
            rows = ((b.column(0)[at + i].as_py(), text, b.column(2)[at + i].as_py())
                    for at, texts in parts(b, 1) for i, text in enumerate(texts))
            for copy, text, toxic in rows:
                ws = re.findall(WORD, text)
                tags = [int(bool(toxic) and any(x in lexicon for x in marks_of(w))) for w in ws]
                for s in range(0, len(ws), SEGMENT):
                    own = tags[s:s + SEGMENT]
                    feats = np.array([f for w in ws[s:s + SEGMENT] for f in features(w)], dtype="<i4")
                    vals = (copy, s, feats.tobytes(), bytes(own), any(own))
                    for col, val in zip(out, vals, strict=True):
                        col.append(val)
                    if len(out[0]) == PART_SEGMENTS:
                        yield batch()
                        out = [[] for _ in names]
        yield batch()
        give_back()

    segments = sample.mapInArrow(cut, "copy long, at long, feats binary, tags binary, hit boolean")
    rows = []
    for hit in (True, False):
        part = segments.where(F.col("hit") if hit else ~F.col("hit"))
        rows += part.orderBy(F.xxhash64("copy", "at"), "copy", "at").limit(max_segments).select("feats", "tags").collect()
    if not rows:
        return flat
    per = len(features("a"))
    feats = np.frombuffer(b"".join(r[0] for r in rows), dtype="<i4").reshape(-1, per)
    y = np.frombuffer(b"".join(r[1] for r in rows), dtype=np.int8).astype(np.float64)
    sizes = np.array([len(r[1]) for r in rows])
    del rows
    start = np.zeros(len(y), dtype=bool)
    start[np.cumsum(sizes) - sizes] = True
    model = Model(*fit_field(feats, y, start), np.zeros(3))
    got = tagged(sample.select(F.col("copy").alias("doc_id"), "text"), model).select("doc_id", "top", "expected")
    truth = got.join(sample.select(F.col("copy").alias("doc_id"), "toxic"), "doc_id").orderBy("doc_id").collect()
    x = np.array([curve_inputs(r["top"], r["expected"]) for r in truth])
    model.curve = fit_curve(x, np.array([float(r["toxic"]) for r in truth]))
    model.cache = {}
    return model


def tagged(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, spans (code point offsets), top and expected of each row
    of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        field = shared.value
        for b in batches:
            for at, texts in parts(b, 1):
                got = field.tag(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], span),
                     pa.array([g[2] for g in got], pa.float64()), pa.array([g[3] for g in got], pa.float64())],
                    ["doc_id", "score", "spans", "top", "expected"])
        field.cache = {}  # workers are used again: what one task has learnt would stay beside the next step's memory
        give_back()

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, spans array<struct<start:long,end:long>>, top double, expected double")


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and spans.

    NULL and empty texts have no words and the score of a document with no
    toxic word; repeated rows are scored alike; an empty table gives no rows.
    The score reads the text alone.
    """
    docs = id_text(df, id_col, text_col)
    return tagged(docs, learn(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "spans")
