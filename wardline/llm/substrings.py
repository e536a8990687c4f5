"""Substring dedup over words by level-wise doubling.

A window of 50 words that repeats across documents also repeats in each of its
halves. The first level therefore asks which 25-word windows repeat, one
selected in each 50-word window (see ``repeats``); only where they do is the
window extended to twice the length and asked again, and so on until the
length asked for is reached or nothing survives. The last level compares all
windows left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R

WINDOW = 50
LEVELS = 2  # lengths asked for: window / 2, window


def levels(window: int = WINDOW, count: int = LEVELS) -> list[int]:
    """The lengths of the levels: each twice the one before, at most ``window``."""
    out = [max(1, window >> (count - 1))]
    while out[-1] < window:
        out.append(min(window, 2 * out[-1]))
    return out


def word_hashes(ws: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest  # noqa: PLC0415
    return np.fromiter(map(xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))


def _entries(words_of, order, rid, masks, window: int, gram: int):
    """Entries (see ``repeats.deal``) of some texts, given as lists of words;
    ``masks`` are the windows that are still candidates (None: all)."""
    sizes = [len(w) for w in words_of]
    for part in R.groups_of(sizes, R.CHUNK):
        own = np.array(sizes[part], dtype=np.int64)
        if not own.sum():
            continue
        h = word_hashes([w for ws in words_of[part] for w in ws])
        ends = np.cumsum(own)
        begins, left = ends - own, None
        if masks is not None:
            left = np.zeros(len(h), dtype=bool)
            for b, spans in zip(begins.tolist(), masks[part], strict=True):
                pos, n, _ = R.unpack_at(spans)
                for p, k in zip(pos.tolist(), n.tolist(), strict=True):
                    left[b + p: b + p + k] = True
        for first, count, _, key in R.runs(h, ends, window, gram, mask=left):
            d = np.searchsorted(ends, first, side="right")
            pos = first - begins[d]
            yield order[part][d], rid[part][d], pos, count, np.zeros(len(pos), dtype=np.int64), key


def find(docs: DataFrame, window: int, parts: int) -> DataFrame:
    """(ord, rid, at) of the windows that a smaller document has too."""
    lengths = levels(window)
    at = None
    for gram in lengths:
        last = gram == window
        source = docs if at is None else docs.join(at, ["ord", "rid"])
        cols = ["ord", "rid", "text"] + ([] if at is None else ["at"])

        def run(batches, gram=gram, last=last, narrowed=at is not None):
            for whole in (part for b in batches for part in R.slices(b, R.BATCH)):
                out = []
                for b in R.slices(whole):
                    words_of = [t.encode("utf-8", "replace").split() for t in b.column(2).to_pylist()]
                    out += _entries(words_of, b.column(0).to_numpy(), b.column(1).to_numpy(),
                                    R.lists(b.column(3)) if narrowed else None, window, gram)
                if out:
                    yield R.deal(*(np.concatenate(x) for x in zip(*out, strict=True)), parts, last)
                    out = []
                    R.let_go()

        found = R.shared(source.select(*cols).mapInArrow(run, R.DEALT), last)
        at = R.per_document(found)
    return at


def remove(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (removed runs as
    word numbers, end exclusive), kept_text (words left, joined by one space)
    and kept_sha256 of it.

    A word is removed if a window of ``window`` words that covers it also
    starts in a document with a smaller doc_id. NULL and empty texts have no
    words. A NULL doc_id comes after all others; rows with one doc_id are never
    removed in favour of each other. An empty table gives no rows.
    """
    docs, doc_id = R.documents(df, id_col, text_col)
    gone = find(docs, window, R.parts_for(docs))

    def run(batches):
        for b in (part for whole in batches for part in R.slices(whole)):
            rows = []
            for doc, text, at in zip(*(b.column(k).to_pylist() for k in range(2)), R.lists(b.column(2)), strict=True):
                ws = text.encode("utf-8", "replace").split()
                starts = np.sort(at)
                spans = merged(starts, starts + window) if len(starts) else []
                kept, upto = [], 0
                for s, e in spans:
                    kept += ws[upto:s]
                    upto = e
                kept = b" ".join(kept + ws[upto:])
                rows.append((doc, len(ws), sum(e - s for s, e in spans), [{"start": s, "end": e} for s, e in spans],
                             kept.decode("utf-8"), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            types = [pa.int64(), pa.int64(), pa.int64(), span, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["doc_id", "n_words", "n_removed", "spans", "kept_text", "kept_sha256"])

    return (docs.join(gone, ["ord", "rid"], "left").select(doc_id, "text", "at")
                .mapInArrow(run, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, "
                                 "kept_text string, kept_sha256 string"))


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    k = np.argsort(begin, kind="stable")
    begin, end = begin[k], np.maximum.accumulate(end[k])
    new = np.ones(len(begin), dtype=bool)
    new[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(begin)]]) - 1
    return list(zip(begin[first].tolist(), end[last].tolist(), strict=True))
