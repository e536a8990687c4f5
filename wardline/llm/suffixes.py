"""Removal of repeated byte strings with suffix arrays.

1. ``repeats`` finds the places whose 50-byte windows may repeat: one 16-byte
   gram is selected in every window, and grams found in one document only are
   out. Nothing that repeats is lost.
2. What is left are snippets: the bytes of consecutive windows with the same
   selected gram. They are dealt by gram, so equal windows meet in one shard;
   equal snippets are one class with its smallest document, and a batch already
   settles those copies it sees itself.
3. In each shard the classes that share a gram are laid end to end and their
   suffixes sorted in two stages: those smaller than their successor directly,
   the others by scans over the buckets of their first bytes. Neighbours whose
   common prefix is 50 bytes long are the same string; the smallest document
   among them keeps it.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .substrings import merged

WINDOW = 50
GRAM = 16


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (uint8; 0 ends a string) in an order that is right
    for at least their first ``depth`` bytes, as far as these are in a string.

    A suffix is small if it is smaller than the next one. Small suffixes are
    sorted directly; in a bucket of equal first bytes they come after the
    others. The others follow from the order of their successors: a scan from
    the lowest bucket up puts the suffix before each one seen at the end of its
    own bucket so far.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    turns = np.flatnonzero(text[1:] != text[:-1])
    rises = np.concatenate([text[turns] < text[turns + 1], [False]])
    small = rises[np.searchsorted(turns, np.arange(n))]
    small |= text == 0
    padded = np.concatenate([text, np.zeros(depth, dtype=np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    own = np.flatnonzero(small & (text > 0))
    direct = own[np.argsort(np.ascontiguousarray(rows[own]).view(f"S{depth}").ravel(), kind="stable")]
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def scan(seen: np.ndarray) -> list[tuple[int, np.ndarray]]:
        before = seen[seen > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return []
        first = text[before]
        k = np.argsort(first, kind="stable")
        kinds, at = np.unique(first[k], return_index=True)
        return list(zip(kinds.tolist(), np.split(before[k], at[1:]), strict=True))

    ends = np.flatnonzero(text == 0)  # all alike: nothing is compared beyond an end
    for c in range(256):
        front = waiting[c]
        while front:
            seen = np.concatenate(front)
            out.append(seen)
            front = []
            for kind, found in scan(seen):
                (front if kind == c else waiting[kind]).append(found)
        seen = ends if c == 0 else direct[cuts[c]:cuts[c + 1]]
        if c == 0 and text[-1] != 0:  # the last suffix has no successor to follow from
            waiting[int(text[-1])].append(np.array([n - 1]))
        out.append(seen)
        for kind, found in scan(seen):
            waiting[kind].append(found)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the one
    before (0 for the first), counted up to ``depth``."""
    padded = np.concatenate([text, np.zeros(depth, dtype=np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    out = np.zeros(len(order), dtype=np.int64)
    for s in range(1, len(order), 1 << 16):
        differ = rows[order[s:s + (1 << 16)]] != rows[order[s - 1:s - 1 + (1 << 16)][: len(order[s:s + (1 << 16)])]]
        out[s:s + (1 << 16)] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def earliest(strings: list[tuple[bytes, int, int]], window: int) -> list[np.ndarray]:
    """For (bytes, windows, document) strings: the smallest document that has
    each of a string's windows."""
    text = np.frombuffer(b"".join(s + b"\xff" for s, _, _ in strings), dtype=np.uint8)
    text = (text + np.uint8(1)).astype(np.uint8)  # the mark, which no text has, becomes 0
    sizes = np.array([len(s) + 1 for s, _, _ in strings], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    counts = np.array([n for _, n, _ in strings], dtype=np.int64)
    start = np.arange(len(text)) - np.repeat(begin, sizes)
    is_window = start < np.repeat(counts, sizes)
    document = np.repeat(np.array([d for _, _, d in strings], dtype=np.int64), sizes)
    order = suffix_order(text, window)
    order = order[is_window[order]]
    group = np.flatnonzero(common_prefixes(text, order, window) < window)
    least = np.minimum.reduceat(document[order], group)
    first = np.empty(len(text), dtype=np.int64)
    first[order] = np.repeat(least, np.diff(np.concatenate([group, [len(order)]])))
    return [first[b:b + n] for b, n in zip(begin.tolist(), counts.tolist(), strict=True)]


def _selected(batches, window: int, gram: int, parts: int):
    """Rows (part, data) of the selected grams of texts (ord, rid, text)."""
    mixed = R.mix(np.arange(256, dtype=np.uint64), np.uint64(17) * np.ones(256, dtype=np.uint64))
    for whole in (part for b in batches for part in R.slices(b, R.BATCH)):
        out = []
        for b in R.slices(whole):
            order, rid = b.column(0).to_numpy(), b.column(1).to_numpy()
            raws = [t.encode("utf-8", "replace") for t in b.column(2).to_pylist()]
            sizes = [len(r) for r in raws]
            for part in R.groups_of(sizes, R.CHUNK):
                own = np.array(sizes[part], dtype=np.int64)
                if not own.sum():
                    continue
                flat = np.frombuffer(b"".join(raws[part]), dtype=np.uint8)
                ends = np.cumsum(own)
                begins = ends - own
                for first, count, at, key in R.runs(flat, ends, window, gram, table=mixed):
                    d = np.searchsorted(ends, first, side="right")
                    out.append((order[part][d], rid[part][d], first - begins[d], count, at - first, key))
        if out:
            yield R.deal(*(np.concatenate(x) for x in zip(*out, strict=True)), parts, False)
            del out
            R.let_go()


# What a batch of texts has for a shard. ``settled``: stretches (ord, rid,
# begin, length) that a smaller document of the batch has too. Else snippets
# (ord, rid, pos, windows, offset of the gram, bytes laid end to end).
SHARDS = "shard int, settled boolean, data binary"


def _packed(cols, blob: bytes = b"") -> bytes:
    import zstandard  # noqa: PLC0415
    body = b"".join(np.array(c, dtype="<i8").tobytes() for c in cols)
    return len(cols[0]).to_bytes(4, "little") + zstandard.ZstdCompressor(level=3).compress(body + blob)


def _unpacked(data: bytes, width: int) -> tuple:
    import zstandard  # noqa: PLC0415
    n, raw = int.from_bytes(data[:4], "little"), zstandard.ZstdDecompressor().decompress(data[4:])
    return [np.frombuffer(raw, "<i8", n, 8 * n * k) for k in range(width)], raw[8 * n * width:]


def _snippets(batches, window: int, gram: int, shards: int):
    """Rows (shard, settled, data) of texts (ord, rid, text, at)."""
    from xxhash import xxh3_64_intdigest  # noqa: PLC0415
    for b in (part for whole in batches for part in R.slices(whole, 2 * R.ROWS)):
        classes: dict[tuple, list] = {}
        for order, rid, text, at in zip(*(b.column(k).to_pylist() for k in range(3)), R.lists(b.column(3)), strict=True):
            raw = text.encode("utf-8", "replace")
            for pos, n, off in zip(*(x.tolist() for x in R.unpack_at(np.sort(at))), strict=True):
                classes.setdefault((off, raw[pos:pos + n + window - 1]), []).append((order, rid, pos, n))
        settled: dict[tuple, list] = {}
        homes: dict[int, list] = {}
        if any(b.column(1).to_pylist()):  # copies of one text have the same snippets
            classes = {k: list(dict.fromkeys(rows)) for k, rows in classes.items()}
        for (off, snippet), rows in classes.items():
            least = min(r[0] for r in rows)
            home = homes.setdefault(xxh3_64_intdigest(snippet[off:off + gram]) % shards, [])
            for order, rid, pos, n in rows:
                if order > least:
                    settled.setdefault((order, rid), []).append((pos, pos + n + window - 1))
                else:
                    home.append((order, rid, pos, n, off, snippet))
        out = []
        if settled:
            stretches = [(order, rid, s, e - s) for (order, rid), own in settled.items()
                         for s, e in merged(*np.array(own, dtype=np.int64).T)]
            data = _packed(list(zip(*stretches, strict=True)))
            out.append((zlib.crc32(data) % shards, True, data))  # nothing left to compare: any shard
        for home, rows in homes.items():
            if rows:
                rows.sort(key=lambda r: r[:3])
                *cols, snippets = zip(*rows, strict=True)
                out.append((home, False, _packed(cols, b"".join(snippets))))
        for k in range(0, len(out), 64):
            part = list(zip(*out[k:k + 64], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.bool_()),
                                              pa.array(part[2], pa.binary())], ["shard", "settled", "data"])
        del classes, settled, homes, out
        R.let_go()


STRETCHES = "ord long, rid long, at long"  # at: begin << 32 | length


def _settle(t: pa.Table, window: int, gram: int) -> pa.Table:
    """Stretches to remove of one shard."""
    out: list[tuple] = []
    classes: dict[tuple, list] = {}
    for settled, data in zip(t.column("settled").to_pylist(), t.column("data").to_pylist(), strict=True):
        if settled:
            cols, _ = _unpacked(data, 4)
            out += zip(*(c.tolist() for c in cols), strict=True)
            continue
        cols, snippets = _unpacked(data, 5)
        at = 0
        for order, rid, pos, n, off in zip(*(c.tolist() for c in cols), strict=True):
            classes.setdefault((off, snippets[at:at + n + window - 1]), []).append((order, rid, pos, n))
            at += n + window - 1
    by_gram: dict[bytes, list] = {}
    for key, rows in classes.items():
        by_gram.setdefault(key[1][key[0]:key[0] + gram], []).append((key[1], rows))
    strings, members = [], []
    for own in by_gram.values():
        for snippet, rows in own:
            least = min(r[0] for r in rows)
            first = []
            for order, rid, pos, n in rows:
                if order > least:
                    out.append((order, rid, pos, n + window - 1))
                else:
                    first.append((rid, pos))
            if len(own) > 1:
                strings.append((snippet, rows[0][3], least))
                members.append(first)
    if strings:
        found = earliest(strings, window)
        counts = np.array([len(d) for d in found], dtype=np.int64)
        leasts = np.array([s[2] for s in strings], dtype=np.int64)
        gone = np.flatnonzero(np.concatenate(found) < np.repeat(leasts, counts))
        of = np.repeat(np.arange(len(found)), counts)[gone]
        which, at = np.unique(of, return_index=True)
        start = (np.cumsum(counts) - counts)[which]
        last = np.concatenate([at[1:], [len(gone)]]) - 1 if len(which) else at
        # a snippet's windows all hold its gram, so those that go are one stretch
        for k, s, e in zip(which.tolist(), (gone[at] - start).tolist(), (gone[last] - start + window).tolist(), strict=True):
            out += [(strings[k][2], rid, pos + s, e - s) for rid, pos in members[k]]
    cols = [np.array(c, dtype=np.int64) for c in (zip(*out, strict=True) if out else [[], [], [], []])]
    del classes, by_gram, strings, members, out
    R.let_go()
    return pa.table({"ord": cols[0], "rid": cols[1], "at": cols[2] << 32 | cols[3]})


def find(docs: DataFrame, window: int, gram: int, parts: int) -> DataFrame:
    """(ord, rid, at) with at the stretches (begin << 32 | length) to remove."""
    dealt = docs.mapInArrow(lambda it: _selected(it, window, gram, parts), R.DEALT)
    places = R.per_document(R.shared(dealt, False))
    snippets = (docs.join(places, ["ord", "rid"]).select("ord", "rid", "text", "at")
                    .mapInArrow(lambda it: _snippets(it, window, gram, 2 * parts), SHARDS))
    return (snippets.groupBy("shard").applyInArrow(lambda t: _settle(t, window, gram), STRETCHES)
                    .groupBy("ord", "rid").agg(F.collect_set("at").alias("at")))


def remove(df: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_removed, spans (removed
    runs as byte offsets, end exclusive), kept (the bytes left) and kept_sha256.

    A byte is removed if a string of ``window`` bytes that covers it also
    starts in a document with a smaller doc_id. NULL texts are empty; shorter
    texts keep all. A NULL doc_id comes after all others; rows with one doc_id
    are never removed in favour of each other. An empty table gives no rows.
    """
    docs, doc_id = R.documents(df, id_col, text_col)
    gone = find(docs, window, gram, R.parts_for(docs))

    def run(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary(), pa.string()]
        for b in (part for whole in batches for part in R.slices(whole)):
            rows = []
            for doc, text, at in zip(*(b.column(k).to_pylist() for k in range(2)), R.lists(b.column(2)), strict=True):
                raw = text.encode("utf-8", "replace")
                begin = at >> 32
                spans = merged(begin, begin + (at & 0xFFFFFFFF)) if len(at) else []
                kept, upto = [], 0
                for s, e in spans:
                    kept.append(raw[upto:s])
                    upto = e
                kept = b"".join([*kept, raw[upto:]])
                rows.append((doc, len(raw), len(raw) - len(kept), [{"start": s, "end": e} for s, e in spans], kept,
                             hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])

    return (docs.join(gone, ["ord", "rid"], "left").select(doc_id, "text", "at")
                .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, "
                                 "kept binary, kept_sha256 string"))
