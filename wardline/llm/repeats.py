"""Finding what repeats across documents without moving the documents.

A text is a sequence of elements (bytes or word hashes). Of the grams in every
window of ``window`` elements one is selected: the one with the least hash, the
first of equals. Equal windows select equal grams, so a window can only repeat
if its selected gram does, and consecutive windows mostly share their
selection: about two grams in (window - gram + 2) positions travel instead of
all windows.

Selected grams are dealt by hash to parts, packed: one row per Arrow batch and
part. Before that, each batch looks for itself: what it already knows to
repeat is dealt at random and one copy of the gram is sent in its place, so a
gram that very many documents share is as many rows as there are batches, not
documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text

PART_BYTES = 4 << 20  # text bytes per part aimed at
CHUNK = 1 << 20  # elements worked on at a time
ROWS = 1000  # texts held as Python objects at a time
BATCH = 2500  # texts whose entries are sorted together
LAST = (1 << 63) - 1
ID_BUCKETS = 1 << 16
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_POS = np.uint64((1 << 24) - 1)
MARKER, SURE = 64, 128


def documents(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column]:
    """((ord, rid, text), doc_id): ord is what documents are ordered by, the
    largest long for NULL and the doc_id for others; doc_id gives it back. If a
    doc_id is that long itself, the ids above the largest unused number move
    down by one. rid tells rows of one doc_id apart: a hash of the text, or 0
    where the id has one row. Joins are by (ord, rid), so the texts are shuffled
    once for all of them, and rows that share an id are spread.

    Which ids have several rows is known by a table of ``ID_BUCKETS`` marks,
    whatever the input's size; a mark that an id shares with another only
    gives it a hash it does not need."""
    docs = id_text(df, id_col, text_col)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS)).cast("int")
    several = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(place.alias("p")).distinct().collect()
    rid = F.lit(0).cast("long")
    if several:
        marks = bytearray(ID_BUCKETS)
        for r in several:
            marks[r["p"]] = 1
        mark = F.substring(F.lit(marks), place + 1, F.lit(1))
        rid = F.when(mark == F.lit(bytearray(b"\x01")), F.xxhash64("text")).otherwise(rid)
    order, back = F.col("doc_id"), F.when(F.col("ord") != LAST, F.col("ord"))
    if docs.agg(F.max("doc_id")).first()[0] == LAST:
        ids = docs.select("doc_id").where("doc_id is not null").distinct()
        below = ids.where(F.col("doc_id") > -LAST - 1).select((F.col("doc_id") - 1).alias("v"))
        unused = below.join(ids.withColumnRenamed("doc_id", "v"), "v", "left_anti").agg(F.max("v")).first()[0]
        order = F.when(order > unused, order - 1).otherwise(order)
        back = F.when(F.col("ord") == LAST, None).when(F.col("ord") >= unused, F.col("ord") + 1).otherwise(F.col("ord"))
    return docs.select(F.coalesce(order, F.lit(LAST)).alias("ord"), rid.alias("rid"), "text"), back.alias("doc_id")


def parts_for(docs: DataFrame, of: int = PART_BYTES) -> int:
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(8, -(-total // of))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = (a * _K1 + b) * _K2
    return c ^ (c >> np.uint64(29))


def gram_hashes(h: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` elements, from those of half the length."""
    size = 1
    n = len(h)
    if n < gram:
        return np.zeros(0, dtype=np.uint64)
    while size * 2 <= gram:
        h = mix(h[:-size], h[size:])
        size *= 2
    if size < gram:
        h = mix(h[: n - gram + 1], h[gram - size: n - size + 1])
    return h


def selected(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each ``w`` consecutive hashes, first of equals."""
    v = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < w:
        n = len(h)
        v = np.minimum(v[: n - w + 1], v[w - size: n - size + 1])
    return (v & _POS).astype(np.int64)


def runs(h: np.ndarray, ends: np.ndarray, window: int, gram: int, chunk: int = CHUNK, mask=None, table=None):
    """Yields (begin, count, at, key) arrays: windows begin .. begin + count - 1
    select the gram at ``at``. ``h`` are the element hashes of texts laid end
    to end (or bytes that ``table`` gives the hashes of), ``ends`` where each
    text ends; a window stays in its text. ``mask``: the windows that count. A
    run is at most window - gram + 1 long; packed entries hold up to 255.

    Only ``chunk`` elements are expanded at a time, however long a text is."""
    if window - gram >= 255:
        raise ValueError("window - gram must be under 255")
    total = len(h) - window + 1
    for s in range(0, max(total, 0), chunk):
        part = h[s: min(s + chunk, total) + window - 1]
        sel_count = len(part) - window + 1
        at = np.arange(s, s + sel_count)
        ok = at + window <= ends[np.searchsorted(ends, at, side="right")]
        if mask is not None:
            ok &= mask[s: s + sel_count]
        where = np.flatnonzero(ok)
        if not len(where):
            continue
        g = gram_hashes(part if table is None else table[part], gram)
        sel = selected(g, window - gram + 1)
        new = np.ones(len(where), dtype=bool)
        new[1:] = (np.diff(where) > 1) | (np.diff(sel[where]) != 0)
        begin = np.flatnonzero(new)
        count = np.diff(np.concatenate([begin, [len(where)]]))
        first = where[begin]
        yield first + s, count, sel[first] + s, g[sel[first]]


# One packed row: what one batch has for one part. ``wide`` rows carry whole
# 64-bit keys, others 32 bits of the key: with the part, which grows in
# number with the input, enough to tell which grams may repeat.

def pack_part(order, rid, pos, n, off, key, wide: bool) -> bytes:
    """Entries sorted by document and position, as bytes."""
    import zstandard  # noqa: PLC0415
    k = np.lexsort((pos, rid, order) if rid.any() else (pos, order))
    order, rid, pos, n, off, key = order[k], rid[k], pos[k], n[k], off[k], key[k]
    steps = np.diff(order, prepend=np.int64(0))
    parts = [steps.astype("<i8").tobytes(), pos.astype("<u4").tobytes(), n.astype(np.uint8).tobytes(),
             off.astype(np.uint8).tobytes(), rid.astype("<i8").tobytes()]
    short = zstandard.ZstdCompressor(level=1).compress(b"".join(parts))
    keys = key.astype("<u8") if wide else (key >> np.uint64(32)).astype("<u4")
    return b"".join((np.array([len(k), len(short)], dtype="<u4").tobytes(), short, keys.tobytes()))


def unpack_part(data: bytes, wide: bool) -> tuple:
    import zstandard  # noqa: PLC0415
    count, size = np.frombuffer(data, "<u4", 2).tolist()
    raw = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    order = np.cumsum(np.frombuffer(raw, "<i8", count))
    pos = np.frombuffer(raw, "<u4", count, 8 * count).astype(np.int64)
    n = np.frombuffer(raw, np.uint8, count, 12 * count).astype(np.int64)
    off = np.frombuffer(raw, np.uint8, count, 13 * count).astype(np.int64)
    rid = np.frombuffer(raw, "<i8", count, 14 * count)
    key = np.frombuffer(data, "<u8" if wide else "<u4", count, 8 + size).astype(np.uint64)
    return order, rid, pos, n, off, key


def deal(order, rid, pos, n, off, key, parts: int, later: bool) -> pa.RecordBatch:
    """Entries of one batch as rows (part, data). ``later``: only entries with
    a smaller document under their key are asked for in the end, else all
    entries under a key of two documents."""
    if rid.any():  # rows that share an id may be copies of each other: one of them is enough
        k = np.lexsort((pos, rid, order, key))
        one = np.ones(len(k), dtype=bool)
        one[1:] = np.logical_or.reduce([x[k][1:] != x[k][:-1] for x in (pos, rid, order, key)])
        k = k[one]
    else:
        k = np.lexsort((order, key))
    order, rid, pos, n, off, key = order[k], rid[k], pos[k], n[k], off[k], key[k]
    new = np.ones(len(k), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    size = np.diff(np.concatenate([begin, [len(k)]]))
    least = order[begin]
    if later:
        sure = order > np.repeat(least, size)
    else:
        many = order[begin + size - 1] != least
        sure = np.repeat(many, size)
        mark = begin[many]
        order, rid, pos, n, key, sure = (np.concatenate([x, x[mark]]) for x in (order, rid, pos, n, key, sure))
        off = np.concatenate([off, np.full(len(mark), MARKER)])
        sure[len(k):] = False
    off = off | np.where(sure, SURE, 0)
    spread = mix(key ^ order.astype(np.uint64) ^ rid.astype(np.uint64), pos.astype(np.uint64))
    part = (np.where(sure, spread, mix(key, key)) >> np.uint64(11)) % np.uint64(parts)
    k = np.argsort(part, kind="stable")
    ids, first = np.unique(part[k], return_index=True)
    to = [*first[1:].tolist(), len(k)]
    data = [pack_part(*(x[k[a:b]] for x in (order, rid, pos, n, off, key)), later) for a, b in zip(first.tolist(), to, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(data, pa.binary())], ["part", "data"])


DEALT = "part int, data binary"


def shared(dealt: DataFrame, later: bool) -> DataFrame:
    """(ord, rid, at) of the entries that repeat: under a key that two documents
    have, packed as pos << 16 | n << 8 | off, or with ``later`` under one that
    a smaller document has, the position alone (single windows)."""

    def look(t: pa.Table) -> pa.Table:
        got = [unpack_part(x, later) for c in t.column("data").chunks for x in c.to_pylist()]
        order, rid, pos, n, off, key = (np.concatenate(x) for x in zip(*got, strict=True))
        sure, marker = (off & SURE) > 0, (off & MARKER) > 0
        loose = np.flatnonzero(~sure)
        k = loose[np.lexsort((order[loose], key[loose]))]
        keep = sure
        if len(k):
            new = np.ones(len(k), dtype=bool)
            new[1:] = key[k][1:] != key[k][:-1]
            begin = np.flatnonzero(new)
            size = np.diff(np.concatenate([begin, [len(k)]]))
            least = order[k][begin]
            if later:
                hit = order[k] > np.repeat(least, size)
            else:
                # a marker alone says that another batch has two documents
                two = (order[k][begin + size - 1] != least) | np.logical_or.reduceat(marker[k], begin)
                hit = np.repeat(two, size)
            keep = keep.copy()
            keep[k] = hit
        keep &= ~marker
        order, rid, pos = order[keep], rid[keep], pos[keep]
        at = pos if later else pos << 16 | n[keep] << 8 | (off[keep] & (MARKER - 1))
        if rid.any():  # copies of one text have the same entries
            k = np.lexsort((at, rid, order))
            one = np.ones(len(k), dtype=bool)
            one[1:] = np.logical_or.reduce([x[k][1:] != x[k][:-1] for x in (at, rid, order)])
            order, rid, at = (x[k][one] for x in (order, rid, at))
        out = pa.table({"ord": order, "rid": rid, "at": at})
        del got, order, rid, pos, n, off, key, keep, k, loose, at
        let_go()
        return out

    return dealt.groupBy("part").applyInArrow(look, "ord long, rid long, at long")


def per_document(found: DataFrame) -> DataFrame:
    """(ord, rid, at): each text's entries. ``shared`` gives an entry at most
    twice (from its key's part and from its own) however many rows are copies of
    the text, so the list is bounded by the text."""
    return found.groupBy("ord", "rid").agg(F.collect_list("at").alias("at"))


def unpack_at(at: np.ndarray) -> tuple:
    return at >> 16, (at >> 8) & 255, at & 255


def groups_of(sizes: list[int], most: int):
    """Slices of texts whose elements add up to about ``most`` (one text at least)."""
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def slices(b: pa.RecordBatch, rows: int = ROWS):
    """A batch in smaller ones, so that few texts are Python objects at once."""
    for at in range(0, b.num_rows, rows):
        yield b.slice(at, rows)


def let_go() -> None:
    """Give memory that a worker no longer uses back to the system; workers are
    reused and would keep it beside the next stage's."""
    import ctypes  # noqa: PLC0415
    import ctypes.util  # noqa: PLC0415
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lists(col) -> list[np.ndarray]:
    """A list<long> column as arrays (NULL: empty)."""
    return [np.array(x if x is not None else [], dtype=np.int64) for x in col.to_pylist()]
