"""Line dedup by a segment-partition edit-distance join.

Two lines within ``TAU`` edits share at least one of TAU + 1 segments of the
shorter line, near its own place. So each different line is indexed under its
segments (by length, segment number and content) and probes the indexes of its
own and the TAU shorter lengths with those substrings that an alignment within
TAU edits can put there. Lines that meet under a key are verified with a banded
bit-parallel edit distance.

Keys travel as 64-bit hashes; text follows only for lines that met another
one. Keys that many lines share are cut into pairs of blocks, so no task gets
an unbounded group, and each task reports a spanning set of links, not all
pairs. Lines linked directly or through others are one class; its first line
by (doc_id, line number) stays. Lines too short for two edits to mean a copy
(``MIN_CHARS``) are classes of equal lines: they need no keys, as a line's hash
is its class.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, id_text
from .components import connected_components

TAU = 2
MIN_CHARS = 48  # shorter lines must be equal
BLOCK = 256
SEEN = 200_000


def segments(n: int, tau: int = TAU) -> list[tuple[int, int]]:
    """(begin, length) of the tau + 1 even segments of a line of ``n`` characters."""
    size, more = divmod(n, tau + 1)
    out, at = [], 0
    for k in range(tau + 1):
        length = size + (k >= tau + 1 - more)
        out.append((at, length))
        at += length
    return out


def windows(n: int, shorter: int, tau: int = TAU) -> list[tuple[int, int, int]]:
    """(segment, begin, length) of the substrings with which a line of ``n``
    characters probes lines of ``shorter`` characters: segment k of them may
    have shifted by at most k edits seen from the left, and by at most tau - k
    seen from the right."""
    delta, out = n - shorter, []
    for k, (at, length) in enumerate(segments(shorter, tau)):
        low = max(at - k, at + delta - (tau - k), 0)
        high = min(at + k, at + delta + (tau - k), n - length)
        out += [(k, b, length) for b in range(low, high + 1)]
    return out


def common_start(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def within(a: str, b: str, tau: int = TAU) -> bool:
    """Whether the edit distance of ``a`` and ``b`` is at most ``tau``.

    The columns of the distance matrix are kept as bit vectors of vertical
    differences, of which only a band of 2 tau + 1 rows around the diagonal can
    matter; the band moves down one row with each column.
    """
    if abs(len(a) - len(b)) > tau:
        return False
    k = common_start(a, b)
    a, b = a[k:], b[k:]
    k = common_start(a[::-1], b[::-1])
    if k:
        a, b = a[:-k], b[:-k]
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) <= tau
    if tau == 0:
        return False
    width = 2 * tau + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + tau)
    # band row r of column j is matrix row j - tau + r; rows above 0 fall by one
    # each, so that every cell there is at least its distance from the diagonal
    up, down = full & ~((1 << (tau + 1)) - 1), (1 << (tau + 1)) - 1
    bottom, value = 1 << (width - 1), tau  # the matrix at the band's last row
    for j in range(1, n + 1):
        eq = (where.get(b[j - 1], 0) >> (j - 1)) & full
        # moved into this column's rows, the column before has its last row unknown: a step up
        vp, vn = (up >> 1) | bottom, (down >> 1)
        diag = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp, hn = vn | (full & ~(diag | vp)), diag & vp
        value += not diag & bottom
        up = full & (hn << 1 | ~(diag | hp << 1))
        down = diag & (hp << 1) & full
        if j % 4 == 0 and value > tau and _least(value, up, down, width) > tau:
            return False
    # from the band's last row back up to row m
    for r in range(width - 1, m - n + tau, -1):
        value += (down >> r & 1) - (up >> r & 1)
    return value <= tau


def _least(value: int, up: int, down: int, width: int) -> int:
    best = value
    for r in range(width - 1, 0, -1):
        value += (down >> r & 1) - (up >> r & 1)
        best = min(best, value)
    return best


def _copy(text: str):
    return F.xxhash64(F.col(text), F.length(text))


def all_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, line_no, line, size, line_id) of every line of ``docs``
    (split at line feeds); copy and line_id are 64-bit hashes of the text and
    of the line."""
    return (docs.select("doc_id", _copy("text").alias("copy"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
                .withColumn("size", F.char_length("line"))
                .withColumn("line_id", F.xxhash64("line", "size")))


def _entries(lines: DataFrame, tau: int) -> DataFrame:
    """(key, line_id, probe) of the index and probe substrings of lines. A task
    does a line that it meets again only once (``SEEN`` lines back); repeats
    that are left are harmless."""

    def run(batches):
        from xxhash import xxh3_64_intdigest  # noqa: PLC0415
        plans: dict[int, tuple] = {}
        seen: set[int] = set()

        def plan(n: int) -> tuple:
            if n not in plans:
                index = [(n, k, b, b + size) for k, (b, size) in enumerate(segments(n, tau))]
                probes = [(s, k, b, b + size) for s in range(max(1, n - tau), n + 1) for k, b, size in windows(n, s, tau)]
                both = index + probes
                plans[n] = ([(b, e, s * (tau + 1) + k) for s, k, b, e in both], len(index))
            return plans[n]

        for batch in batches:
            keys, ids, sizes, firsts = [], [], [], []
            for line_id, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if line_id in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(line_id)
                parts, n_index = plan(len(line))
                keys += [xxh3_64_intdigest(line[b:e], seed) for b, e, seed in parts]
                ids.append(line_id)
                sizes.append(len(parts))
                firsts.append(n_index)
            sizes = np.array(sizes, dtype=np.int64)
            begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
            probe = np.arange(len(begin)) - begin >= np.repeat(np.array(firsts, dtype=np.int64), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, dtype="<u8").view("<i8")),
                 pa.array(np.repeat(np.array(ids, dtype=np.int64), sizes)), pa.array(probe)], ["key", "line_id", "probe"])

    return lines.select("line_id", "line").mapInArrow(run, "key long, line_id long, probe boolean")


def _meeting(entries: DataFrame) -> DataFrame:
    """(key, line_id) of the keys under which an indexed line and another line
    meet. Keys are sorted within their tasks and read as a stream."""

    def run(batches):
        empty = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))
        held, sure = empty, False

        def settle(key, line, probe):
            """Which rows (sorted by key) are in a group of two lines and an index entry."""
            if not len(key):
                return np.zeros(0, dtype=bool)
            cut = np.flatnonzero(np.diff(key)) + 1
            begin = np.concatenate([[0], cut])
            size = np.diff(np.concatenate([begin, [len(key)]]))
            many = np.minimum.reduceat(line, begin) != np.maximum.reduceat(line, begin)
            indexed = ~np.logical_and.reduceat(probe, begin)
            return np.repeat(many & indexed, size)

        def rows(key, line):
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(line)], ["key", "line_id"])

        for b in batches:
            own = [b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False),
                   b.column(2).to_numpy(zero_copy_only=False)]
            key, line, probe = (np.concatenate(x) for x in zip(held, own, strict=True))
            if not len(key):
                continue
            last = np.searchsorted(key, key[-1])  # the last group may go on
            keep = settle(key[:last], line[:last], probe[:last])
            if sure and last:  # the group held back was known to count
                keep[: np.searchsorted(key, key[0], side="right")] = True
                sure = False
            if keep.any():
                yield rows(key[:last][keep], line[:last][keep])
            held = (key[last:], line[last:], probe[last:])
            if len(held[0]) > 50_000 and (sure or settle(*held).all()):
                yield rows(held[0][:-1], held[1][:-1])
                held, sure = tuple(x[-1:] for x in held), True
        keep = settle(*held) | sure
        if keep.any():
            yield rows(held[0][keep], held[1][keep])

    return (entries.repartition("key").sortWithinPartitions("key")
                   .mapInArrow(run, "key long, line_id long"))


def line_links(lines: DataFrame, tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between ids of different lines within ``tau`` edits, enough
    of them to join all that belong together. ``lines`` has line_id and line."""
    met = _meeting(_entries(lines, tau)).distinct().checkpoint()
    sizes = met.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    spread = (met.join(sizes, "key").withColumn("nb", F.ceil(F.col("n") / block).cast("int"))
                 .withColumn("own", F.pmod(F.xxhash64("line_id", F.lit(3)), F.col("nb")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                 .select("key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "line_id"))
    texts = (lines.join(met.select("line_id").distinct(), "line_id", "left_semi")
                  .groupBy("line_id").agg(F.first("line").alias("line")))
    groups = spread.join(texts, "line_id")

    def verify(t: pa.Table) -> pa.Table:
        b1, b2 = t.column("b1")[0].as_py(), t.column("b2")[0].as_py()
        rows = sorted(zip(t.column("line_id").to_pylist(), t.column("line").to_pylist(), t.column("own").to_pylist(), strict=True))
        root = list(range(len(rows)))

        def find(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        left = [i for i, r in enumerate(rows) if r[2] == b1]
        right = [i for i, r in enumerate(rows) if r[2] == b2]
        out_a, out_b = [], []
        for i in left:
            for j in right:
                if b1 == b2 and j <= i:
                    continue
                x, y = find(i), find(j)
                if x != y and within(rows[i][1], rows[j][1], tau):
                    root[x] = y
                    out_a.append(rows[i][0])
                    out_b.append(rows[j][0])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return groups.groupBy("key", "b1", "b2").applyInArrow(verify, "a long, b long")


def duplicate_lines(df: DataFrame, tau: int = TAU, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The lines to remove, one row each: doc_id, line_no, kept_doc_id and
    kept_line_no (the first line of its class), exact (the same text), and copy
    (the hash of the row's text, which tells rows of one doc_id apart).

    Lines of under ``min_chars`` characters are copies of equal lines only (no
    edits), and left alone if they are blank (ASCII white space or nothing). A
    NULL or empty text has one empty line. Lines repeated within a document count like any
    other. A NULL doc_id comes before all others; rows that repeat a doc_id are
    one document, whose equal lines at the same place are one line. An empty
    table gives no rows.
    """
    docs = id_text(df, id_col, text_col)
    every = all_lines(docs).where((F.col("size") >= min_chars) | F.col("line").rlike(WORD))
    long = every.where(F.col("size") >= min_chars)
    place = F.struct("doc_id", "line_no")
    classes = connected_components(line_links(long.select("line_id", "line"), tau))
    first = every.groupBy("line_id").agg(F.min(place).alias("first"))
    named = first.join(classes.withColumnRenamed("node", "line_id"), "line_id", "left").select(
        "line_id", F.coalesce("component", "line_id").alias("class"), F.col("first").alias("own"))
    kept = named.groupBy("class").agg(F.min("own").alias("kept"))
    named = named.join(kept, "class").select("line_id", "own", "kept")
    at = every.select("line_id", "doc_id", "copy", "line_no").join(named, "line_id")
    return (at.where(~place.eqNullSafe(F.col("kept")))
              .select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.col("kept.doc_id").alias("kept_doc_id"),
                      F.col("kept.line_no").cast("long").alias("kept_line_no"),
                      F.col("own").eqNullSafe(F.col("kept")).alias("exact"), "copy"))


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` (with columns doc_id and text) without the removed lines; n_chars,
    where there is one, follows the text. Rows that share a doc_id each lose
    their own lines. Documents that lose all their words are dropped; all others keep their rows and columns."""
    per_doc = (removed.groupBy(F.col("doc_id").alias("_gone"), F.col("copy").alias("_copy"))
                      .agg(F.collect_set(F.col("line_no").cast("int")).alias("_lines")))
    joined = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["_gone"]) & (_copy("text") == per_doc["_copy"]), "left")
    names = docs.columns
    at = names.index("text")
    count = names.index("n_chars") if "n_chars" in names else None
    types = joined.select(names).schema

    def run(batches):
        word = re.compile(WORD)
        for b in batches:
            cols = [b.column(i) for i in range(len(names))]
            texts, keep = cols[at].to_pylist(), []
            for i, gone in enumerate(b.column(b.schema.get_field_index("_lines")).to_pylist()):
                if gone:
                    gone = set(gone)
                    texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
                keep.append(not gone or word.search(texts[i]) is not None)
            cols[at] = pa.array(texts, cols[at].type)
            if count is not None:
                cols[count] = pa.array([n if not g else len(t) for n, g, t in zip(
                    cols[count].to_pylist(), b.column(b.schema.get_field_index("_lines")).to_pylist(), texts, strict=True)],
                    cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep, pa.bool_()))

    return joined.select(*names, "_lines").mapInArrow(run, types)
