"""SimHash near-duplicates, exact within a bit distance, by vantage-point trees.

Every document becomes one 64-bit fingerprint; equal fingerprints are one
class from then on. A tree of vantage points, grown on a bounded sample of the
classes, cuts the space of fingerprints into balls and shells: a class lives
in exactly one leaf, and is also sent as a query to every leaf that the
triangle bound cannot rule out (all that its ball of the asked radius may
reach). Each leaf is one task: it grows a tree of its own over its residents
and prunes the queries through the same bounds, so all pairs within the radius
are found, and none is missed. Components are then formed over the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored
from .components import connected_components

SHINGLE = 3
RADIUS = 2
SEED = 42
SAMPLE = 65_536  # classes that the top tree is grown on, at most
PER_LEAF = 16_384  # classes aimed at in a leaf


def fingerprint(raw: bytes, width: int = SHINGLE) -> int:
    """SimHash of a text's word shingles (A-Z lower-cased, repeats included):
    a bit is 1 if it is set in over half of the shingles' XXH64."""
    from xxhash import xxh64_intdigest  # noqa: PLC0415
    ws = raw.lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= width:
        return xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
    begin = np.cumsum(size + 1) - size - 1
    to = (begin + size)[width - 1:].tolist()
    n = len(to)
    begin = begin[:n].tolist()
    counts = np.zeros(64, dtype=np.int64)
    step = 1 << 16
    for k in range(0, n, step):
        h = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin[k:k + step], to[k:k + step], strict=True)),
                        dtype="<u8", count=min(step, n - k))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of documents with columns doc_id and text."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.encode("utf-8", "replace"), width) for t in b.column(1).to_pylist()], dtype="<u8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view("<i8"))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _far(a, b):
    return np.bitwise_count(a ^ b)


def grow(points: np.ndarray, leaf: int):
    """A vantage-point tree: ("leaf",) or (vantage, mu, inside, outside), where
    inside holds what is at most mu bits from the vantage point."""
    if len(points) <= leaf:
        return ("leaf",)
    for vantage in points[:: max(1, len(points) // 4)][:4]:
        d = _far(points, vantage)
        mu = int(np.median(d))
        near = d <= mu
        if near.all():
            mu -= 1
            near = d <= mu
        if near.any() and not near.all():
            return (vantage, mu, grow(points[near], leaf), grow(points[~near], leaf))
    return ("leaf",)


def number(tree, nxt=0):
    """The tree with its leaves numbered, and how many they are."""
    if tree[0] == "leaf":
        return ("leaf", nxt), nxt + 1
    left, nxt = number(tree[2], nxt)
    right, nxt = number(tree[3], nxt)
    return (tree[0], tree[1], left, right), nxt


def route(tree, fps: np.ndarray, radius: int):
    """Yields (leaf, residents, guests): positions in ``fps`` of what lives in
    a leaf, and of what else may have partners there."""

    def walk(node, home, guest):
        if not len(home) and not len(guest):
            return
        if node[0] == "leaf":
            yield node[1], home, guest
            return
        vantage, mu, inside, outside = node
        dh, dg = _far(fps[home], vantage).astype(np.int64), _far(fps[guest], vantage).astype(np.int64)
        near = dh <= mu
        yield from walk(inside, home[near], np.concatenate([home[~near & (dh <= mu + radius)], guest[dg <= mu + radius]]))
        yield from walk(outside, home[~near], np.concatenate([home[near & (dh > mu - radius)], guest[dg > mu - radius]]))

    yield from walk(tree, np.arange(len(fps)), np.zeros(0, dtype=np.int64))


def pairs_between(points: np.ndarray, queries: np.ndarray, radius: int, leaf: int = 64):
    """Yields arrays (a, b) of a point and a query within ``radius``, a < b."""
    stack = [(points, queries)]
    while stack:
        p, q = stack.pop()
        if not len(p) or not len(q):
            continue
        node = grow_once(p) if len(p) > leaf else None
        if node is None:
            for k in range(0, len(q), 1 << 14):
                part = q[k:k + (1 << 14)]
                for s in range(0, len(p), 256):
                    i, j = np.nonzero(_far(p[s:s + 256, None], part[None, :]) <= radius)
                    a, b = p[s + i], part[j]
                    keep = a < b
                    if keep.any():
                        yield a[keep], b[keep]
            continue
        vantage, mu, near = node
        d = _far(q, vantage).astype(np.int64)
        stack.append((p[near], q[d <= mu + radius]))
        stack.append((p[~near], q[d > mu - radius]))


def grow_once(points: np.ndarray):
    """One cut: (vantage, mu, which are inside), or None if nothing cuts them."""
    for vantage in points[:: max(1, len(points) // 4)][:4]:
        d = _far(points, vantage)
        mu = int(np.median(d))
        if (d <= mu).all():
            mu -= 1
        near = d <= mu
        if near.any() and not near.all():
            return vantage, mu, near
    return None


def links_within(classes: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, per_leaf: int = PER_LEAF) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints at most ``radius`` bits apart.
    ``classes`` has one long column fp without repeats."""
    n = classes.count()
    leaves = -(-max(1, n) // per_leaf)
    take = min(sample, 256 * leaves)
    rows = classes.orderBy(F.xxhash64("fp", F.lit(7))).limit(take).collect() if leaves > 1 else []
    points = np.array([r[0] for r in rows], dtype="<i8").view("<u8")
    tree, _ = number(grow(points, max(1, -(-len(points) // leaves))))

    def send(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
            for at, home, guest in route(tree, fps, radius):
                both = np.concatenate([home, guest])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(both), at, dtype=np.int32)), pa.array(fps[both].view("<i8")),
                     pa.array(np.arange(len(both)) < len(home))], ["leaf", "fp", "home"])

    def search(t: pa.Table) -> pa.Table:
        fps = t.column("fp").to_numpy().astype("<i8").view("<u8")
        home = t.column("home").to_numpy(zero_copy_only=False)
        order = np.argsort(fps, kind="stable")  # the same tree whatever the order of arrival
        fps, home = fps[order], home[order]
        found = list(pairs_between(fps[home], fps, radius))
        a = np.concatenate([x[0] for x in found]) if found else np.zeros(0, dtype="<u8")
        b = np.concatenate([x[1] for x in found]) if found else np.zeros(0, dtype="<u8")
        return pa.table({"a": a.view("<i8"), "b": b.view("<i8")})

    return (classes.mapInArrow(send, "leaf int, fp long, home boolean")
                   .groupBy("leaf").applyInArrow(search, "a long, b long"))


def near_duplicates(df: DataFrame, width: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (long) and component_id, the smallest
    doc_id that links of at most ``radius`` bits reach.

    NULL, empty and blank texts have fingerprint zero and are linked like any
    other; a NULL doc_id is a document that never gives its group's number
    (NULL if the group has no other). Repeated rows stay. An empty table gives
    no rows.
    """
    fps = stored(fingerprints(id_text(df, id_col, text_col), width), "fingerprints")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(links_within(first.select("fp"), radius))
    named = first.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("comp"))
    ids = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "comp").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` without the documents whose group has a smaller doc_id."""
    gone = groups.where("doc_id > component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
