"""Repair of conversation structure by depth-first branch-and-bound.

A conversation is right when the initials of its roles read ``(s?(ua)+)?``. Its
rows, in order, can be kept, given another role, deleted, and empty rows can be
inserted; the cheapest such edits are looked for, and among equally cheap ones
those whose initials come first in ASCII.

What a search needs of a row is two letters (the role's initial and its
fault). They are gathered for blocks of ``BLOCK`` rows, so a conversation of any
length is many bounded tasks: a block is searched from each state that may be
open at its beginning to each one at its end, and one stream over the blocks'
results joins them. A search keeps an explicit stack of prefixes and cuts one
off when its cost and the lower bound of the rest pass the incumbent's, or when
a better prefix has come to the same node (row, state) before.

States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an
assistant row. 0 and 3 may end a conversation.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, rank_within, ship

BLOCK = 64
CACHE = 65_536  # searches remembered in a worker: blocks with the same letters have the same answer


class Costs(NamedTuple):
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}
FINE, BLANK, DUPLICATE, TRUNCATED = ".", "b", "d", "t"
NO_END = (("", 0, 0), ("", 0, 3), ("I", 1, 2), ("II", 2, 1))  # (edits, inserted rows, state) that end a conversation


@lru_cache(None)  # a few letters, states and prices
def options(initial: str, fault: str, state: int, costs: Costs) -> tuple[tuple[int, str, int], ...]:
    """(cost, edits, next state) of what can be done with a row, the dearest
    first. Empty rows are inserted before a row that stays, never before one that goes: after it
    they cost the same, and D comes before I. Two are enough: another two lead
    back to the same state."""
    out = [(costs.delete, "D", state)]
    if fault in (BLANK, DUPLICATE):
        return tuple(out)
    extra = costs.truncated if fault == TRUNCATED else 0
    for inserted in range(3):
        before = "I" * inserted
        cost = extra + inserted * costs.insert
        if (state, initial) in NEXT:
            out.append((cost, before + "K", NEXT[state, initial]))
        state = NEXT.get((state, "a")) or NEXT[state, "u"]
        out.append((cost + costs.rerole, before + "R", state))
    return tuple(sorted(out, reverse=True))


@lru_cache(None)
def least(initial: str, fault: str, costs: Costs) -> int:
    """What a row costs at least, whatever the state before it."""
    return min(c for s in range(4) for c, _, _ in options(initial, fault, s, costs))


@lru_cache(CACHE)
def search(letters: str, start: int, ends: tuple, costs: Costs = Costs()) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from state ``start`` through the rows
    to one of ``ends``, None where nothing does. ``letters`` has the initial and
    the fault of each row; an end is (edits, inserted rows, state)."""
    rows = [(letters[k], letters[k + 1]) for k in range(0, len(letters), 2)]
    n = len(rows)
    low = [0] * (n + 1)  # what the rows from here on cost at least, whatever the state
    for i in range(n - 1, -1, -1):
        low[i] = low[i + 1] + least(*rows[i], costs)
    finish = {state: (edits, k * costs.insert) for edits, k, state in ends}
    incumbent: tuple[int, str] | None = None
    best: dict[tuple[int, int], tuple[int, str]] = {}  # per node, the best prefix so far
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if incumbent is not None:
            bound = cost + low[i]
            if bound > incumbent[0] or (bound == incumbent[0] and audit > incumbent[1][: len(audit)]):
                continue
        known = best.get((i, state))
        if known is not None and known <= (cost, audit):
            continue
        best[i, state] = (cost, audit)
        if i == n:
            if state in finish:
                edits, more = finish[state]
                found = (cost + more, audit + edits)
                if incumbent is None or found < incumbent:
                    incumbent = found
            continue
        for c, e, s in options(*rows[i], state, costs):  # the cheapest is taken up next
            stack.append((i + 1, s, cost + c, audit + e))
    return incumbent


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def faults(messages: DataFrame, *order: str) -> DataFrame:
    """The rows of ``messages`` (conv_id, turn, role, text) with their place
    ``pos`` in the conversation and their first ``fault``: blank (no character
    but ASCII white space), duplicate (role and text of an earlier row),
    truncated (the last such character ends no sentence) or fine.

    Rows go by turn (NULL first), those of one turn by role and text, then by
    ``order``. NULL conv_ids are one conversation; a NULL role or text counts
    as one space. All other columns but ``order`` are left behind. An empty
    table gives no rows.
    """
    ship(messages.sparkSession)
    some = messages.select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), *order)
    some = some.withColumn("digest", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    ranked = rank_within(some, ["key"], ["turn", "role", "digest", *order], "pos")
    first = ranked.groupBy("key", "digest").agg(F.min("pos").alias("first"))
    last = F.right(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit(1))
    fault = (F.when(~F.col("text").rlike(WORD), BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
              .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE))
    initial = F.substring("role", 1, 1)
    return ranked.join(first, ["key", "digest"]).select(
        "key", "conv_id", "turn", "role", "text", "pos", fault.alias("fault"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"))


def _searched(rows: DataFrame, costs: Costs, block: int) -> DataFrame:
    """Per block of a conversation: its first and last initial, its illegal
    neighbours, and the best edits between all states."""
    letters = (rows.groupBy("key", F.floor(F.col("pos") / block).alias("block"))
                   .agg(F.sort_array(F.collect_list(F.struct("pos", F.concat("initial", "fault").alias("x")))).alias("rows"))
                   .select("key", "block", F.array_join(F.transform("rows", lambda r: r["x"]), "").alias("letters")))
    ends = [(("", 0, s),) for s in range(4)]

    def run(batches):
        for b in batches:
            found, pairs = [], []
            for number, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                table = []
                for s in range(4 if number else 1):
                    for e in range(4):
                        got = search(text, s, ends[e], costs)
                        if got:
                            table.append({"s": s, "e": e, "cost": got[0], "audit": got[1]})
                found.append(table)
                pairs.append(illegal_pairs(text[::2]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([t[0] for t in b.column(2).to_pylist()]),
                 pa.array([t[-2] for t in b.column(2).to_pylist()]), pa.array(pairs, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))],
                ["key", "block", "head", "tail", "pairs", "found"])

    return letters.mapInArrow(run, "key string, block long, head string, tail string, pairs long, "
                                   "found array<struct<s:int,e:int,cost:long,audit:string>>")


class _Path:
    """Joins the blocks of one conversation. Of each state only the best way to
    it is kept: for every block where it came from and the block's edits. Two
    ways of equal cost are told apart by the rank of what they share with the
    block before, then by this block's edits, so no long text is compared."""

    def __init__(self):
        self.open, self.back, self.pairs, self.tail = {0: (0, 0)}, [], 0, ""

    def add(self, head, tail, pairs, found):
        best = {}
        for f in found:
            if f["s"] in self.open:
                cost, rank = self.open[f["s"]]
                way = (cost + f["cost"], rank, f["audit"], f["s"])
                if f["e"] not in best or way < best[f["e"]]:
                    best[f["e"]] = way
        order = sorted(best, key=lambda e: best[e][1:])
        self.open = {e: (best[e][0], order.index(e)) for e in best}
        self.back.append({e: (w[3], w[2]) for e, w in best.items()})
        self.pairs += pairs + bool(self.tail and self.tail + head not in LEGAL)
        self.tail = tail

    def close(self, insert: int):
        """(cost, illegal pairs, [(state before, edits) of each block])"""
        cost, rank, edits, state = min((self.open[s][0] + k * insert, self.open[s][1], e, s)
                                       for e, k, s in NO_END if s in self.open)
        out = []
        for came in reversed(self.back):
            before, audit = came[state]
            out.append((before, audit))
            state = before
        out.reverse()
        out[-1] = (out[-1][0], out[-1][1] + edits)
        return cost, self.pairs, out


def solve(rows: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """Of rows from :func:`faults`, one row per block of a conversation: key,
    block, state (open before it) and audit (its edits); the first block also
    has the conversation's cost and number of illegal neighbours, else NULL."""

    def run(batches):
        key, path = None, None

        def closed():
            cost, pairs, parts = path.close(costs.insert)
            n = len(parts)
            for at in range(0, n, 10_000):
                some = parts[at:at + 10_000]
                first = [cost] if not at else [None]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(some)), pa.array(range(at, at + len(some)), pa.int64()),
                     pa.array([p[0] for p in some], pa.int32()), pa.array([p[1] for p in some]),
                     pa.array(first + [None] * (len(some) - 1), pa.int64()),
                     pa.array(([pairs] if not at else [None]) + [None] * (len(some) - 1), pa.int64())],
                    ["key", "block", "state", "audit", "cost", "illegal"])

        for b in batches:
            out = []
            for k, head, tail, pairs, found in zip(*[b.column(i).to_pylist() for i in (0, 2, 3, 4, 5)], strict=True):
                if path is None or k != key:
                    if path is not None:
                        out += closed()
                    key, path = k, _Path()
                path.add(head, tail, pairs, found)
            yield from out
        if path is not None:
            yield from closed()

    return (_searched(rows, costs, block).repartition("key").sortWithinPartitions("key", "block")
            .mapInArrow(run, "key string, block long, state int, audit string, cost long, illegal long"))


def repaired(rows: DataFrame, solved: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of the repaired conversations: key, block and place (order
    within the conversation), role, text, and edit (K, R or I). Each block of a
    conversation is worked on by itself. Deleted rows are left out."""
    edits = solved.select("key", "block", F.lit(-1).cast("long").alias("pos"), F.col("state").cast("string").alias("role"),
                          F.col("audit").alias("text"))
    both = rows.select("key", F.floor(F.col("pos") / block).alias("block"), "pos", "role", "text").unionByName(edits)
    names = {2: "user", 3: "assistant"}

    def run(batches):
        state, audit, at, place = 0, "", 0, 0
        for b in batches:
            out = []

            def insert(key, number):
                nonlocal state, at, place
                while at < len(audit) and audit[at] == "I":
                    state = NEXT.get((state, "a")) or NEXT[state, "u"]
                    out.append((key, number, place, names[state], "", "I"))
                    at, place = at + 1, place + 1

            for key, number, pos, role, text in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                if pos < 0:
                    state, audit, at, place = int(role), text, 0, 0
                    continue
                insert(key, number)
                edit, at = audit[at], at + 1
                if edit != "D":
                    if edit == "K":
                        state = NEXT[state, role[0]]
                    else:
                        state = NEXT.get((state, "a")) or NEXT[state, "u"]
                        role = names[state]
                    out.append((key, number, place, role, text, edit))
                    place += 1
                if audit[at:] == "I" * (len(audit) - at):
                    insert(key, number)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)],
                                                 ["key", "block", "place", "role", "text", "edit"])

    return (both.repartition("key", "block").sortWithinPartitions("key", "block", "pos")
                .mapInArrow(run, "key string, block long, place long, role string, text string, edit string"))


def hashes(fixed: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of repaired conversations: SHA-256 over their rows
    as ``role:text``, one a line. A hash goes over its input in order, so one
    task reads a conversation; it streams and holds one batch of rows."""

    def run(batches):
        key, h, out = None, None, []
        for b in batches:
            for k, role, text in zip(*[b.column(i).to_pylist() for i in (0, 3, 4)], strict=True):
                if h is None or k != key:
                    if h is not None:
                        out.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["key", "repaired_sha256"])
                out = []
        if h is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([h.hexdigest()])], ["key", "repaired_sha256"])

    return (fixed.repartition("key").sortWithinPartitions("key", "block", "place")
                 .mapInArrow(run, "key string, repaired_sha256 string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the crc32 of ``conv_id:turn`` modulo
    20 (a NULL counts as one space there, and as role or text): 0 drops a row,
    1 empties its text, 2 takes its ``.``, ``!`` and ``?`` away, 3 repeats it,
    4 makes its role user. ``copy`` numbers the repeats."""
    space = F.lit(" ")
    some = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), space).alias("role"),
                                F.coalesce(F.col("text").cast("string"), space).alias("text"))
    part = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space))) % 20
    hit = some.withColumn("hit", part).where("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return hit.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                      text.alias("text"), F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1)))
                                                    .otherwise(F.array(F.lit(0)))).alias("copy"))


def report(conversations: DataFrame, messages: DataFrame, costs: Costs = Costs(), block: int = BLOCK,
           order: tuple[str, ...] = ()) -> DataFrame:
    """Per conversation of ``conversations`` (its conv_id) what its rows in
    ``messages`` lack: conv_id, gaps (turns missing between the least and the
    largest, NULLs aside), blank, duplicate, truncated (rows by first fault),
    illegal (neighbours that cannot follow each other), cost and audit of the
    repair, repaired_sha256 of what it leaves.

    A conversation without messages has zeros, an empty audit and the hash of
    nothing. NULL conv_ids are one conversation. A role that does not begin with
    s, u or a, an empty one too, cannot be kept. Repeated rows are duplicates.
    An empty table gives no rows.
    """
    rows = faults(messages, *order).checkpoint()
    solved = solve(rows, costs, block).checkpoint()
    count = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    turns = rows.groupBy("key", "turn").agg(*[count(f) for f in (BLANK, DUPLICATE, TRUNCATED)])
    counts = turns.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        F.sum(BLANK).alias("blank"), F.sum(DUPLICATE).alias("duplicate"), F.sum(TRUNCATED).alias("truncated"))
    audits = solved.groupBy("key").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda p: p["audit"]), "").alias("audit"),
        F.max("cost").alias("cost"), F.max("illegal").alias("illegal"))
    every = conversations.select("conv_id").distinct().select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"))
    zero = F.lit(0).cast("long")
    return (every.join(counts, "key", "left").join(audits, "key", "left")
                 .join(hashes(repaired(rows, solved, block)), "key", "left")
                 .select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))
