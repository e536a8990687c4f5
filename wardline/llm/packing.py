"""Packing of tokenized documents into fixed windows, best fit decreasing.

Documents become token ids followed by an end id. A document longer than a
window is first cut into full windows, each a sequence of its own; what is
left over is packed, longest first, into the open window with the least room
that still holds it. The open window is found in a segment tree indexed by
remaining room: the tightest fit is the leftmost room >= the piece's length
that any open window has.

Tokenizing runs on Arrow batches. Pieces are dealt at random but repeatably to
shards of about ``shard_bytes`` of text, however long the documents are; each
shard is packed on its own by one task, so memory per task is bounded by the
shard, and the shard count grows with the input.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, id_text

WINDOW = 2048
END_ID = 1
SHARD_BYTES = 8 << 20  # text bytes a shard; an empty text counts as DOC_BYTES
DOC_BYTES = 64
CACHE_WORDS = 150_000


class WordTokenizer:
    """Token ids of whole texts by a tokenizer file whose words are encoded
    one by one (BPE with word ends, white space dropped).

    White space separates words for such a file, so ids are kept per word in a
    bounded cache. Plain words (Latin letters, then plain punctuation) are
    encoded in bulk from the same merges; any other word, and any file of
    another kind, goes through the tokenizer itself.
    """

    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    MARK = "\x01"

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer  # noqa: PLC0415
        self.tok = Tokenizer.from_file(path)
        self.cache_words = cache_words
        self.plain = re.compile(f"([{self.LETTERS}]*)([.,!?|;:]*)")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = self._per_word(spec)
        self.bulk = self._bulk(spec["model"]) if self.by_word else None
        self._reset()

    @staticmethod
    def _per_word(spec: dict) -> bool:
        m = spec["model"]
        return bool(m.get("type") == "BPE" and m.get("end_of_word_suffix") == "</w>"
                    and not m.get("dropout") and "ByteLevel" in json.dumps(spec.get("pre_tokenizer"))
                    and '"Removed"' in json.dumps(spec.get("pre_tokenizer"))
                    and "Lowercase" in json.dumps(spec.get("normalizer")))

    def _bulk(self, model: dict):
        """The merges as ranks over bytes, a word's end being one more byte."""
        import tiktoken  # noqa: PLC0415
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        end = self.MARK.encode()

        def raw(token: str) -> bytes:
            body = token.removesuffix("</w>")
            return bytes(byte[c] for c in body) + end * (body != token)

        vocab, ranks, ids = model["vocab"], {}, []
        of = {b: c for c, b in byte.items()}
        singles = [(bytes([b]), of[b]) for b in range(256)]
        ended = [(bytes([b]) + end, of[b] + "</w>") for b in range(256) if b != end[0]]
        merged = [(raw(a) + raw(b), a + b) for a, b in
                  (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        for key, token in [*singles, *ended, *merged]:
            if key not in ranks:
                ranks[key] = len(ids)
                ids.append(vocab.get(token, -1))
        self.ids = np.array(ids, dtype=np.uint32)
        self.ends = np.zeros(len(ids), dtype=bool)
        for key, r in ranks.items():
            self.ends[r] = len(key) > 1 and key.endswith(end)
        return tiktoken.Encoding("words", pat_str=f"[^{self.MARK}]+{self.MARK}", mergeable_ranks=ranks,
                                 special_tokens={})

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.starts = np.zeros(1 << 16, dtype=np.int64)
        self.sizes = np.zeros(1 << 16, dtype=np.int64)
        self.pool = np.zeros(1 << 18, dtype=np.uint32)
        self.used = 0

    def forget(self) -> None:
        """Give up the words of a task: the worker stays and does other steps,
        beside which they would lie in its memory."""
        self._reset()
        give_back()

    def _exact(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        """Put the ids of words not seen before into the cache."""
        plain, marked, bulk, odd = self.plain.fullmatch, self.MARK, [], []
        for k, w in enumerate(new):
            m = plain(w.decode("utf-8"))
            if m:
                bulk.append(f"{m[1].lower()}{marked}{m[2]}{marked}" if m[1] and m[2] else f"{m[0].lower()}{marked}")
            else:
                odd.append(k)
        is_odd = np.zeros(len(new), dtype=bool)
        is_odd[odd] = True
        parts = [self._exact(new[k].decode("utf-8")) for k in odd]
        lens = np.zeros(len(new), dtype=np.int64)
        lens[odd] = [len(p) for p in parts]
        if bulk:
            out = np.array(self.bulk._core_bpe.encode_ordinary("".join(bulk)), dtype=np.int64)
            to = np.cumsum([t.count(marked) for t in bulk])  # marks up to the end of each word
            ends = np.flatnonzero(self.ends[out])[to - 1] + 1
            lens[~is_odd] = np.diff(np.concatenate([[0], ends]))
            parts.insert(0, self.ids[out])
        at = np.empty(len(new), dtype=np.int64)  # the plain words come first in the pool
        for which, base in ((~is_odd, 0), (is_odd, int(lens[~is_odd].sum()))):
            at[which] = base + np.cumsum(lens[which]) - lens[which]
        n, total = len(self.index), int(lens.sum())
        while n + len(new) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.sizes[n:n + len(new)] = lens
        self.starts[n:n + len(new)] = self.used + at
        self.pool[self.used:self.used + total] = np.concatenate(parts)
        self.used += total
        self.index.update(zip(new, range(n, n + len(new)), strict=True))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, without special tokens, as uint32."""
        if not self.by_word:
            return [self._exact(t) for t in texts]
        per = [t.encode("utf-8", "replace").split() for t in texts]
        counts = np.array([len(w) for w in per], dtype=np.int64)
        ws = list(chain.from_iterable(per))
        if not ws:
            return [np.zeros(0, dtype=np.uint32) for _ in texts]
        if len(self.index) > self.cache_words:
            self._reset()
        get = self.index.get
        k = np.array([get(w, -1) for w in ws], dtype=np.int64)
        missing = np.flatnonzero(k < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys([ws[i] for i in missing])))
            k[missing] = [self.index[ws[i]] for i in missing]
        size, start = self.sizes[k], self.starts[k]
        to = np.cumsum(size)
        ids = self.pool[np.arange(to[-1]) + np.repeat(start - (to - size), size)]
        ends = np.concatenate([[0], to])[np.cumsum(counts)]
        return np.split(ids, ends[:-1])

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


class Rooms:
    """Open windows by remaining room, with a segment tree of their counts."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves < window + 1:
            self.leaves *= 2
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, room: int, by: int) -> None:
        k, tree = room + self.leaves, self.tree
        while k:
            tree[k] += by
            k >>= 1

    def put(self, room: int, window_id: int) -> None:
        self.open[room].append(window_id)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, taken out."""
        k, tree = need + self.leaves, self.tree
        if not tree[k]:
            while True:  # climb to the nearest subtree on the right that has a window
                if k == 1:
                    return None
                if not k & 1 and tree[k + 1]:
                    k += 1
                    break
                k >>= 1
            while k < self.leaves:
                k = 2 * k if tree[2 * k] else 2 * k + 1
        room = k - self.leaves
        self._count(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; ``lengths`` are 1 .. window and
    sorted from long to short."""
    rooms, used = Rooms(window), 0
    at, off = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i, n in enumerate(lengths):
        got = rooms.take(n)
        if got is None:
            room, w = window, used
            used += 1
        else:
            room, w = got
        at[i], off[i] = w, window - room
        if room > n:
            rooms.put(room - n, w)
    return at, off


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(name: str) -> WordTokenizer:
    """The tokenizer file that the driver sent along (``SparkContext.addFile``)."""
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = WordTokenizer(SparkFiles.get(name))
    return _TOKENIZERS[name]


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Each document's ids (with the end id) cut into pieces of at most
    ``window``; ``ids`` are little-endian unsigned 32-bit. Workers get the
    tokenizer file from the driver."""
    docs.sparkSession.sparkContext.addFile(tokenizer_path)
    name = os.path.basename(tokenizer_path)

    def documents(tok, b):
        for at in range(0, b.num_rows, 200):
            part = b.slice(at, 200)
            yield from zip(part.column(0).to_pylist(), tok.encode_all(part.column(1).to_pylist()), strict=True)

    def run(batches):
        tok = _tokenizer(name)
        tail = np.array([end_id], dtype=np.uint32)
        columns = ["doc_id", "start", "length", "doc_tokens", "ids"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, ids in documents(tok, b):
                ids = np.concatenate([ids, tail]).astype("<u4")
                n = len(ids)
                for s in range(0, n, window):
                    part = ids[s:s + window]
                    for col, v in zip(out, (doc, s, len(part), n, part.tobytes()), strict=True):
                        col.append(v)
                if len(out[0]) > 4000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], columns)
                    out = [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], columns)
        tok.forget()

    return docs.mapInArrow(run, PIECES)


def pack(df: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents packed: one row per piece with doc_id, start, length,
    doc_tokens, ids (bytes), sequence_id and offset (gapless from 0 in each
    sequence, at most ``window`` in all).

    A NULL or empty text is one piece with the end id alone. NULL and repeated
    doc_ids are documents like any other; equal pieces are interchangeable. An
    empty table gives no rows. Ties in length go by doc_id, start and ids.
    """
    docs = id_text(df, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text").cast("long") + DOC_BYTES)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    dealt = (pieces(docs, tokenizer_path, window, end_id)
             .withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", "ids"), F.lit(shards))))

    def fill(key, pdf):
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids"], ascending=[False, True, True, True],
                              kind="stable", na_position="first", ignore_index=True)
        at, off = best_fit_decreasing(pdf["length"].tolist(), window)
        return pdf.drop(columns="shard").assign(sequence_id=(int(key[0]) << 32) + at, offset=off)

    return dealt.groupBy("shard").applyInPandas(
        fill, PIECES + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed rows put together: sequence_id, doc_ids and the sequence's
    ids (bytes). A sequence has at most one window of ids, so groups are small."""
    return (packed.groupBy("sequence_id")
                  .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
                  .select("sequence_id", F.col("p.doc_id").alias("doc_ids"),
                          F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
