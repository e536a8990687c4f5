"""Spelling variants: words one edit apart, found with FM-indices.

A word that is one edit from another one still has one half unharmed. So every
word is looked up twice: its left half is matched exactly and the rest with one
error, then its right half exactly and what is before it with one error. The
vocabulary is a text of words between delimiters, indexed in both directions by
the ranks of its suffixes: a half is matched from its delimiter inwards, and
the interval of suffix ranks that is left is extended over the other half (the
index of the text goes leftwards, the one of the reversed text rightwards).

Words are dealt to shards by the halves they may be matched by, so that all
words that can be near a word by this half lie in its shard; a half that very
many words share is cut into pairs of blocks. A shard's searches go side by
side, as arrays of intervals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5              # a form occurs at least so many times as often
SHARD_CHARS = 400_000  # characters of a shard's words, about
HOT_HALF = 20_000      # words with one half beyond which they are cut into blocks
SIDE_BY_SIDE = 8_192   # searches at a time
PACK = 9               # letters of 7 bits in the first sort key


class FmIndex:
    """Suffix ranks of words between delimiters, for backward search.

    ``words`` are arrays of letters 1, 2, ... in ascending order; 0 delimits.
    The text is 0 w0 0 w1 ... 0. Equal suffixes (up to their delimiter) rank by
    word, so the first ranks are the delimiters in the order of the words that
    follow them, and a finished match is an interval of word numbers.
    """

    def __init__(self, words: list[np.ndarray]):
        n = len(words)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        text = np.zeros(int(sizes.sum()) + n + 1, dtype=np.int64)
        begin = np.cumsum(sizes + 1) - sizes
        number = np.repeat(np.arange(n), sizes)
        inner = np.arange(len(number)) + number + 1
        text[inner] = np.concatenate(words) if n else []
        word = np.full(len(text), n, dtype=np.int64)
        word[inner], word[begin - 1] = number, np.arange(n)
        left = np.zeros(len(text), dtype=np.int64)  # letters up to the next delimiter
        left[inner] = (begin + sizes)[number] - inner
        key = np.zeros(len(text), dtype=np.int64)
        padded = np.concatenate([text, np.zeros(PACK, dtype=np.int64)])
        for i in range(PACK):
            key = key << 7 | np.where(left > i, padded[i:i + len(text)], 0)
        rank = np.unique(key, return_inverse=True)[1]
        width = PACK
        while width < int(left.max(initial=0)):  # longer words: ranks of pairs of ranks, twice as far each time
            follow = np.zeros(len(text), dtype=np.int64)
            more = np.flatnonzero(left > width)
            follow[more] = rank[more + width] + 1
            rank = np.unique(rank * (len(text) + 2) + follow, return_inverse=True)[1]
            width *= 2
        order = np.argsort(rank * (n + 2) + word, kind="stable")
        self.n, self.size, self.letters = n, len(text), int(text.max(initial=0))
        self.before = text[order - 1]  # the letter before each suffix
        self.before[order == 0] = -1
        place = np.argsort(self.before, kind="stable")
        self.steps = self.before[place] * (self.size + 1) + place

    def extend(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with ``letter`` and go on as those
        of [low, high); for the delimiter, intervals of word numbers."""
        base = letter * (self.size + 1)
        end = letter == 0  # one delimiter, the last, is before no suffix
        return np.searchsorted(self.steps, base + low) - end, np.searchsorted(self.steps, base + high) - end

    def letters_before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval number, letter) of the letters that occur before the suffixes
        of the intervals; of wide intervals all letters, which may not occur."""
        wide = high - low
        few = np.flatnonzero(wide <= self.letters)
        many = np.flatnonzero(wide > self.letters)
        wide = wide[few]
        of = np.repeat(few, wide)
        at = np.arange(len(of)) - np.repeat(np.cumsum(wide) - wide, wide) + low[of]
        pairs = np.unique(of * 256 + self.before[at] + 1)
        of, letter = pairs // 256, pairs % 256 - 1
        real = letter > 0
        return (np.concatenate([of[real], np.repeat(many, self.letters)]),
                np.concatenate([letter[real], np.tile(np.arange(1, self.letters + 1), len(many))]))

    def one_error(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word) of the words that differ from a pattern by one letter
        inserted, deleted or replaced, other than in its ``exact`` last letters.
        Pattern q is flat[begin[q] : begin[q] + size[q]], read backwards."""
        q = np.arange(len(begin))
        low, high = np.zeros(len(q), dtype=np.int64), np.full(len(q), self.n + 1, dtype=np.int64)
        halves = []
        for j in range(int(exact.max(initial=0)) + 1):  # the half that matches exactly
            there = exact[q] == j
            halves.append((q[there], low[there], high[there]))
            q, low, high = q[~there], low[~there], high[~there]
            low, high = self.extend(flat[begin[q] + size[q] - 1 - j], low, high)
            some = high > low
            q, low, high = q[some], low[some], high[some]
        q, low, high = (np.concatenate(x) for x in zip(*halves, strict=True))
        at = exact[q]  # letters of the pattern that are used up
        bad = np.zeros(len(q), dtype=bool)
        found = [np.zeros(0, dtype=np.int64)]
        while len(q):
            ended = bad & (at == size[q])
            first, last = self.extend(np.zeros(int(ended.sum()), dtype=np.int64), low[ended], high[ended])
            wide = np.maximum(last - first, 0)
            word = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(first, wide)
            found.append(np.repeat(q[ended], wide) * (self.n + 1) + word)
            q, low, high, at, bad = (x[~ended] for x in (q, low, high, at, bad))
            more = at < size[q]
            a, b = self.extend(flat[begin[q[more]] + size[q[more]] - 1 - at[more]], low[more], high[more])
            new = [(q[more], a, b, at[more] + 1, bad[more])]  # the next letter matches
            skip = more & ~bad
            new.append((q[skip], low[skip], high[skip], at[skip] + 1, np.ones(int(skip.sum()), dtype=bool)))  # the word lacks it
            good = np.flatnonzero(~bad)
            of, letter = self.letters_before(low[good], high[good])
            of = good[of]
            a, b = self.extend(letter, low[of], high[of])
            yes = np.ones(len(of), dtype=bool)
            new.append((q[of], a, b, at[of], yes))  # the word has one more
            other = at[of] < size[q[of]]
            within = of[other]
            other[other] = flat[begin[q[within]] + size[q[within]] - 1 - at[within]] != letter[other]
            new.append((q[of[other]], a[other], b[other], at[of[other]] + 1, yes[other]))  # the word has another one
            q, low, high, at, bad = (np.concatenate(x) for x in zip(*new, strict=True))
            some = high > low
            q, low, high, at, bad = (x[some] for x in (q, low, high, at, bad))
        pairs = np.unique(np.concatenate(found))
        return pairs // (self.n + 1), pairs % (self.n + 1)


def near_pairs(words: list[str], left: list[str], right: list[str]) -> tuple[list[str], list[str]]:
    """Pairs (query, word of ``words``) one edit apart: of the queries ``left``
    by their left half, of ``right`` by their right half unless the left one
    is in the word as well. ``words`` are in ascending order."""
    alphabet = sorted(set().union(*words, *left, *right))
    code = {ord(c): k + 1 for k, c in enumerate(alphabet)}
    if len(alphabet) > 126:
        raise ValueError("more than 126 different letters")

    def coded(w: str) -> np.ndarray:
        return np.frombuffer(w.translate(code).encode("latin-1"), dtype=np.uint8).astype(np.int64)

    out_q, out_w = [], []
    for queries, backwards in ((left, True), (right, False)):
        if not queries or not words:
            continue
        turn = (lambda w: w[::-1]) if backwards else (lambda w: w)
        own = sorted(turn(w) for w in words)
        index = FmIndex([coded(w) for w in own])
        patterns = [coded(turn(w)) for w in queries]
        size = np.array([len(p) for p in patterns], dtype=np.int64)
        exact = size // 2 if backwards else size - size // 2
        flat, begin = np.concatenate(patterns), np.cumsum(size) - size
        for k in range(0, len(size), SIDE_BY_SIDE):
            part = slice(k, k + SIDE_BY_SIDE)
            q, w = index.one_error(flat, begin[part], size[part], exact[part])
            for a, b in zip(q.tolist(), w.tolist(), strict=True):
                query, word = queries[k + a], turn(own[b])
                if backwards or word[: len(query) // 2] != query[: len(query) // 2]:
                    out_q.append(query)
                    out_w.append(word)
    return out_q, out_w


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, slip=None) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text): runs of letters with A-Z
    lower-cased, of at least ``least_chars`` letters that occur at least
    ``least_count`` times. ``slip(doc_id, run)``, columns both, may change a run
    before it counts."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))).alias("run"))
    big = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = runs.select("doc_id", F.translate("run", big, big.lower()).alias("run"))
    words = runs.select((slip(F.col("doc_id"), F.col("run")) if slip else F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
                 .where(F.col("n") >= least_count))


def near_words(words: DataFrame, shard_chars: int = SHARD_CHARS, hot: int = HOT_HALF) -> DataFrame:
    """(word, n, n_near, best): of each word of ``words`` (word, n; words differ)
    how many others are one edit away, and (-n, word) of the most frequent of
    them (ties: the first by code point); zero and NULL where there is none."""
    size = F.char_length("word")
    total, least = words.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.min(size), F.lit(0))).first()
    shards = max(1, -(-4 * total // shard_chars))
    # the halves by which a word of this length, one more or one less finds it
    halves = F.array_distinct(F.array(*[F.floor((size + d) / 2).cast("int") for d in (-1, 0, 1)]))
    rest = F.array_distinct(F.array(*[F.ceil((size + d) / 2).cast("int") for d in (-1, 0, 1)]))
    left = words.select("word", "n", F.lit(True).alias("is_left"), F.explode(halves).alias("k"), F.floor(size / 2).alias("own"))
    right = words.select("word", "n", F.lit(False).alias("is_left"), F.explode(rest).alias("k"), F.ceil(size / 2).alias("own"))
    entries = left.where(F.col("k") >= least // 2).union(right.where(F.col("k") >= -(-least // 2))).withColumn("query", F.col("k") == F.col("own")).withColumn(
        "half", F.when(F.col("is_left"), F.expr("substring(word, 1, k)")).otherwise(F.expr("right(word, k)")))
    entries = entries.select("word", "n", "is_left", "query", "half")
    crowds = entries.groupBy("is_left", "half").agg(F.count("*").alias("crowd")).where(F.col("crowd") > hot)
    # a crowded half has a shard for every pair of a block of words and a block of queries
    dealt = (entries.join(crowds, ["is_left", "half"], "left")
                    .withColumn("nb", F.coalesce(F.ceil(F.col("crowd") / hot), F.lit(1)).cast("int"))
                    .withColumn("block", F.pmod(F.xxhash64("word"), F.col("nb")).cast("int")))
    home = F.pmod(F.xxhash64("is_left", "half"), F.lit(shards)).cast("string")
    both = F.sequence(F.lit(0), F.col("nb") - 1)
    spread = (dealt.withColumn("other", F.explode(both))
                   .withColumn("roles", F.when(F.col("nb") == 1, F.array(F.struct(home.alias("shard"), F.lit(True).alias("indexed"), F.col("query").alias("asks"))))
                               .otherwise(F.array(
                                   F.struct(F.concat_ws("|", F.col("is_left").cast("string"), "half", F.col("block").cast("string"), F.col("other").cast("string")).alias("shard"),
                                            F.lit(True).alias("indexed"), F.lit(False).alias("asks")),
                                   F.struct(F.concat_ws("|", F.col("is_left").cast("string"), "half", F.col("other").cast("string"), F.col("block").cast("string")).alias("shard"),
                                            F.lit(False).alias("indexed"), F.col("query").alias("asks")))))
                   .select("word", "n", "is_left", F.inline("roles")).where("indexed or asks"))

    def run(t: pa.Table) -> pa.Table:
        word, n = t.column("word").to_pylist(), t.column("n").to_pylist()
        is_left, indexed, asks = (t.column(c).to_pylist() for c in ("is_left", "indexed", "asks"))
        count = dict(zip(word, n, strict=True))
        own = sorted({w for w, i in zip(word, indexed, strict=True) if i})
        left = sorted({w for w, a, side in zip(word, asks, is_left, strict=True) if a and side})
        right = sorted({w for w, a, side in zip(word, asks, is_left, strict=True) if a and not side})
        best: dict[str, tuple] = {}
        number: dict[str, int] = {}
        for q, w in zip(*near_pairs(own, left, right), strict=True):
            number[q] = number.get(q, 0) + 1
            best[q] = min(best.get(q, (0, "")), (-count[w], w))
        qs = list(number)
        return pa.table({"word": pa.array(qs, pa.string()), "n_near": pa.array([number[q] for q in qs], pa.int64()),
                         "best_n": pa.array([best[q][0] for q in qs], pa.int64()), "best_word": pa.array([best[q][1] for q in qs], pa.string())})

    pairs = spread.groupBy("shard").applyInArrow(run, "word string, n_near long, best_n long, best_word string")
    found = pairs.select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct("best_n", "best_word").alias("best"))
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<best_n:bigint,best_word:string>").alias("best"))
    return found.union(alone).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by following forms to the last
    one. Every step is at least RATIO times as frequent, so there are no rings
    and few steps; each round doubles the steps taken."""
    cur = forms.select("word", F.col("form").alias("root"))
    while True:
        cur = cur.checkpoint()
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = cur.join(step, "root", "left")
        if joined.where("next is not null").isEmpty():
            return cur
        cur = joined.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = RATIO, shard_chars: int = SHARD_CHARS, hot: int = HOT_HALF) -> DataFrame:
    """Per word of ``words`` (word, n; each word once): word, form (its most
    frequent near word, where that occurs at least ``ratio`` times as often, else
    NULL), root (the end of the chain of forms, the word itself without one), n,
    n_near and form_n (the form's n or NULL). Ties of frequency go to the first
    by code point. An empty vocabulary gives no rows; words of two letters and
    more are handled, at any length."""
    near = near_words(words, shard_chars, hot)
    is_form = F.coalesce(-F.col("best.best_n") >= ratio * F.col("n"), F.lit(False))
    named = stored(near.select("word", "n", "n_near", F.when(is_form, F.col("best.best_word")).alias("form"),
                               F.when(is_form, -F.col("best.best_n")).alias("form_n")), "spelling")
    ends = roots(named.where("form is not null"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def slips(every: int = 199):
    """A change to runs: where ``every`` divides the crc32 of ``doc_id:run``, the
    letter at that crc32 modulo the run's length goes. A NULL doc_id is empty."""
    def slip(doc_id, run):
        h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
        at = (h % F.char_length(run)).cast("int")
        return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)
    return slip


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slip=None) -> DataFrame:
    """:func:`variants` of the whole texts of ``df``. A NULL or empty text has no
    words; rows that repeat count as often as they are there; other columns are
    left behind. An empty table gives no rows."""
    return variants(stored(vocabulary(id_text(df, id_col, text_col), slip=slip), "vocabulary"))
