"""Business keys, surrogate keys, date keys and stable buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col


def business_key(prefix: str, n, width: int) -> Column:
    """``prefix`` + number zero-padded to at least ``width`` digits (``PAT000001``).

    Pads but never truncates (plain ``lpad`` would cut longer numbers and
    make keys collide once the numbers outgrow the width). Intended for
    non-negative numbers.
    """
    s = as_col(n).cast("long").cast("string")
    return F.concat(F.lit(prefix), F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0")))


def key_number(bk, prefix_len: int) -> Column:
    """Numeric part of a business key (``PAT000123`` -> 123)."""
    return key_text(bk, prefix_len).try_cast("long")


def key_text(bk, prefix_len: int) -> Column:
    """All of a business key after its prefix."""
    c = as_col(bk)
    return F.substring(c, F.lit(prefix_len + 1), F.length(c))


def surrogate_key(*cols, null_if_null: bool = False) -> Column:
    """``xxhash64`` of the business key(s): deterministic and refresh-stable.

    ``xxhash64(NULL)`` is the seed (42), not NULL, so by default a NULL
    business key still yields a value that looks like a valid key.
    ``null_if_null=True`` returns NULL instead when any key part is NULL.
    """
    cs = [as_col(c) for c in cols]
    h = F.xxhash64(*cs)
    if not null_if_null:
        return h
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, h)


def date_key(c) -> Column:
    """``yyyyMMdd`` integer key of a date or timestamp."""
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


def stable_bucket(c, n: int) -> Column:
    """Bucket 0..n-1 from ``pmod(xxhash64(key), n)``: same key, same bucket, every run."""
    return F.pmod(F.xxhash64(as_col(c)), F.lit(n)).cast("int")


def pick_stable(values, c) -> Column:
    """Element of ``values`` chosen by ``stable_bucket`` of the key."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, stable_bucket(c, len(values)) + F.lit(1))


def md5_bucket(c, n: int) -> Column:
    """Portable stable bucket: the low 15 hex digits of ``md5(key)`` mod ``n``.

    Any SQL engine with ``md5`` computes the same bucket, which keeps the
    generated data checkable by an independent engine.
    """
    low = F.substring(F.md5(as_col(c).cast("string")), 18, 15)
    return F.pmod(F.conv(low, 16, 10).cast("long"), F.lit(n)).cast("int")
