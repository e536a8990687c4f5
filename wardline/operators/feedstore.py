"""Feeds stored by time: polls that read the new end only, and digests per stretch.

A stored feed has a folder per stretch of time (``_from``, its first day; months
unless another unit is asked for, as a large feed may want days) and, in each
file, rows in order of ``_at``, the time in microseconds, and the tie key. A
poll prunes the stretches before its cursor by their folders and the rows of
the cursor's own stretch by the row groups' footers. ``_at`` is a plain integer
because parquet filters on zone-less timestamps are not pushed down by Spark.

The digest table of a feed has one row a stretch: how many rows, and two sums of
64-bit row hashes; stretches add up to years. An append-only check compares
years, then the stretches of years that differ, then the rows of stretches that
differ. What has not changed is neither read nor shuffled. Stretches are as many
as the calendar has, not as the data, so lists of them may come to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .feeds import read_since, removed_rows

FROM, AT = "_from", "_at"
UNITS = ("day", "month", "year")
EPOCH = _dt.datetime(1970, 1, 1)


def micros(ts) -> Column:
    """A zone-less time as microseconds since 1970 (sessions run in UTC)."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _micros(t: _dt.datetime) -> int:
    return (t.replace(tzinfo=None) - EPOCH) // _dt.timedelta(microseconds=1)


def first_day(t: _dt.date, unit: str) -> _dt.date:
    """The first day of the stretch that a day lies in."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    return t if unit == "day" else t.replace(day=1) if unit == "month" else t.replace(month=1, day=1)


def write_feed(df: DataFrame, path: str, ts: str, tie: str, unit: str = "month", row_group_bytes: int = 32 << 20,
               mode: str = "overwrite") -> None:
    """Store (``mode="append"``: add to) a feed. Rows of a stretch meet in one
    task, or several where it is large (REBALANCE), so files are few and sorted.
    Rows without a time are kept in a folder of their own and never polled."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    out = (df.withColumn(FROM, F.to_date(F.date_trunc(unit, ts))).withColumn(AT, micros(ts)).hint("rebalance", FROM)
             .sortWithinPartitions(FROM, AT, tie))
    out.write.mode(mode).partitionBy(FROM).option("parquet.block.size", row_group_bytes).parquet(path)


def open_feed(spark: SparkSession, path: str, columns) -> DataFrame:
    """A stored feed with its own columns (name -> type, or a StructType) and
    the two of the layout; an empty one too."""
    fields = columns.items() if isinstance(columns, dict) else [(f.name, f.dataType.simpleString()) for f in columns]
    ddl = ", ".join(f"`{n}` {t}" for n, t in fields)
    return spark.read.schema(f"{ddl}, {AT} bigint, {FROM} date").parquet(path)


def poll(feed: DataFrame, ts: str, tie: str, cursor=None, limit: int | None = None, until=None, digest: DataFrame | None = None,
         unit: str = "month") -> DataFrame:
    """:func:`wardline.operators.feeds.read_since` on a stored feed, without the
    columns of the layout. ``digest`` (see :func:`digests`) lets a page also end
    early: stretches behind the one by which ``limit`` rows are there are not read."""
    rows = feed.where(F.col(FROM).isNotNull())
    first = None
    if cursor is not None:
        first = first_day(cursor[0].date(), unit)
        rows = rows.where((F.col(FROM) >= F.lit(first)) & (F.col(AT) >= F.lit(_micros(cursor[0]))))
    if until is not None:
        rows = rows.where((F.col(FROM) <= F.lit(until.date())) & (F.col(AT) <= F.lit(_micros(until))))
    if limit is not None and digest is not None:
        after = digest.where(F.col("first").isNotNull())
        if first is not None:  # of the cursor's own stretch it is not known how much is left
            after = after.where(F.col("first") > F.lit(first))
        upto = after.withColumn("upto", F.sum("n").over(Window.orderBy("first")))
        last = upto.where(F.col("upto") >= limit).agg(F.min("first")).first()[0]
        if last is not None:
            rows = rows.where(F.col(FROM) <= F.lit(last))
    return read_since(rows, ts, tie, cursor, limit, until).drop(FROM, AT)


def digests(feed: DataFrame, columns) -> DataFrame:
    """(year, first, n, h1, h2) of a stored feed over ``columns``, one row a
    stretch (its first day): equal for equal multisets of rows. Partial
    aggregates: a stretch with most rows is combined before the shuffle. Rows
    without a time have a NULL stretch and year."""
    text = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    big = "decimal(38,0)"
    return feed.groupBy(F.col(FROM).alias("first")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(text).cast(big)).alias("h1"),
        F.sum(F.xxhash64(F.lit("#2"), text).cast(big)).alias("h2")).select(F.trunc("first", "year").alias("year"), "first", "n", "h1", "h2")


def _differing(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    def total(df, name):
        return df.groupBy(F.col(key).alias(f"_{name}")).agg(F.struct(F.sum("n"), F.sum("h1"), F.sum("h2")).alias(name))
    a, b = total(old, "a"), total(new, "b")
    j = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "left")  # what only the new one has took nothing away
    return j.where(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("_a").alias(key))


def differing(old: DataFrame, new: DataFrame) -> list:
    """Stretches of the ``old`` digests that the ``new`` ones show another
    content for; only years that differ are looked into."""
    years = _differing(old, new, "year")

    def within(df):
        return df.join(years.withColumnRenamed("year", "_y"), F.col("year").eqNullSafe(F.col("_y")), "left_semi")
    return [r["first"] for r in _differing(within(old), within(new), "first").collect()]


def of_stretches(feed: DataFrame, firsts: list) -> DataFrame:
    """The rows of some stretches; other folders are not read."""
    known = [d for d in firsts if d is not None]
    cond = F.col(FROM).isin(known) if known else F.lit(False)
    return feed.where(cond | F.col(FROM).isNull() if None in firsts else cond)


def removed_from_feed(old: DataFrame, new: DataFrame, columns, key: str | None = None, old_digest: DataFrame | None = None,
                      new_digest: DataFrame | None = None) -> DataFrame:
    """Rows (``columns``) of the stored feed ``old`` that ``new`` lacks; an
    append-only feed has none. Both must be stored by the same unit. With the
    digests of both at hand only stretches that differ are read; a row whose time
    moved to another stretch counts as removed."""
    a = digests(old, columns) if old_digest is None else old_digest
    b = digests(new, columns) if new_digest is None else new_digest
    firsts = differing(a, b)
    return removed_rows(of_stretches(old, firsts).select(*columns), of_stretches(new, firsts).select(*columns), key)
