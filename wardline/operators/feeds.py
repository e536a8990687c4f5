"""Feed semantics: cursor reads, append-only checks, tenant scoping, PII guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def after_cursor(ts_col: str, tie_col: str | None, cursor) -> Column:
    """Predicate "strictly after ``cursor``" in ``(ts, tie)`` order.

    With a tie column the cursor is a pair and rows with the cursor's time
    but a larger tie key are still delivered, so equal times split across
    two pages are neither lost nor repeated. Without one, the cursor is a
    time and the rule is the plain ``ts > cursor``.
    """
    ts = F.col(ts_col)
    if tie_col is None:
        c_ts = cursor[0] if isinstance(cursor, tuple) else cursor
        return ts > F.lit(c_ts)
    c_ts, c_key = cursor
    return (ts > F.lit(c_ts)) | ((ts == F.lit(c_ts)) & (F.col(tie_col) > F.lit(c_key)))


def read_since(df: DataFrame, ts_col: str, tie_col: str | None = None, cursor=None,
               limit: int | None = None, until=None) -> DataFrame:
    """Rows after ``cursor`` (all rows when ``cursor`` is None), oldest first.

    ``limit`` makes it a page: the first ``limit`` rows in ``(ts, tie)``
    order, planned as a top-k (each task keeps ``limit`` rows, one merge),
    so a page never needs a global sort of the feed. NULL times are never
    delivered (they cannot be placed after any cursor).

    ``until`` caps the times delivered (e.g. now minus a safety lag). Event
    times can lie in the future, and a cursor that jumps to such a time would
    skip rows that arrive later with earlier times; with ``until`` the cursor
    never passes the cap, and future rows wait for a later read.
    """
    rows = df.where(F.col(ts_col).isNotNull())
    if until is not None:
        rows = rows.where(F.col(ts_col) <= F.lit(until))
    if cursor is not None:
        rows = rows.where(after_cursor(ts_col, tie_col, cursor))
    order = [F.col(ts_col).asc()] + ([F.col(tie_col).asc()] if tie_col else [])
    if limit is not None:
        return rows.orderBy(*order).limit(limit)
    return rows


def next_cursor(page: DataFrame, ts_col: str, tie_col: str | None = None, previous=None):
    """Cursor to use for the next read: the largest ``(ts, tie)`` of ``page``.

    One small aggregate; returns ``previous`` when the page is empty.
    """
    if tie_col is None:
        v = page.agg(F.max(ts_col)).first()[0]
        return previous if v is None else v
    r = page.agg(F.max_by(F.struct(ts_col, tie_col), F.struct(ts_col, tie_col)).alias("m")).first()["m"]
    return previous if r is None else (r[0], r[1])


def removed_rows(old: DataFrame, new: DataFrame, key: str | None = None) -> DataFrame:
    """Rows of ``old`` missing from ``new`` (changed or gone).

    An append-only feed must return no rows here: published rows never
    change or disappear. With a unique ``key`` only ``(key, row digest)``
    pairs are shuffled (a left-anti join); without one, the multiset
    difference of whole rows (skew-safe ``exceptAll``).
    """
    from .incremental import multiset_minus, row_digest  # noqa: PLC0415
    cols = old.columns
    if key is None:
        return multiset_minus(old.select(*cols), new.select(*cols))
    o = old.select(*cols, row_digest(cols).alias("_d"))
    n = new.select(key, row_digest(cols).alias("_d"))
    return o.join(n, [key, "_d"], "left_anti").select(*cols)


def scope_to_tenant(df: DataFrame, col: str, value) -> DataFrame:
    """Only the caller's tenant. On a table partitioned by ``col`` this is a
    partition prune (``PartitionFilters`` in the plan): other tenants'
    files are never listed or read."""
    return df.where(F.col(col) == F.lit(value))


def scope_to_tenant_sql(df: DataFrame, col: str, value) -> DataFrame:
    """Same scoping written as SQL with a bound parameter: the caller's
    tenant arrives as a value (``:tenant``), never spliced into the text."""
    return df.sparkSession.sql(f"SELECT * FROM {{feed}} WHERE `{col}` = :tenant",
                               args={"tenant": value}, feed=df)


def forbid_columns(df: DataFrame, forbidden) -> DataFrame:
    """Raise if any forbidden column (case-insensitive) is exposed."""
    low = {c.lower() for c in df.columns}
    bad = [c for c in forbidden if c.lower() in low]
    if bad:
        raise ValueError(f"feed exposes forbidden columns: {bad}")
    return df
