"""Generated calendar relation (one row per day)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import date_key


def _date(x) -> Column:
    if isinstance(x, Column):
        return x.cast("date")
    if isinstance(x, (_dt.date, str)):
        return F.lit(str(x)).cast("date")
    raise TypeError(x)


def calendar_columns(d: Column) -> list[Column]:
    """The calendar attributes of date column ``d`` (ISO week numbers)."""
    return [
        date_key(d).alias("DATE_SK"),
        d.alias("DATE_VALUE"),
        F.year(d).alias("YEAR"),
        F.quarter(d).alias("QUARTER"),
        F.month(d).alias("MONTH"),
        F.date_format(d, "MMMM").alias("MONTH_NAME"),
        F.dayofmonth(d).alias("DAY_OF_MONTH"),
        F.date_format(d, "EEEE").alias("DAY_NAME"),
        F.weekofyear(d).alias("WEEK_OF_YEAR"),
        # dayofweek: 1 = Sunday ... 7 = Saturday (locale independent)
        F.dayofweek(d).isin(1, 7).alias("IS_WEEKEND"),
    ]


def days_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Explode each (start, end) row of ``bounds`` into one row per day ``d``."""
    return bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """Calendar dimension for ``start..end`` inclusive."""
    b = spark.range(1).select(_date(start).alias("start"), _date(end).alias("end"))
    return days_between(b).select(*calendar_columns(F.col("d")))


def dim_date_covering(df: DataFrame, *date_cols: str) -> DataFrame:
    """Calendar covering whole years from the earliest to the latest value of
    ``date_cols`` in ``df`` (one partial aggregate, then one generator row)."""
    lo = F.least(*[F.min(F.col(c).cast("date")) for c in date_cols])
    hi = F.greatest(*[F.max(F.col(c).cast("date")) for c in date_cols])
    b = df.agg(F.trunc(lo, "year").alias("start"),
               F.date_sub(F.add_months(F.trunc(hi, "year"), 12), 1).alias("end"))
    return days_between(b.where(F.col("start").isNotNull())).select(*calendar_columns(F.col("d")))
