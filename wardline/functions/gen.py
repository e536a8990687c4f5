"""Deterministic dirt: expressions that turn clean values into messy text.

All choices derive from key arithmetic, never from ``rand``: a row's dirt is a
function of its own keys, so any partition of any run at any scale produces
the same bytes, and columns stay independent of each other (different
coprime multipliers per column).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col

CURRENCY = "₦"


def pick_by(values, selector) -> Column:
    """``values[pmod(selector, len(values))]`` (NULL allowed as a value)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (F.pmod(as_col(selector), F.lit(len(values))) + F.lit(1)).cast("int"))


def null_when(c, cond) -> Column:
    """Replace by NULL where ``cond`` holds."""
    return F.when(cond, F.lit(None)).otherwise(as_col(c))


def cents_to_decimal(cents, precision: int = 18) -> Column:
    """Integer cents -> exact ``decimal(precision,2)``."""
    return (as_col(cents).cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")).cast(
        f"decimal({precision},2)")


def money_text(cents) -> Column:
    """Integer cents -> ``₦-1,234.50`` (currency sign, thousands separators)."""
    c = as_col(cents).cast("long")
    size = F.abs(c)
    whole = F.call_function("div", size, F.lit(100).cast("long")).cast("string")
    return F.concat(F.when(c < 0, F.lit(CURRENCY + "-")).otherwise(F.lit(CURRENCY)),
                    F.regexp_replace(whole, r"(\d)(?=(\d{3})+$)", "$1,"), F.lit("."), F.lpad((size % 100).cast("string"), 2, "0"))


def whole_cents(c) -> Column:
    """An amount with two decimals, held as a double, in whole cents."""
    return F.rint(as_col(c) * 100).cast("long")


def ts_text(c) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd HH:mm:ss")


def date_text(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(as_col(c), fmt)


def plus_seconds(c, seconds) -> Column:
    """Timestamp + whole seconds (a day-time interval, no calendar ambiguity)."""
    return as_col(c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), as_col(seconds).cast("decimal(18,6)"))


def plus_days(c, days) -> Column:
    return as_col(c) + F.make_dt_interval(as_col(days).cast("int"))


# FIXED VALUES: date layouts that birth dates arrive in.
DATE_LAYOUTS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy-M-d", "d MMM yyyy", "dd-MM-yyyy", "yyyy/MM/dd", "dd.MM.yyyy",
                "MMMM d, yyyy")


def mixed_date_text(d, selector) -> Column:
    """Date text in one of ``DATE_LAYOUTS``, chosen by ``selector`` modulo their number."""
    texts = F.array(*[date_text(d, f) for f in DATE_LAYOUTS])
    return F.element_at(texts, (F.pmod(as_col(selector), F.lit(len(DATE_LAYOUTS))) + F.lit(1)).cast("int"))


def line_numbers(n) -> Column:
    """Generator column 1..n, for ``select(..., explode(line_numbers(n)))``."""
    return F.explode(F.sequence(F.lit(1), as_col(n).cast("int")))
