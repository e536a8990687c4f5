"""Cleansing expressions (silver layer).

Every function takes and returns a ``Column`` built only from stock
``pyspark.sql.functions``, so all of it stays inside whole-stage codegen and
Catalyst can push filters through it. Only :func:`any_date` uses Python, as
Arrow batches, for the texts that no built-in layout fits.
"""

from __future__ import annotations

import datetime as _dt
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .._col import as_col

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def title_case(c) -> Column:
    """``initcap(trim(x))``: words split on spaces only (``SELF-PAY`` -> ``Self-pay``)."""
    return F.initcap(F.trim(as_col(c)))


def acronym_case(c, keep=("icu",)) -> Column:
    """Title case, except listed words (compared lower-case) which become upper case."""
    x = as_col(c)
    low = F.lower(F.trim(x))
    return F.when(low.isin(*keep), F.upper(F.trim(x))).otherwise(title_case(x))


def code(c, squeeze: bool = False) -> Column:
    """Upper-case code; ``squeeze`` also removes inner spaces (``W 003`` -> ``W003``)."""
    x = F.upper(F.trim(as_col(c)))
    if squeeze:
        x = F.regexp_replace(x, r"\s+", "")
    return x


def or_unknown(c, default: str = "Unknown") -> Column:
    """Title case with a default for NULL."""
    return F.coalesce(title_case(c), F.lit(default))


def gender(c) -> Column:
    """m/male -> Male, f/female -> Female, anything else (and NULL) -> Unknown."""
    g = F.lower(F.trim(as_col(c)))
    return (F.when(g.isin("m", "male"), F.lit("Male"))
             .when(g.isin("f", "female"), F.lit("Female"))
             .otherwise(F.lit("Unknown")))


def payer(c, self_pay: str = "Self-Pay") -> Column:
    """Classify free text: contains nhis -> NHIS, contains hmo -> HMO, else ``self_pay``.

    The same rule appears with three spellings of the fallback
    (``Self-Pay`` for patients, ``SELF_PAY`` for coverage type,
    ``SELF-PAY`` for the insurer code); pass the one wanted.
    """
    t = F.lower(F.trim(as_col(c)))
    return (F.when(t.contains("nhis"), F.lit("NHIS"))
             .when(t.contains("hmo"), F.lit("HMO"))
             .otherwise(F.lit(self_pay)))


def strip_title(c) -> Column:
    """Remove a leading doctor title (``Dr``, ``Dr.``, ``DR `` ...) then title case."""
    return title_case(F.regexp_replace(as_col(c), r"(?i)^dr[. ]+", ""))


def money(c, precision: int = 18, scale: int = 2) -> Column:
    """Parse money text such as ``₦-1,234.50``: keep ``[0-9.-]``, cast to decimal.

    ``try_cast`` returns NULL for text that is not a number (ANSI mode would
    otherwise fail the job).
    """
    kept = F.regexp_replace(as_col(c), r"[^0-9.-]", "")
    return kept.try_cast(f"decimal({precision},{scale})")


def ts(c, fmt: str = TS_FORMAT) -> Column:
    """Parse zone-less timestamp text into ``TIMESTAMP_NTZ``; NULL on bad text.

    The default format is checked by shape and cast straight to
    ``TIMESTAMP_NTZ``, so no session time zone is involved (no daylight-
    saving gaps). Other formats go through ``try_to_timestamp``.
    """
    x = as_col(c)
    if fmt == TS_FORMAT:
        shaped = x.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
        return F.when(shaped, x.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(x, F.lit(fmt)).cast("timestamp_ntz")


def date(c, fmt: str = DATE_FORMAT) -> Column:
    """Parse date text; NULL on bad text."""
    return F.try_to_date(as_col(c), fmt)


# FIXED VALUES: month names in dates.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

# Shapes of free-text dates; one of them at most fits a text.
YEAR_FIRST = r"^\d{4}([-/.])\d{1,2}\1\d{1,2}$"
DAY_FIRST = r"^\d{1,2}([-/.])\d{1,2}\1\d{4}$"
DAY_FIRST_SHORT = r"^\d{1,2}([-/.])\d{1,2}\1\d{2}$"
DAY_MONTH_NAME = r"^(\d{1,2}) ([A-Za-z]{3,9}) (\d{4})$"
MONTH_NAME_DAY = r"^([A-Za-z]{3,9}) (\d{1,2}),? (\d{4})$"


def _month_number(name) -> Column:
    """1..12 of a full or three-letter month name in any case, else 0."""
    low = F.lower(name)
    full = F.array_position(F.array(*map(F.lit, MONTHS)), low)
    short = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), low)
    return F.greatest(full, short)


def _plain_date_text(c, dayfirst_compat: bool) -> Column:
    """The date as ``year-month-day`` text; NULL where no shape fits."""
    x = F.trim(as_col(c))
    iso = F.translate(x, "/.", "--")
    if dayfirst_compat:
        month, day = (F.substring_index(F.substring_index(iso, "-", n), "-", -1).try_cast("int") for n in (2, 3))
        iso = F.when((month <= 12) & (day <= 12), F.regexp_replace(x, r"^(\d{4}).(\d{1,2}).(\d{1,2})$", "$1-$3-$2")).otherwise(iso)

    def named(shape, year, month, day):
        return F.concat_ws("-", F.regexp_extract(x, shape, year), _month_number(F.regexp_extract(x, shape, month)),
                           F.regexp_extract(x, shape, day))

    return (F.when(x.rlike(YEAR_FIRST), iso)
             .when(x.rlike(DAY_FIRST), F.regexp_replace(x, r"^(\d{1,2}).(\d{1,2}).(\d{4})$", "$3-$2-$1"))
             .when(x.rlike(DAY_FIRST_SHORT), F.regexp_replace(x, r"^(\d{1,2}).(\d{1,2}).(\d{2})$", "20$3-$2-$1"))
             .when(x.rlike(DAY_MONTH_NAME), named(DAY_MONTH_NAME, 3, 2, 1))
             .when(x.rlike(MONTH_NAME_DAY), named(MONTH_NAME_DAY, 3, 1, 2)))


def mixed_date(c, dayfirst_compat: bool = False) -> Column:
    """Parse date text that arrives in many layouts, day before month.

    The text's shape picks one layout and the text is parsed once: year first
    (``2001-3-4``), day first (``4/3/2001``, two-digit years are 20xx), with a
    month name (``4 Mar 2001``, ``March 4, 2001``), separated by ``-``, ``/`` or
    ``.``. Text of another shape and dates that do not exist are NULL; see
    :func:`any_date` and :func:`unparsed_date`.

    ``dayfirst_compat=True`` reproduces a day-first free-text parser: text
    that begins with the year and whose day is 12 or less has its month and
    day swapped (``2001-03-04`` -> 2001-04-03), other text parses as usual.
    """
    return F.try_to_date(_plain_date_text(c, dayfirst_compat), "yyyy-M-d")


def any_date(c, dayfirst_compat: bool = False) -> Column:
    """:func:`mixed_date`, and for text of none of its shapes a free-text parser:
    ordinals (``4th of March 2001``), weekday names, a time behind the date,
    and year and month alone (the first of the month). Text without a year and
    a month, and text that is no date, is NULL. Only what has no known shape is
    given to the parser, as Arrow batches; it costs at most one parse more."""
    x = F.trim(as_col(c))
    left = _plain_date_text(c, dayfirst_compat).isNull() & (x != "")
    return F.coalesce(mixed_date(c, dayfirst_compat), _free_text_date(dayfirst_compat)(F.when(left, x)))


def _free_text_date(dayfirst_compat: bool):
    @F.pandas_udf("date")
    def parse(texts: pd.Series) -> pd.Series:
        from dateutil import parser  # noqa: PLC0415

        def one(text):
            if text is None:
                return None
            day_first = dayfirst_compat or not text[:4].isdigit()
            try:  # what the text does not say comes from a default: two of them show what that is
                a = parser.parse(text, dayfirst=day_first, default=_dt.datetime(1904, 1, 1), fuzzy=False)
                b = parser.parse(text, dayfirst=day_first, default=_dt.datetime(1908, 3, 1), fuzzy=False)
            except (ValueError, OverflowError, TypeError):
                try:
                    text = re.sub(r"(?i)\b(of|the)\b", " ", text)
                    a = parser.parse(text, dayfirst=day_first, default=_dt.datetime(1904, 1, 1))
                    b = parser.parse(text, dayfirst=day_first, default=_dt.datetime(1908, 3, 1))
                except (ValueError, OverflowError, TypeError):
                    return None
            return a.date() if a.date() == b.date() else None
        return texts.map(one, na_action="ignore")
    return parse


def unparsed_date(c) -> Column:
    """True where there is text but :func:`mixed_date` finds no date in it."""
    x = F.trim(as_col(c))
    return x.isNotNull() & (x != "") & mixed_date(c).isNull()


def phone(c, country: str = "234") -> Column:
    """Keep ASCII digits, drop one leading country code, drop leading zeros, re-prefix.

    Empty result -> NULL. Only a *leading* country code goes:
    ``0234801`` -> ``+234234801``.
    """
    digits = F.regexp_replace(as_col(c), r"[^0-9]", "")
    core = F.regexp_replace(digits, rf"^({country})?0*", "")
    return F.concat(F.lit("+" + country), F.nullif(core, F.lit("")))


def length_of_stay(start, end) -> Column:
    """Calendar-day difference ``datediff(end, start)``; NULL while ``end`` is NULL."""
    return F.datediff(as_col(end), as_col(start))


def age_years(dob, as_of) -> Column:
    """Whole years between ``dob`` and ``as_of`` (a date or a date column)."""
    if isinstance(as_of, (_dt.date, str)):
        as_of = F.lit(as_of).cast("date")
    return F.floor(F.months_between(as_of, as_col(dob)) / F.lit(12)).cast("int")
