"""Tolerant scalar parsing of messy text columns, as Column expressions."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.lookup import list_literal

# --- fixed values: accepted date formats, tried in this order ---------------
ISO_OR_YEAR = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-M-d", "yyyy")
ISO_US_OR_YEAR = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-M-d", "M/d/yyyy", "yyyy")
US_THEN_ISO = ("M/d/yyyy", "M/d/yy", "yyyy-M-d")
ROSTER_DATE = ("M/d/yy", "M/d/yyyy", "yyyy-M-d", "yyyy_M_d")
LOCAL_MINUTE = ("yyyy-M-d H:m",)

_RANGE = r"^\s*(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)\s*$"
_NAME_DATE = r"(\d{4})[_-](\d{2})[_-](\d{2})"


def strip(c: Column) -> Column:
    """Trim blanks, tabs and line ends on both sides."""
    return F.btrim(c, F.lit(" \t\r\n\f"))


def blank_to_null(c: Column) -> Column:
    t = strip(c)
    return F.when(t != "", t)


def number(c: Column) -> Column:
    """Double, or NULL when the text is not a number."""
    return strip(c).try_cast("double")


def finite(c: Column) -> Column:
    """A number that is not NaN; used where a NaN would poison a comparison."""
    n = number(c)
    return F.when(~F.isnan(n), n)


def first_filled(*cols: Column) -> Column:
    """First non-blank value, trimmed; empty string when all are blank."""
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def coordinate(c: Column) -> Column:
    """Degrees, tolerating degree marks."""
    return finite(F.translate(c, "°º", ""))


def parse_date(c: Column, formats: Sequence[str]) -> Column:
    """First format that matches the whole text, else NULL."""
    t = strip(c)
    return F.coalesce(*[_parse_one(t, f) for f in formats])


# digits each part of a format may have
_DIGITS = {"yyyy": r"\d{4}", "yy": r"\d{2}", "M": r"\d{1,2}", "d": r"\d{1,2}", "H": r"\d{1,2}",
           "m": r"\d{1,2}", "HH": r"\d{2}", "mm": r"\d{2}", "ss": r"\d{2}", "MM": r"\d{2}", "dd": r"\d{2}"}


def _shape(fmt: str) -> str:
    """Regular expression of the texts a format can match."""
    parts = re.findall(r"yyyy|yy|[MdHms]{1,2}|'T'|.", fmt)
    return "^" + "".join("T" if p == "'T'" else _DIGITS.get(p, re.escape(p)) for p in parts) + "$"


def _parse_one(t: Column, fmt: str) -> Column:
    # the shape test keeps texts of other formats away from the parser, where each
    # one would cost an exception
    ts = F.when(t.rlike(_shape(fmt)), F.try_to_timestamp(t, F.lit(fmt)))
    if "yy" in fmt and "yyyy" not in fmt:  # two-digit years: 69-99 mean 1969-1999
        ts = F.when(F.year(ts) >= 2069, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)
    return ts


def date_in_name(name: Column) -> Column:
    """A ``YYYY_MM_DD`` or ``YYYY-MM-DD`` token anywhere in a file name."""
    token = F.concat_ws(
        "-", *[F.regexp_extract(name, _NAME_DATE, i) for i in (1, 2, 3)]
    )
    return F.try_to_timestamp(token, F.lit("yyyy-MM-dd"))


def date_token(name: Column) -> Column:
    """The date token of a file name respelled ``YYYY_MM_DD``, NULL when absent."""
    return F.when(
        name.rlike(_NAME_DATE),
        F.concat_ws("_", *[F.regexp_extract(name, _NAME_DATE, i) for i in (1, 2, 3)]),
    )


def local_to_utc(ts: Column, hours_behind: int) -> Column:
    """Fixed-offset local time to UTC."""
    return ts + F.expr(f"INTERVAL {int(hours_behind)} HOURS")


def depth_or_midpoint_cm(c: Column) -> Column:
    """A single depth, or the midpoint of an ``a-b`` range."""
    lo = F.regexp_extract(c, _RANGE, 1).try_cast("double")
    hi = F.regexp_extract(c, _RANGE, 2).try_cast("double")
    return F.when(c.rlike(_RANGE), (lo + hi) / 2.0).otherwise(number(c))


def interval_depth_m(top: Column, bottom: Column, single: Column) -> Column:
    """Depth in metres from centimetre columns: midpoint, else top, else single.

    A negative or unreadable entry counts as missing.
    """
    t, b, s = (F.when(number(c) >= 0, number(c)) for c in (top, bottom, single))
    return F.when(t.isNotNull() & b.isNotNull(), (t + b) / 2.0 / 100.0).otherwise(
        F.coalesce(t / 100.0, s / 100.0)
    )


def category_index(c: Column, categories: Sequence[str]) -> Column:
    """Zero-based position in the category list, -1 when unknown."""
    return F.coalesce(
        F.array_position(list_literal(categories), c) - 1, F.lit(-1)
    ).cast("double")


def slug(c: Column) -> Column:
    """Alphanumeric runs joined by single underscores, ``unknown`` when none."""
    # the ASCII class, not three ranges: Java tests a union of ranges slowly, and tasks of one JVM slow each other down
    joined = F.regexp_replace(F.coalesce(c, F.lit("")), r"\P{Alnum}+", "_")

    def bare(s):  # at most one underscore is left on each side
        first, last = s.startswith("_").cast("int"), s.endswith("_").cast("int")
        return F.when(s.isin("", "_"), F.lit("unknown")).otherwise(F.substr(s, first + 1, F.length(s) - first - last))

    return F.get(F.transform(F.array(joined), bare), 0)  # the text is searched once, however often it is named


def normal_header(c: Column) -> Column:
    return F.regexp_replace(F.lower(strip(c)), " ", "_")


def compact_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
