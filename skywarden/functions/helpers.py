"""Small report-side helpers (B29-B36) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


# ------------------------------------------------------------------ B29 dates

def fmt(ts) -> Column:
    return F.date_format(_c(ts), TIME_FMT)


def zero_of_day(ts) -> Column:
    """``yyyy-MM-dd 00:00:00`` of the timestamp's day."""
    return F.date_format(_c(ts), "yyyy-MM-dd 00:00:00")


def plus_minutes(ts, minutes: int) -> Column:
    return _c(ts) + F.make_interval(mins=F.lit(int(minutes)))


def plus_hours(ts, hours: int) -> Column:
    return _c(ts) + F.make_interval(hours=F.lit(int(hours)))


def yesterday(ts) -> Column:
    """Previous calendar day as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(F.to_date(_c(ts)), 1), "yyyy-MM-dd")


def millis_between(a, b) -> Column:
    """``b - a`` in milliseconds."""
    return F.timestamp_diff("MILLISECOND", _c(a), _c(b))


def days_between(a, b) -> Column:
    """Whole calendar days from ``a`` to ``b``."""
    return F.datediff(F.to_date(_c(b)), F.to_date(_c(a)))


# ----------------------------------------------------------- B30-B36 shaping

def cpu_percent(sys_frac, user_frac) -> Column:
    """(system + user) * 100, two decimals, half-even like the
    reference's decimal format."""
    return F.bround((_c(sys_frac) + _c(user_frac)) * 100, 2)


# Byte divisors of the memory ("M") and disk ("G") texts;
# the disk one is 10^7, not 10^9, as in the reference.
MEMORY_DIVISOR = 1000 * 1000
DISK_DIVISOR = 1000 * 10000


def memory_text(used, total) -> Column:
    """``<used>M/<total>M`` with whole megabytes."""
    return F.concat((_c(used) / MEMORY_DIVISOR).cast("long").cast("string"), F.lit("M/"),
                    (_c(total) / MEMORY_DIVISOR).cast("long").cast("string"), F.lit("M"))


def disk_text(used, total) -> Column:
    """``<used>G/<total>G`` in the reference's 'G' units."""
    return F.concat((_c(used) / DISK_DIVISOR).cast("long").cast("string"), F.lit("G/"),
                    (_c(total) / DISK_DIVISOR).cast("long").cast("string"), F.lit("G"))


def speed_text(v) -> Column:
    """Three decimals, ties to even, NULL -> ``"0"``."""
    return F.coalesce(F.format_string("%.3f", F.bround(_c(v).cast("double"), 3)), F.lit("0"))


def route_label(dep, arr) -> Column:
    """``dep-arr``."""
    return F.concat_ws("-", _c(dep), _c(arr))


def is_blank(s) -> Column:
    """NULL, empty, only blanks, or the text ``null`` in any case."""
    x = _c(s)
    return x.isNull() | x.rlike(r"\A[\x00-\x20]*\z") | (F.lower(x) == "null")


def distinct_nonempty(arr) -> Column:
    """Order-preserving distinct without NULL / empty items."""
    return F.array_distinct(F.filter(_c(arr), lambda x: x.isNotNull() & (x != "")))


def split_list(s, sep: str = ",") -> Column:
    """Separated list -> array, empty items kept; NULL gives no items."""
    return F.when(_c(s).isNull(), F.array().cast("array<string>")).otherwise(
        F.split(_c(s), "\\Q" + sep + "\\E", -1))


def drop_empty(arr) -> Column:
    """The items that are neither NULL nor empty; NULL for an empty list."""
    return F.when(F.size(_c(arr)) > 0, F.filter(_c(arr), lambda x: x.isNotNull() & (x != "")))


def distinct_items(arr) -> Column:
    """Order-preserving distinct without NULL; empty items count."""
    return F.array_distinct(F.filter(_c(arr), lambda x: x.isNotNull()))


def usage_percent(free, total) -> Column:
    """Integer ``free * 100 / total``, shown with one decimal."""
    t = _c(total).cast("long")
    q = F.when(t != 0, F.call_function("div", _c(free).cast("long") * 100, t))
    return F.when(q.isNotNull(), F.format_string("%.1f", q.cast("double")))
