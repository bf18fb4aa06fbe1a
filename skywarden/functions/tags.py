"""Classification and tagging expressions (D1-D6, B27) and regex helpers.

Rules are small configuration lists: each is one anchored pattern literal,
and a group of them is a disjunction inside the projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BEHAVIOR_TYPE_IDS, FLIGHT_TYPE_IDS, TRAVEL_TYPE_IDS  # noqa: F401

# Page-stage patterns of the request tag (1 booking,
# 2 passenger information, 3 payment; anything else is 0).
BOOKING_PATTERNS = ["^.*/bookingnew/.*$", "^.*/bookingGroup/.*$", "^.*/ita/intl/zh/shop/.*$"]
PASSENGER_PATTERNS = ["^.*/modules/permissionnew/.*$", "^.*/ita/intl/zh/passengers/.*$"]
PAYMENT_PATTERNS = ["^.*upp_payment/pay/.*$"]

# Travel-date pattern of a referrer parameter value.
DATE_VALUE_PATTERN = r"^(\d{4})-(0\d{1}|1[0-2])-(0\d{1}|[12]\d{1}|3[01])$"


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def full_pattern(patterns: Sequence[str]) -> str | None:
    """Alternation of ``patterns`` anchored to the whole input.

    ``String.matches`` semantics: the pattern must consume the whole text;
    ``\\z`` (not ``$``) so a trailing newline does not slip through.
    """
    pats = [p for p in patterns if p is not None and p != ""]
    if not pats:
        return None
    return r"\A(?:" + "|".join("(?:" + p + ")" for p in pats) + r")\z"


def matches_any(col, patterns: Sequence[str]) -> Column:
    """True when ``col`` fully matches one of ``patterns`` (False if none)."""
    # One match per pattern: joined into one, back-references would shift.
    # Halved again and again, so that any number of patterns makes a shallow plan.
    hits = [_c(col).rlike(full_pattern([p])) for p in patterns if p]
    while len(hits) > 1:
        hits = [reduce(or_, hits[i:i + 2]) for i in range(0, len(hits), 2)]
    return F.coalesce(hits[0], F.lit(False)) if hits else F.lit(False)


def request_flag(request) -> Column:
    """D3: page stage '1' booking, '2' passenger, '3' payment, '0' other.

    A NULL request is tagged '0' (P23).
    """
    r = _c(request)
    return (F.when(matches_any(r, BOOKING_PATTERNS), "1")
            .when(matches_any(r, PASSENGER_PATTERNS), "2")
            .when(matches_any(r, PAYMENT_PATTERNS), "3")
            .otherwise("0"))


def spider_flag(flow_id) -> Column:
    """D4: '0' for NULL or the text 'null' (any case), else '1'."""
    f = _c(flow_id)
    return F.when(f.isNull() | (F.lower(f) == "null"), "0").otherwise("1")


def visit_day(time_iso) -> Column:
    """First ten characters of the ISO time, the day."""
    return F.substring(_c(time_iso), 1, 10)


def classify_request(url, nation_query: Sequence[str], internation_query: Sequence[str],
                     nation_book: Sequence[str], internation_book: Sequence[str]) -> Column:
    """(flightType, behaviorType) names from the first matching group."""
    u = _c(url)
    groups = [(nation_query, "National", "Query"), (internation_query, "International", "Query"),
              (nation_book, "National", "Book"), (internation_book, "International", "Book")]
    flight, behavior = None, None
    for pats, fl, be in groups:
        hit = matches_any(u, pats)
        flight = F.when(hit, fl) if flight is None else flight.when(hit, fl)
        behavior = F.when(hit, be) if behavior is None else behavior.when(hit, be)
    return F.struct(flight.otherwise("Other").alias("flightType"),
                    behavior.otherwise("Other").alias("behaviorType"))


def referrer_date_count(referrer) -> Column:
    """Number of query parameters whose value is a ``yyyy-MM-dd`` date."""
    ref = F.coalesce(_c(referrer), F.lit(""))
    query = F.coalesce(F.get(F.split(ref, r"\?", -1), 1), F.lit(""))
    values = F.transform(F.split(query, "&", -1), lambda p: F.get(F.split(p, "=", -1), 1))
    return F.size(F.filter(values, lambda v: F.coalesce(v.rlike(full_pattern([DATE_VALUE_PATTERN])),
                                                       F.lit(False))))


def travel_type(referrer) -> Column:
    """OneWay for one date parameter, RoundTrip for two, else Unknown."""
    n = referrer_date_count(referrer)
    return F.when(n == 1, "OneWay").when(n == 2, "RoundTrip").otherwise("Unknown")


def enum_id(name_col, mapping: dict[str, int], default: int = -1) -> Column:
    """Enum name -> id through a map literal."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, _c(name_col)), F.lit(default))


def hot_ip_flag(df: DataFrame, ip_col: str, hot_ips: DataFrame, hot_col: str = "ip_name",
                out: str = "highFrqIPGroup") -> DataFrame:
    """Exact membership of ``ip_col`` in the hot-IP table.

    A left join on the de-duplicated list (no fan-out); Spark/AQE decides
    between broadcast and shuffle join from the list's measured size.
    """
    hot = hot_ips.select(F.col(hot_col).alias("__hot_ip")).distinct()
    j = df.join(hot, df[ip_col] == hot["__hot_ip"], "left")
    return j.withColumn(out, F.col("__hot_ip").isNotNull()).drop("__hot_ip")
