"""DuckDB SQL building blocks shared by the oracle queries."""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.tags import (BOOKING_PATTERNS, PASSENGER_PATTERNS, PAYMENT_PATTERNS)
from .fixtures import BLACKLIST_SQL, requests_sql


def sql_full_match(expr: str, patterns: Sequence[str]) -> str:
    """``regexp_full_match`` over the alternation of ``patterns``."""
    alt = "|".join("(?:" + p + ")" for p in patterns)
    return f"coalesce(regexp_full_match({expr}, '{alt}'), false)"


def sql_request_flag(expr: str) -> str:
    return (f"CASE WHEN {sql_full_match(expr, BOOKING_PATTERNS)} THEN '1' "
            f"WHEN {sql_full_match(expr, PASSENGER_PATTERNS)} THEN '2' "
            f"WHEN {sql_full_match(expr, PAYMENT_PATTERNS)} THEN '3' ELSE '0' END")


def sql_spider_flag(expr: str) -> str:
    return f"CASE WHEN {expr} IS NULL OR lower({expr}) = 'null' THEN '0' ELSE '1' END"


def with_tagged(body: str) -> str:
    """Prefix ``body`` with the req / bl / tagged CTEs (E1 + B28)."""
    return f"""
WITH req AS ({requests_sql()}),
bl AS ({BLACKLIST_SQL}),
tagged AS (
  SELECT r.request,
         {sql_request_flag('r.request')} AS requestType,
         {sql_spider_flag('b.flowID')} AS isSpider,
         r.travelType, r.flightType, substr(r.timeIso8601, 1, 10) AS visitTime
  FROM req r LEFT JOIN bl b ON r.remoteAddr = b.remoteAddr
)
{body}
"""


def sql_cnt(stage: str) -> str:
    return f"sum(CASE WHEN requestType = '{stage}' THEN 1 ELSE 0 END)"


def sql_ratio(num: str, den: str, digits: int | None) -> str:
    r = f"{sql_cnt(num)} / nullif(CAST({sql_cnt(den)} AS DOUBLE), 0)"
    return f"round({r}, {digits})" if digits is not None else r
