"""Batch indicators: logs x blacklist -> tags -> conversion / flow metrics.

E1 (left join, fan-out kept), B28 (tag projection) and F1-F16.

Plan shape at scale: the 16 indicators never need individual log rows,
only counts per (stage, crawler tag, flight type, travel type).  Logs are
therefore pre-aggregated per remote address *before* the blacklist join
(map-side partial aggregation collapses a hot address to a handful of
rows), the join multiplies those counts exactly as the row-level join
multiplies rows (P5), and one small aggregate feeds every indicator.
One scan of the logs, two shuffles of pre-aggregated rows, no per-
indicator rescans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import request_flag, spider_flag, visit_day

NATIONAL = ("National",)
# Both spellings of the international flight type are accepted.
INTERNATIONAL = ("International", "Internatinal")


def join_blacklist(logs: DataFrame, blacklist: DataFrame, dedupe: bool = False) -> DataFrame:
    """Left outer join on remoteAddr; several flows per IP multiply rows."""
    bl = blacklist.select("remoteAddr", "flowID")
    if dedupe:
        bl = bl.dropDuplicates(["remoteAddr"])
    return logs.join(bl, "remoteAddr", "left")


def tag(joined: DataFrame) -> DataFrame:
    """The six-column tag projection (processTag)."""
    return joined.select(
        F.col("request"),
        request_flag("request").alias("requestType"),
        spider_flag("flowID").alias("isSpider"),
        F.col("travelType"),
        F.col("flightType"),
        visit_day("timeIso8601").alias("visitTime"),
    )


def tagged_requests(logs: DataFrame, blacklist: DataFrame, dedupe: bool = False) -> DataFrame:
    """Row-level tagged log (E1 + D3 + D4 + B27 + B28)."""
    return tag(join_blacklist(logs, blacklist, dedupe))


def stage_summary(logs: DataFrame, blacklist: DataFrame, dedupe: bool = False) -> DataFrame:
    """Counts per (requestType, isSpider, flightType, travelType) + max day.

    Equivalent to aggregating :func:`tagged_requests`, but the logs are
    reduced per address first, so the join and the hot keys stay small.
    """
    # The day is a grouping key here (not max'ed): fixed-width buffers keep
    # the pass over the full log a hash aggregate; days are few.
    per_ip = (logs.select(
                  "remoteAddr",
                  request_flag("request").alias("requestType"),
                  "flightType", "travelType",
                  visit_day("timeIso8601").alias("visitTime"))
              .groupBy("remoteAddr", "requestType", "flightType", "travelType", "visitTime")
              .agg(F.count(F.lit(1)).alias("n")))
    bl = blacklist.select("remoteAddr", "flowID")
    if dedupe:
        bl = bl.dropDuplicates(["remoteAddr"])
    j = per_ip.join(bl, "remoteAddr", "left")
    return (j.select("requestType", spider_flag("flowID").alias("isSpider"),
                     "flightType", "travelType", "n", "visitTime")
             .groupBy("requestType", "isSpider", "flightType", "travelType")
             .agg(F.sum("n").alias("n"), F.max("visitTime").alias("visitTime")))


def _count(where: Column, stage: str | None = None) -> Column:
    """sum(case when stage then 1 else 0) over rows passing ``where``."""
    hit = where if stage is None else where & (F.col("requestType") == stage)
    return F.sum(F.when(hit, F.col("n")).when(where, F.lit(0)))


def _ratio(where: Column, num_stage: str, den_stage: str, digits: int | None) -> Column:
    r = F.try_divide(_count(where, num_stage).cast("double"), _count(where, den_stage).cast("double"))
    return F.round(r, digits) if digits is not None else r


def _last_day(where: Column) -> Column:
    return F.max(F.when(where, F.col("visitTime")))


def _flight_in(names: Sequence[str]) -> Column:
    return F.col("flightType").isin(*names)


def _rows(names: Sequence[str], *rows) -> Column:
    """inline(array(struct ...)): several output rows from one agg row."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]))


def conversion_by_flight(summary: DataFrame, names: Sequence[str], flight_code: int) -> DataFrame:
    """Query->passenger (step 0) and passenger->payment (step 1), 2 dp."""
    w = _flight_in(names)
    row = summary.agg(_ratio(w, "2", "1", 2).alias("r0"), _ratio(w, "3", "2", 2).alias("r1"),
                      _last_day(w).alias("record_time"))
    return row.select(_rows(
        ["step_type", "flight_type", "conversion_rate", "record_time"],
        (F.lit(0), F.lit(flight_code), F.col("r0"), F.col("record_time")),
        (F.lit(1), F.lit(flight_code), F.col("r1"), F.col("record_time"))))


def conversion_by_user(summary: DataFrame, spider: str | None) -> DataFrame:
    """Per crawler tag ('1', '0') or all users (None), unrounded.

    The all-user rows carry a NULL user code (P22).
    """
    w = F.lit(True) if spider is None else (F.col("isSpider") == spider)
    code = F.lit(None).cast("int") if spider is None else F.lit(int(spider))
    row = summary.agg(_ratio(w, "2", "1", None).alias("r0"), _ratio(w, "3", "2", None).alias("r1"),
                      _last_day(w).alias("record_time"))
    return row.select(_rows(
        ["step_type", "query_spider_type", "conversion_rate", "record_time"],
        (F.lit(0), code, F.col("r0"), F.col("record_time")),
        (F.lit(1), code, F.col("r1"), F.col("record_time"))))


def crawl_frequency(summary: DataFrame) -> DataFrame:
    """crawler requests per (flightType, travelType)."""
    return (summary.filter(F.col("isSpider") == "1")
            .groupBy("flightType", "travelType")
            .agg(F.sum("n").cast("long").alias("frequency"), F.max("visitTime").alias("record_time"))
            .select(F.col("flightType").alias("flight_type"), F.col("travelType").alias("travel_type"),
                    "frequency", "record_time"))


def book_query_ratio(summary: DataFrame) -> DataFrame:
    """Booking / query ratio, crawler (user_type 2) and normal (1)."""
    s, ns = F.col("isSpider") == "1", F.col("isSpider") == "0"
    row = summary.agg(_ratio(s, "1", "0", None).alias("r2"), _last_day(s).alias("t2"),
                      _ratio(ns, "1", "0", None).alias("r1"), _last_day(ns).alias("t1"))
    return row.select(_rows(["user_type", "rate", "record_time"],
                            (F.lit(2), F.col("r2"), F.col("t2")),
                            (F.lit(1), F.col("r1"), F.col("t1"))))


def flow_counts(summary: DataFrame) -> DataFrame:
    """Request counts, crawler (type 1), normal (2), all (0)."""
    row = summary.agg(
        F.coalesce(F.sum(F.when(F.col("isSpider") == "1", F.col("n"))), F.lit(0)).cast("long").alias("c1"),
        F.coalesce(F.sum(F.when(F.col("isSpider") == "0", F.col("n"))), F.lit(0)).cast("long").alias("c2"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("c0"))
    return row.select(_rows(["type", "value"], (F.lit(1), F.col("c1")),
                            (F.lit(2), F.col("c2")), (F.lit(0), F.col("c0"))))


def _ind(name: str, step, code, code2, value: Column, record_time: Column) -> Column:
    def lit(v, t):
        return F.lit(v).cast(t) if not isinstance(v, Column) else v.cast(t)
    return F.struct(F.lit(name).alias("indicator"), lit(step, "int").alias("step_type"),
                    lit(code, "int").alias("code"), lit(code2, "string").alias("code2"),
                    value.cast("double").alias("value"), record_time.cast("string").alias("record_time"))


def all_indicators(summary: DataFrame) -> DataFrame:
    """Every indicator (F1-F16) in one long table from ONE aggregate.

    Grouping sets ``()`` and ``(flightType, travelType)`` over the small
    summary give the 14 global indicators and the per-route crawl counts
    in a single pass; the rows are then unpivoted with ``inline``.
    Columns: indicator, step_type, code, code2, value, record_time.
    """
    nat, intl = _flight_in(NATIONAL), _flight_in(INTERNATIONAL)
    sp, ns, al = F.col("isSpider") == "1", F.col("isSpider") == "0", F.lit(True)
    g = summary.groupingSets([[], ["flightType", "travelType"]], "flightType", "travelType").agg(
        F.grouping_id().alias("gid"),
        _ratio(nat, "2", "1", 2).alias("n0"), _ratio(nat, "3", "2", 2).alias("n1"), _last_day(nat).alias("nt"),
        _ratio(intl, "2", "1", 2).alias("i0"), _ratio(intl, "3", "2", 2).alias("i1"), _last_day(intl).alias("it"),
        _ratio(sp, "2", "1", None).alias("s0"), _ratio(sp, "3", "2", None).alias("s1"), _last_day(sp).alias("st"),
        _ratio(ns, "2", "1", None).alias("o0"), _ratio(ns, "3", "2", None).alias("o1"), _last_day(ns).alias("ot"),
        _ratio(al, "2", "1", None).alias("a0"), _ratio(al, "3", "2", None).alias("a1"), _last_day(al).alias("at"),
        _ratio(sp, "1", "0", None).alias("bq2"), _ratio(ns, "1", "0", None).alias("bq1"),
        F.sum(F.when(sp, F.col("n"))).alias("c1"), F.sum(F.when(ns, F.col("n"))).alias("c2"),
        F.sum("n").alias("c0"))
    c = F.col
    dom, fq = "domestic_inter_conversion_rate", "flight_query_conversion_rate"
    globals_ = F.array(
        _ind(dom, 0, 0, None, c("n0"), c("nt")), _ind(dom, 1, 0, None, c("n1"), c("nt")),
        _ind(dom, 0, 1, None, c("i0"), c("it")), _ind(dom, 1, 1, None, c("i1"), c("it")),
        _ind(fq, 0, 1, None, c("s0"), c("st")), _ind(fq, 1, 1, None, c("s1"), c("st")),
        _ind(fq, 0, 0, None, c("o0"), c("ot")), _ind(fq, 1, 0, None, c("o1"), c("ot")),
        _ind(fq, 0, None, None, c("a0"), c("at")), _ind(fq, 1, None, None, c("a1"), c("at")),
        _ind("flow_query_rate", None, 2, None, c("bq2"), c("st")),
        _ind("flow_query_rate", None, 1, None, c("bq1"), c("ot")),
        _ind("flow_info", None, 1, None, F.coalesce(c("c1"), F.lit(0)), F.lit(None)),
        _ind("flow_info", None, 2, None, F.coalesce(c("c2"), F.lit(0)), F.lit(None)),
        _ind("flow_info", None, 0, None, F.coalesce(c("c0"), F.lit(0)), F.lit(None)))
    route = F.array(_ind("flight_query_rule", None, None, F.concat_ws("/", "flightType", "travelType"),
                         c("c1"), c("st")))
    # Routes only count crawler rows; a route seen only from normal users
    # has no crawl-frequency row.
    keep = (c("gid") == 3) | c("c1").isNotNull()
    return g.filter(keep).select(F.inline(F.when(c("gid") == 3, globals_).otherwise(route)))
