"""Windowed metrics (G1-G5, G7) on processed logs and raw lines.

Windows are tumbling on *event time* parsed from the ISO text (P8), so the
same function gives the same answer in batch and under Structured
Streaming (where the caller adds ``withWatermark``).

Skew: one address may carry a third of all rows.  The per-IP metrics are
two aggregates: first per (window, IP, kind, value), whose keys are many
even for one address, then per (window, IP) over the distinct values,
where a count is enough.  The only set ever held is that of the distinct
*seconds* of critical visits, which the window length bounds.  Batch and
stream run the same two aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import field
from ..functions.tags import matches_any
from ..schemas import RAW_SEP

# Small-gap bound of the gap-count metric, in seconds.
SMALL_GAP_SECONDS = 10


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def event_time(time_iso) -> Column:
    """ISO text -> TIMESTAMP_NTZ at second resolution.

    Text before the first ``+``, ``T`` replaced by a space; the value ``0``,
    text without ``+`` and unparsable text give NULL.  The time is the
    pattern ``yyyy-MM-dd HH:mm:ss``, 19 characters; what follows them up to
    the ``+`` (fractions of a second) is not part of it and is left out.
    """
    t = _c(time_iso)
    pos = F.instr(t, "+")
    s = F.when((pos > 0) & (t != "0"), F.replace(F.substring(t, F.lit(1), pos - 1), F.lit("T"), F.lit(" ")))
    return F.substring(s, 1, 19).try_cast("timestamp_ntz")


def watermark_time(ts_ntz: Column) -> Column:
    """TIMESTAMP_NTZ -> the same wall clock as a UTC instant (TIMESTAMP).

    Watermarks need TIMESTAMP; reading the text with an explicit ``Z``
    keeps the instant independent of the session time zone.
    """
    return F.concat(F.date_format(ts_ntz, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).try_cast("timestamp")


def window_start(ts: Column, seconds: int) -> Column:
    return F.window(ts, f"{int(seconds)} seconds").start


def fmt_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _metric_inputs(logs: DataFrame, critical: Column, seconds: int) -> DataFrame:
    return (logs.select(
                *[c for c in logs.columns if c == "__et"],
                F.col("remoteAddr").alias("ip"), critical.alias("crit"),
                F.col("httpUserAgent").alias("ua"), F.col("depcity").alias("dep"), F.col("arrcity").alias("arr"),
                F.col("JSESSIONID").alias("cookie"),
                event_time("timeIso8601").alias("ts"))
            .filter(F.col("ts").isNotNull())
            .withColumn("win", window_start(F.col("ts"), seconds)))


# Kinds of values that are counted once: user agent, trip, critical cookie, critical second.
_UA, _TRIP, _COOKIE, _SECOND = "ua", "trip", "cookie", "second"


def _values(base: DataFrame, keep: list[str]) -> DataFrame:
    """One row per visit and kind: kind, v1, v2, sec beside ``keep``."""
    none, no_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")

    def value(kind: str, v1: Column, v2: Column = none, sec: Column = no_time) -> Column:
        return F.struct(F.lit(kind).alias("kind"), v1.alias("v1"), v2.alias("v2"), sec.alias("sec"))

    always = [value(_UA, F.col("ua")), value(_TRIP, F.col("dep"), F.col("arr"))]
    critical = [value(_COOKIE, F.col("cookie")), value(_SECOND, none, none, F.col("ts"))]
    return base.select(*keep, "crit", F.inline(F.when(F.col("crit"), F.array(*always, *critical)).otherwise(F.array(*always))))


def _per_value(values: DataFrame, *keys) -> DataFrame:
    return values.groupBy(*keys, "win", "ip", "kind", "v1", "v2", "sec").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("crit").alias("c"))


def _per_ip(distinct: DataFrame, *keys) -> DataFrame:
    """Second aggregate.  Every visit has one user agent, so those rows carry the visits."""
    kind = F.col("kind")
    agg = distinct.groupBy(*keys, "win", "ip").agg(
        F.sum(F.when(kind == _UA, F.col("n"))).alias("ip_visits"), F.sum(F.when(kind == _UA, F.col("c"))).alias("__crit_n"),
        F.count_if(kind == _UA).alias("distinct_ua"), F.count_if(kind == _TRIP).alias("distinct_trips"),
        F.count_if(kind == _COOKIE).alias("critical_cookies"),
        F.array_sort(F.collect_set("sec")).alias("__secs"))
    return _metric_columns(agg)


def _metric_columns(agg: DataFrame) -> DataFrame:
    return agg.select(
        fmt_time(F.col("win")).alias("window_start"), "ip", "ip_visits", F.col("__crit_n").alias("critical_visits"),
        "distinct_ua", *_gap_metrics(), "distinct_trips", "critical_cookies")


def _gap_metrics() -> list[Column]:
    """G1d / G1e from (count, sorted distinct seconds).

    Repeated seconds add ``count - distinct`` zero gaps; the other gaps are
    the differences of consecutive distinct seconds.
    """
    secs, n = F.col("__secs"), F.col("__crit_n")
    dup = n - F.size(secs)
    diffs = F.transform(F.slice(secs, 2, F.greatest(F.size(secs) - 1, F.lit(1))),
                        lambda t, i: F.timestamp_diff("SECOND", F.element_at(secs, i + 1), t))
    diffs = F.when(F.size(secs) >= 2, diffs).otherwise(F.array().cast("array<bigint>"))
    min_gap = (F.when(n < 2, F.lit(None).cast("int"))
               .when(dup > 0, F.lit(0))
               .otherwise(F.array_min(diffs).cast("int")))
    under = dup + F.size(F.filter(diffs, lambda d: d < SMALL_GAP_SECONDS))
    return [min_gap.alias("min_critical_gap"), under.cast("long").alias("gaps_under_10s")]


def _critical(critical_pages: Sequence[str] | Column) -> Column:
    return critical_pages if isinstance(critical_pages, Column) else matches_any("request", critical_pages)


def ip_window_metrics(logs: DataFrame, critical_pages: Sequence[str] | Column, seconds: int = 10) -> DataFrame:
    """G1a-G1g: seven metrics per (window, remote address).

    ``critical_pages`` are patterns of the request, or a boolean column
    that tells critical visits already.  Columns: window_start, ip,
    ip_visits, critical_visits, distinct_ua, min_critical_gap (NULL below
    two critical visits, P11), gaps_under_10s, distinct_trips,
    critical_cookies.  A null user agent, city or cookie is a value.
    """
    base = _metric_inputs(logs, _critical(critical_pages), seconds)
    return _per_ip(_per_value(_values(base, ["win", "ip"])))


def ip_window_metrics_stream(logs: DataFrame, critical_pages: Sequence[str] | Column, seconds: int = 10,
                             watermark: str = "30 seconds", approx: bool = False) -> DataFrame:
    """G1 for Structured Streaming (append mode after the watermark).

    Two chained stateful aggregates.  The first keeps one state row per
    distinct value, hashed over all tasks by (window, IP, kind, value): a
    hot address is spread like any other.  The second gets each value
    once, when the watermark passes its window, and keeps a row of counts
    per (window, IP).  If the logs already carry a watermark (``__et``) it
    is used as it is.

    ``approx=True`` is for sources that rotate so many values that even
    spread state is too much: one aggregate with a sketch of fixed size for
    each distinct count.
    """
    base = _metric_inputs(logs, _critical(critical_pages), seconds)
    if "__et" not in logs.columns:
        base = base.withColumn("__et", watermark_time(F.col("ts"))).withWatermark("__et", watermark)
    length = f"{int(seconds)} seconds"
    if approx:
        kinds = _values(base, ["__et", "win", "ip"])
        only = lambda k: F.when(F.col("kind") == k, F.to_json(F.struct("v1", "v2")))
        seen = F.col("kind") == _UA
        agg = kinds.groupBy(F.window("__et", length).alias("w"), "win", "ip").agg(
            F.count_if(seen).alias("ip_visits"), F.count_if(seen & F.col("crit")).alias("__crit_n"),
            *[F.approx_count_distinct(only(k)).alias(c) for k, c in (
                (_UA, "distinct_ua"), (_TRIP, "distinct_trips"), (_COOKIE, "critical_cookies"))],
            F.array_sort(F.collect_set("sec")).alias("__secs"))
        return _metric_columns(agg)
    # The NTZ window start follows from the watermarked window; grouping
    # by both keeps the output identical to batch.
    distinct = _per_value(_values(base, ["__et", "win", "ip"]), F.window("__et", length).alias("w"))
    return _per_ip(distinct, F.window("w", length).alias("w2"))


def method_window_counts(logs: DataFrame, seconds: int = 10) -> DataFrame:
    """Requests per (window, ip, method)."""
    ts = event_time("timeIso8601")
    return (logs.select(F.col("remoteAddr").alias("ip"), F.col("requestMethod").alias("method"), ts.alias("ts"))
            .filter(F.col("ts").isNotNull())
            .groupBy(window_start(F.col("ts"), seconds).alias("win"), "ip", "method")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(fmt_time(F.col("win")).alias("window_start"), "ip", "method", "n"))


def method_window_counts_stream(logs: DataFrame, seconds: int = 10, watermark: str = "30 seconds") -> DataFrame:
    """G5 on a stream: same rows as :func:`method_window_counts`, emitted
    once the watermark passes the window (append mode)."""
    ts = event_time("timeIso8601")
    b = (logs.select(F.col("remoteAddr").alias("ip"), F.col("requestMethod").alias("method"), ts.alias("ts"))
         .filter(F.col("ts").isNotNull())
         .withColumn("win", window_start(F.col("ts"), seconds))
         .withColumn("__et", watermark_time(F.col("ts"))).withWatermark("__et", watermark))
    return (b.groupBy(F.window("__et", f"{int(seconds)} seconds").alias("w"), "win", "ip", "method")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(fmt_time(F.col("win")).alias("window_start"), "ip", "method", "n"))


def raw_server_fields(raw: DataFrame) -> DataFrame:
    """Time, server and active-connection fields of raw lines.

    Trailing empty fields are trimmed before the length test, as a split
    without limit would do; a non-numeric connection count is NULL.
    """
    arr = F.split(F.col("value"), RAW_SEP, -1)
    last = F.coalesce(F.array_max(F.filter(
        F.transform(arr, lambda x, i: F.when(x != "", i)), lambda i: i.isNotNull())), F.lit(-1))
    n = last + 1
    return raw.select(
        event_time(field(arr, 8)).alias("ts"),
        F.when(n > 9, field(arr, 9)).otherwise(F.lit("")).alias("server"),
        F.when(n > 11, F.get(arr, 11).try_cast("int")).alias("active"))


def link_traffic(raw: DataFrame, seconds: int = 5) -> DataFrame:
    """Request count per server per window."""
    f = raw_server_fields(raw).filter(F.col("ts").isNotNull())
    return (f.groupBy(window_start(F.col("ts"), seconds).alias("win"), "server")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(fmt_time(F.col("win")).alias("window_start"), "server", "n"))


def active_latest(raw: DataFrame, seconds: int = 5) -> DataFrame:
    """Active connections of the latest line per server per window.

    Latest = greatest event time; ties go to the larger count.
    """
    f = raw_server_fields(raw).filter(F.col("ts").isNotNull() & F.col("active").isNotNull())
    return (f.groupBy(window_start(F.col("ts"), seconds).alias("win"), "server")
            .agg(F.max_by("active", F.struct("ts", "active")).alias("active"))
            .select(fmt_time(F.col("win")).alias("window_start"), "server", "active"))


def server_daily_counts(logs: DataFrame) -> DataFrame:
    """Requests per (server, day) from processed logs."""
    return (logs.select(F.col("serverAddr").alias("server"),
                        F.substring("timeIso8601", 1, 10).alias("day"))
            .groupBy("server", "day").agg(F.count(F.lit(1)).alias("n")))


def server_three_day(daily: DataFrame) -> DataFrame:
    """Per server and day: today, yesterday, day before, 3-day total.

    Days are calendar days: a missing day counts 0 (range frame on the
    day number, not a row frame), so restarting a job never double counts.
    """
    d = daily.withColumn("dn", F.datediff(F.to_date("day"), F.lit("1970-01-01").cast("date")))
    w = Window.partitionBy("server").orderBy("dn")
    return d.select(
        "server", "day", F.col("n").alias("today"),
        F.coalesce(F.sum("n").over(w.rangeBetween(-1, -1)), F.lit(0)).cast("long").alias("yesterday"),
        F.coalesce(F.sum("n").over(w.rangeBetween(-2, -2)), F.lit(0)).cast("long").alias("before_yesterday"),
        F.sum("n").over(w.rangeBetween(-2, 0)).cast("long").alias("last_three_days"))
