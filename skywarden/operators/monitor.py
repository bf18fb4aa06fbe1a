"""Monitoring roll-ups and reads.

Inputs are monitor points, best those of the time-indexed store
(``sources.points``), and host samples.  Bounds on time become bounds on
the store's day folders, so a read opens the days that it needs; points
that are not from the store get their time and day from the text.
"Latest per key" over samples is a hash aggregate of the newest time plus
a join back (``latest_point``), never a window or a sort over a whole key:
a host with a third of all samples is reduced map-side like any other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import helpers as H
from ..sources import points as P

TIME_FMT = P.TIME_FMT


def _at(now: str) -> dt.datetime:
    return dt.datetime.fromisoformat(now)


def between_minutes(points: DataFrame, now: str, minutes: int) -> DataFrame:
    """Strictly inside the last ``minutes`` before ``now``."""
    return P.between(points, _at(now) - dt.timedelta(minutes=minutes), _at(now), with_start=False)


def older_than(points: DataFrame, now: str, minutes: int = 30) -> DataFrame:
    """Points older than ``minutes`` before ``now``."""
    return P.between(points, end=_at(now) - dt.timedelta(minutes=minutes))


def whole_days(points: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """C11: whole days ``[start day 00:00, end day + 1 00:00)``: a bound on the day folders alone.

    Given bounds are used as given (P15); the caller supplies defaults.
    """
    out = P.with_time(points)
    if start:
        out = out.filter(F.col("day") >= F.lit(start).cast("date"))
    if end:
        out = out.filter(F.col("day") <= F.lit(end).cast("date"))
    return out


def liveness(points: DataFrame, now: str, minutes: int = 2) -> DataFrame:
    """C12 per kind: 1 when no point arrived in the last ``minutes``.

    The kinds come from the folder names, the recent points from the days
    of those minutes.
    """
    points = P.with_time(points)
    recent = P.between(points, _at(now) - dt.timedelta(minutes=minutes), _at(now), with_start=False, with_end=True)
    alive = recent.groupBy("kind").agg(F.lit(0).alias("is_down"))
    return points.select("kind").distinct().join(alive, "kind", "left").select("kind", F.coalesce("is_down", F.lit(1)).alias("is_down"))


def newest_point(points: DataFrame) -> DataFrame:
    """H4 / H5: the newest point of each kind; best out of ``sources.points.read_newest``."""
    points = P.with_time(points)
    cols = [c for c in points.columns if c != "kind"]
    return points.groupBy("kind").agg(F.max_by(F.struct(*cols), F.struct("ts", "end_time")).alias("__last")).select("kind", "__last.*")


def latest_point(points: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """H4 / H6 / H8: the newest row per key on the total order ``order``.

    Hash-based in two steps instead of one sort-based ``max_by`` over every
    row: the newest time per key (a fixed-width hash aggregate), a join
    back on the key (one row per key on the small side, so broadcast or
    skew-split by AQE), then ``max_by`` over the few rows that share the
    newest time.  A key holding a third of all rows costs one hash slot.
    """
    first = order[0]
    cols = [c for c in points.columns if c not in keys]
    newest = points.groupBy(*keys).agg(F.max(first).alias("__newest"))
    newest = newest.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__newest")
    cond = None
    for k in keys:
        c = points[k].eqNullSafe(newest[f"__k_{k}"])
        cond = c if cond is None else cond & c
    tied = points.join(newest, cond, "inner").filter(F.col(first).eqNullSafe(F.col("__newest")))
    return (tied.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("__last"))
            .select(*keys, "__last.*"))


def daily_flow(points: DataFrame, day: str, kind: str = "DP") -> DataFrame:
    """total source count of one day for one kind."""
    d = whole_days(points, day, day).filter(F.col("kind") == kind)
    return d.agg(F.coalesce(F.sum("source_count"), F.lit(0)).cast("long").alias("total_flow"))


def server_totals(link_points: DataFrame, kind: str = "serversCountMap") -> DataFrame:
    """per server, sum over every link map of that kind."""
    return (link_points.filter(F.col("kind") == kind)
            .select(F.explode("value_map").alias("server", "n"))
            .groupBy("server").agg(F.sum("n").cast("long").alias("total")))


def recent_series(points: DataFrame, now: str, minutes: int) -> DataFrame:
    """per kind, the (time, count) series of the last minutes + total.

    The series length is bounded by ``minutes`` / point interval.
    """
    r = between_minutes(points, now, minutes)
    return r.groupBy("kind").agg(
        F.sort_array(F.collect_list(F.struct("end_time", "source_count"))).alias("series"),
        F.sum("source_count").cast("long").alias("total"))


def crawler_totals(daily_identified: DataFrame, day: str) -> DataFrame:
    """crawlers identified on ``day`` and over all days."""
    return daily_identified.agg(
        F.coalesce(F.max(F.when(F.col("day") == day, F.col("n"))), F.lit(0)).cast("long").alias("on_day"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("all_days"))


def current_day_panel(points: DataFrame, daily_identified: DataFrame, day: str) -> DataFrame:
    """K4: flow of the day, crawlers identified that day, all identified.

    One aggregate over a tagged union (no join of one-row results).
    """
    flow = (whole_days(points, day, day).filter(F.col("kind") == "DP")
            .select(F.lit("flow").alias("what"), F.lit(day).alias("day"), F.col("source_count").alias("n")))
    ident = daily_identified.select(F.lit("ident").alias("what"), "day", F.col("n"))
    u = flow.unionByName(ident)
    return u.agg(
        F.coalesce(F.sum(F.when(F.col("what") == "flow", F.col("n"))), F.lit(0)).cast("long").alias("flow_today"),
        F.coalesce(F.sum(F.when((F.col("what") == "ident") & (F.col("day") == day), F.col("n"))),
                   F.lit(0)).cast("long").alias("identified_today"),
        F.coalesce(F.sum(F.when(F.col("what") == "ident", F.col("n"))), F.lit(0)).cast("long").alias("identified_total"))


def children(points: DataFrame, now: str, minutes: int = 30) -> DataFrame:
    """E9 + C10: old points flattened to (parent id, server, count) rows."""
    old = older_than(points, now, minutes)
    return old.select("id", "kind", "end_time", F.explode("servers_count_map").alias("server", "n"))


def server_view(daily_counts: DataFrame, link_points: DataFrame) -> DataFrame:
    """E8 + H6: per-server 3-day counts joined with the newest active map.

    The newest point is picked by its key (lexical order, H6); its map is
    exploded and inner-joined with the per-server counts.
    """
    act = link_points.filter(F.col("kind") == "activeNumMap")
    newest = act.agg(F.max_by("value_map", "key").alias("m"))
    active = newest.select(F.explode("m").alias("server", "active"))
    return daily_counts.join(active, "server", "inner")


def host_status(sys_samples: DataFrame, disk_samples: DataFrame) -> DataFrame:
    """H8 + F21 + E10 + B30: latest sample per host, disk roll-up of the
    latest sample per (host, device, mount), left-joined and formatted."""
    sys_last = latest_point(sys_samples, ["host"], ["ts", "l_orderkey", "l_linenumber"])
    disk_last = latest_point(disk_samples, ["host", "device", "mount"], ["ts", "l_orderkey", "l_linenumber"])
    disk = disk_last.groupBy("host").agg(F.sum("fs_used").alias("fs_used"), F.sum("fs_total").alias("fs_total"))
    j = sys_last.join(disk, "host", "left")
    return j.select(
        "host", F.date_format("ts", TIME_FMT).alias("state_time"),
        H.cpu_percent("cpu_system_p", "cpu_user_p").alias("cpu_rate"),
        (F.col("mem_actual_used_p") * 100).alias("memory_rate"),
        H.memory_text("mem_actual_used", "mem_total").alias("memory_info"),
        F.bround(F.col("fs_used") / F.col("fs_total") * 100, 2).alias("disk_rate"),
        H.disk_text("fs_used", "fs_total").alias("disk_info"))


def recent_hits(samples: DataFrame, now: str, seconds: int, cap: int) -> DataFrame:
    """Samples of the last ``seconds``, newest first, at most ``cap``
    (the cap is the feature: the dashboard reads one page of hits; its
    size is the caller's choice)."""
    t, last = F.col("ts"), F.lit(now).cast("timestamp_ntz")
    r = samples.filter((t >= last - F.make_interval(secs=F.lit(seconds))) & (t <= last))
    return r.orderBy(t.desc(), F.col("l_orderkey").desc(), F.col("l_linenumber").desc()).limit(cap)
