"""Registered queries: monitoring roll-ups, host status and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.helpers import route_label, speed_text
from ..operators import indicators as ind
from ..operators import monitor as M
from ..operators import reports as RP
from ..sources import points as P
from . import fixtures as fx
from . import monitor_fixtures as mf
from .registry import blacklist, derived, logs, register, summary
from .fixtures import CITIES, _list_sql, requests_sql
from .queries_scoring import FLOWS_CTE, METRICS_CTE, SCORES_CTE, _scored
from .sqlparts import sql_ratio, with_tagged

# Fixed report parameters (every "now" is an argument, so results are
# reproducible).
NOW = "2024-01-20 12:10:00"
DAY = "2024-01-15"
HOST_NOW = "1995-06-17 00:03:00"
RANGE = ("2024-01-05", "2024-01-20")
SPINE = ("2023-12-28", "2024-02-02")
OCC_RANGE = ("1996-01-01", "1998-12-31")
PAGE, ROWS = 2, 20
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _ev(spark, sf):
    return fx.table(spark, sf, "events")


def _points_path(spark, sf):
    """The point store, filled from the derived throughput points."""
    return derived(spark, sf, "points", lambda p: P.write_points(mf.throughput_points(_ev(spark, sf)), p))


def _links_path(spark, sf):
    return derived(spark, sf, "links", lambda p: P.write_points(mf.link_points(_ev(spark, sf)), p))


def _points(spark, sf):
    return P.read_points(spark, _points_path(spark, sf))


def _links(spark, sf):
    return P.read_points(spark, _links_path(spark, sf))


TP = f"tp AS ({mf.THROUGHPUT_SQL})"
LP = f"{mf.link_fields_sql()}, lp AS ({mf.LINK_POINTS_SQL})"


@register("throughput_points", f"""
WITH {TP} SELECT id, kind, end_time, source_count, cost_time, count_per_millis FROM tp
""")
def q_points(spark, sf):
    return _points(spark, sf).drop("servers_count_map", "ts", "day")


@register("daily_flow", f"""
WITH {TP} SELECT CAST(coalesce(sum(source_count), 0) AS BIGINT) AS total_flow FROM tp
WHERE kind = 'DP' AND substr(end_time, 1, 10) = '{DAY}'
""")
def q_daily_flow(spark, sf):
    return M.daily_flow(_points(spark, sf), DAY)


@register("server_totals", f"""
WITH {LP} SELECT server, CAST(sum(n) AS BIGINT) AS total FROM lp WHERE kind = 'serversCountMap' GROUP BY server
""")
def q_server_totals(spark, sf):
    return M.server_totals(_links(spark, sf))


_RECENT = (f"strptime(end_time, '%Y-%m-%d %H:%M:%S') > TIMESTAMP '{NOW}' - INTERVAL 360 MINUTE "
           f"AND strptime(end_time, '%Y-%m-%d %H:%M:%S') < TIMESTAMP '{NOW}'")


@register("recent_points", f"""
WITH {TP}
SELECT kind, string_agg(end_time || '=' || CAST(source_count AS VARCHAR), ',' ORDER BY end_time) AS series,
       CAST(sum(source_count) AS BIGINT) AS total
FROM tp WHERE {_RECENT} GROUP BY kind
""")
def q_recent(spark, sf):
    r = M.recent_series(_points(spark, sf), NOW, 360)
    return r.select("kind", F.array_join(F.transform("series", lambda x: F.concat_ws(
        "=", x["end_time"], x["source_count"].cast("string"))), ",").alias("series"), "total")


@register("liveness", f"""
WITH {TP}
SELECT kind, CASE WHEN count(*) FILTER (WHERE strptime(end_time, '%Y-%m-%d %H:%M:%S')
                  > TIMESTAMP '{NOW}' - INTERVAL 2 MINUTE AND strptime(end_time, '%Y-%m-%d %H:%M:%S')
                  <= TIMESTAMP '{NOW}') = 0 THEN 1 ELSE 0 END AS is_down
FROM tp GROUP BY kind
""")
def q_liveness(spark, sf):
    return M.liveness(_points(spark, sf), NOW, 2)


@register("latest_point", f"""
WITH {TP}
SELECT kind, max(end_time) AS end_time, arg_max(source_count, end_time) AS source_count,
       coalesce(printf('%.3f', arg_max(count_per_millis, end_time)), '0') AS speed
FROM tp GROUP BY kind
""")
def q_latest_point(spark, sf):
    p = M.newest_point(P.read_newest(spark, _points_path(spark, sf)).drop("servers_count_map"))
    return p.select("kind", "end_time", "source_count", speed_text("count_per_millis").alias("speed"))


@register("latest_link_map", f"""
WITH {LP},
recent AS (SELECT * FROM lp WHERE kind = 'serversCountMap'
           AND strptime(end_time, '%Y-%m-%d %H:%M:%S') > TIMESTAMP '{NOW}' - INTERVAL 20 MINUTE
           AND strptime(end_time, '%Y-%m-%d %H:%M:%S') < TIMESTAMP '{NOW}')
SELECT end_time, server, n FROM recent WHERE end_time = (SELECT max(end_time) FROM recent)
""")
def q_latest_link(spark, sf):
    r = M.between_minutes(_links(spark, sf).filter(F.col("kind") == "serversCountMap"), NOW, 20)
    last = r.agg(F.max_by(F.struct("end_time", "value_map"), "end_time").alias("p"))
    return last.select("p.end_time", F.explode("p.value_map").alias("server", "n"))


@register("realtime_children", f"""
WITH {TP}
SELECT id, kind, end_time, s.server AS server, s.n AS n
FROM (SELECT id, kind, end_time, unnest(servers) AS s FROM tp
      WHERE strptime(end_time, '%Y-%m-%d %H:%M:%S') < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTE)
""")
def q_children(spark, sf):
    return M.children(_points(spark, sf), NOW, 30)


def _daily_identified(spark, sf):
    """Crawler addresses identified per day (distinct flagged IPs)."""
    from ..operators import scoring as S
    hot = S.flagged(_scored(spark, sf)).select(F.substring("window_start", 1, 10).alias("day"), "ip")
    return hot.groupBy("day").agg(F.countDistinct("ip").alias("n"))


_IDENT_SQL = f"""
{METRICS_CTE}, {FLOWS_CTE}, {SCORES_CTE},
ident AS (SELECT substr(window_start, 1, 10) AS day, count(DISTINCT ip) AS n
          FROM scores WHERE score > flow_limit GROUP BY ALL)
"""


@register("crawler_totals", f"""
WITH {_IDENT_SQL}
SELECT CAST(coalesce(max(CASE WHEN day = '{DAY}' THEN n END), 0) AS BIGINT) AS on_day,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS all_days FROM ident
""")
def q_crawler_totals(spark, sf):
    return M.crawler_totals(_daily_identified(spark, sf), DAY)


@register("current_day_panel", f"""
WITH {_IDENT_SQL}, {TP}
SELECT (SELECT CAST(coalesce(sum(source_count), 0) AS BIGINT) FROM tp
        WHERE kind = 'DP' AND substr(end_time, 1, 10) = '{DAY}') AS flow_today,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM ident WHERE day = '{DAY}') AS identified_today,
       (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM ident) AS identified_total
""")
def q_panel(spark, sf):
    return M.current_day_panel(_points(spark, sf), _daily_identified(spark, sf), DAY)


@register("server_view", f"""
WITH req AS ({requests_sql()}), {LP},
cnt AS (SELECT serverAddr AS server, count(*) AS n FROM req GROUP BY ALL),
act AS (SELECT server, n AS active FROM lp WHERE kind = 'activeNumMap'
        AND key = (SELECT max(key) FROM lp WHERE kind = 'activeNumMap'))
SELECT c.server, c.n, a.active FROM cnt c JOIN act a ON c.server = a.server
""")
def q_server_view(spark, sf):
    counts = logs(spark, sf).groupBy(F.col("serverAddr").alias("server")).agg(F.count(F.lit(1)).alias("n"))
    return M.server_view(counts, P.read_newest(spark, _links_path(spark, sf)))


@register("host_status", f"""
WITH h AS ({mf.HOST_SQL}), d AS ({mf.DISK_SQL}),
hl AS (SELECT host, arg_max(h, (ts, l_orderkey, l_linenumber)) AS r FROM h GROUP BY host),
dl AS (SELECT host, device, mount, arg_max(d, (ts, l_orderkey, l_linenumber)) AS r FROM d GROUP BY ALL),
dr AS (SELECT host, sum(r.fs_used) AS fs_used, sum(r.fs_total) AS fs_total FROM dl GROUP BY host)
SELECT hl.host, strftime(r.ts, '%Y-%m-%d %H:%M:%S') AS state_time,
       round_even((r.cpu_system_p + r.cpu_user_p) * 100, 2) AS cpu_rate,
       r.mem_actual_used_p * 100 AS memory_rate,
       CAST(CAST(trunc(r.mem_actual_used / 1000000) AS BIGINT) AS VARCHAR) || 'M/'
         || CAST(CAST(trunc(r.mem_total / 1000000) AS BIGINT) AS VARCHAR) || 'M' AS memory_info,
       round_even(dr.fs_used / dr.fs_total * 100, 2) AS disk_rate,
       CAST(CAST(trunc(dr.fs_used / 10000000) AS BIGINT) AS VARCHAR) || 'G/'
         || CAST(CAST(trunc(dr.fs_total / 10000000) AS BIGINT) AS VARCHAR) || 'G' AS disk_info
FROM hl LEFT JOIN dr ON hl.host = dr.host
""")
def q_host_status(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return M.host_status(mf.host_metrics(li), mf.disk_metrics(li))


@register("recent_hits", f"""
WITH h AS ({mf.HOST_SQL})
SELECT * FROM h WHERE ts >= TIMESTAMP '{HOST_NOW}' - INTERVAL 20 SECOND AND ts <= TIMESTAMP '{HOST_NOW}'
ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC LIMIT 10000
""")
def q_recent_hits(spark, sf):
    return M.recent_hits(mf.host_metrics(fx.table(spark, sf, "lineitem")), HOST_NOW, 20, 10000)


# ------------------------------------------------------------------ reports

@register("route_rank", f"""
WITH req AS ({requests_sql()}), bl AS ({fx.BLACKLIST_SQL})
SELECT depcity || '-' || arrcity AS route, count(*) AS frequency
FROM req r JOIN bl b ON r.remoteAddr = b.remoteAddr
WHERE NOT (b.flowID IS NULL OR lower(b.flowID) = 'null')
  AND substr(r.timeIso8601, 1, 10) BETWEEN '{RANGE[0]}' AND '{RANGE[1]}'
GROUP BY ALL
""")
def q_route_rank(spark, sf):
    """H3 + B33 + C7: crawled routes in a day range, most frequent first.

    Logs are reduced per (address, route, day) before the blacklist join,
    so a hot address costs one row per route and day.
    """
    lg = RP.day_range(logs(spark, sf), "timeIso8601", *RANGE)
    per = lg.groupBy("remoteAddr", "depcity", "arrcity").agg(F.count(F.lit(1)).alias("n"))
    bl = blacklist(spark, sf).select("remoteAddr", "flowID")
    j = per.join(bl, "remoteAddr", "inner").filter(~(F.col("flowID").isNull() | (F.lower("flowID") == "null")))
    out = j.groupBy(route_label("depcity", "arrcity").alias("route")).agg(F.sum("n").cast("long").alias("frequency"))
    return out.orderBy(F.col("frequency").desc(), "route")


def _occ(spark, sf, days: tuple[str, str] | None = None):
    """nh_illegal_occ_flight_rank rows derived from orders (rows of one
    day per group, so a day range can be applied to the orders first)."""
    o = fx.table(spark, sf, "orders")
    if days:
        o = RP.day_range(o, "o_orderdate", *days)
    ck = F.col("o_custkey")
    cities = F.array(*[F.lit(c) for c in CITIES])
    return (o.select(F.concat(F.lit("CZ"), (ck % 500 + 1000).cast("string")).alias("flight_code"),
                     F.element_at(cities, (ck % 11 + 1).cast("int")).alias("dep"),
                     F.element_at(cities, (ck % 13 + 1).cast("int")).alias("arr"),
                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_time"),
                     "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("space"))
            .groupBy("flight_code", "dep", "arr", "start_time")
            .agg(F.max("o_totalprice").alias("price"), F.min("space").alias("ship_space"),
                 F.count(F.lit(1)).alias("frequency")))


_OCC_SQL = f"""
occ AS (
  SELECT 'CZ' || CAST(o_custkey % 500 + 1000 AS VARCHAR) AS flight_code,
         {_list_sql(CITIES)}[o_custkey % 11 + 1] AS dep, {_list_sql(CITIES)}[o_custkey % 13 + 1] AS arr,
         strftime(o_orderdate, '%Y-%m-%d') AS start_time, max(o_totalprice) AS price,
         min(substr(o_orderpriority, 1, 1)) AS ship_space, count(*) AS frequency
  FROM orders GROUP BY ALL),
occ_r AS (SELECT * FROM occ WHERE start_time BETWEEN '{OCC_RANGE[0]}' AND '{OCC_RANGE[1]}')
"""


@register("occ_rank_page", f"""
WITH {_OCC_SQL}
SELECT flight_code, dep || '-' || arr AS route, start_time, price, ship_space, frequency FROM occ_r
ORDER BY frequency DESC, flight_code, dep, arr, start_time LIMIT {ROWS} OFFSET {(PAGE - 1) * ROWS}
""")
def q_occ_page(spark, sf):
    r = _occ(spark, sf, OCC_RANGE)
    p = RP.page(r, [F.col("frequency").desc(), F.col("flight_code"), F.col("dep"), F.col("arr"),
                    F.col("start_time")], PAGE, ROWS)
    return p.select("flight_code", route_label("dep", "arr").alias("route"), "start_time", "price",
                    "ship_space", "frequency")


@register("page_count", f"""
WITH {_OCC_SQL} SELECT count(*) AS n, CAST(ceil(count(*) / {ROWS}) AS BIGINT) AS pages FROM occ_r
""")
def q_page_count(spark, sf):
    return RP.page_count(_occ(spark, sf, OCC_RANGE), ROWS)


def _daily_flow_types(spark, sf):
    """nh_flow_info per day: type 0 all, 1 crawler, 2 normal requests."""
    t = ind.tagged_requests(logs(spark, sf), blacklist(spark, sf))
    per = t.groupBy("visitTime", "isSpider").agg(F.count(F.lit(1)).alias("n"))
    typed = per.select("visitTime", F.when(F.col("isSpider") == "1", 1).otherwise(2).alias("type"), "n")
    allt = per.groupBy("visitTime").agg(F.sum("n").alias("n")).select("visitTime", F.lit(0).alias("type"), "n")
    return typed.unionByName(allt).select(F.col("visitTime").alias("record_time"), "type",
                                          F.col("n").cast("long").alias("value"))


_FLOW_TYPES_SQL = """
ft AS (
  SELECT visitTime AS record_time, CASE WHEN isSpider = '1' THEN 1 ELSE 2 END AS type, count(*) AS value
  FROM tagged GROUP BY ALL
  UNION ALL SELECT visitTime, 0, count(*) FROM tagged GROUP BY ALL)
"""


@register("series_aligned", with_tagged(f"""
, {_FLOW_TYPES_SQL.strip()},
days AS (SELECT strftime(d, '%Y-%m-%d') AS day
         FROM range(DATE '{SPINE[0]}', DATE '{SPINE[1]}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d))
SELECT day, (SELECT value FROM ft WHERE record_time = day AND type = 0) AS "0",
       (SELECT value FROM ft WHERE record_time = day AND type = 1) AS "1",
       (SELECT value FROM ft WHERE record_time = day AND type = 2) AS "2"
FROM days
"""))
def q_series(spark, sf):
    return RP.align_to_calendar(_daily_flow_types(spark, sf), "record_time", "type", "value",
                                [0, 1, 2], *SPINE)


@register("flow_series_range", with_tagged(f"""
, {_FLOW_TYPES_SQL.strip()}
SELECT record_time, type, value FROM ft WHERE record_time >= '{RANGE[0]}' AND record_time <= '{RANGE[1]}'
"""))
def q_flow_range(spark, sf):
    """C6 + H7: inclusive time range over the flow table, in time order."""
    return RP.time_range(_daily_flow_types(spark, sf), "record_time", *RANGE).orderBy("record_time", "type")


def _accuracy(spark, sf):
    o = fx.table(spark, sf, "orders")
    return (o.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderpriority")
            .agg((F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("accuracy")))


@register("accuracy_series", """
WITH a AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority,
                  count(*) FILTER (WHERE o_orderstatus = 'F') / CAST(count(*) AS DOUBLE) AS accuracy
           FROM orders GROUP BY ALL)
SELECT day, """ + ", ".join(f"max(CASE WHEN o_orderpriority = '{p}' THEN accuracy END) AS \"{p}\""
                            for p in PRIORITIES) + """
FROM a GROUP BY day
""")
def q_accuracy(spark, sf):
    return RP.observed_pivot(_accuracy(spark, sf), "day", "o_orderpriority", "accuracy", PRIORITIES)


@register("funnel", with_tagged(f"""
SELECT 'query-to-passenger' AS stage, 0 AS flight_type, {sql_ratio('2', '1', 2)} * 100 AS percent
  FROM tagged WHERE flightType IN ('National')
UNION ALL SELECT 'passenger-to-payment', 0, {sql_ratio('3', '2', 2)} * 100 FROM tagged WHERE flightType IN ('National')
UNION ALL SELECT 'query-to-passenger', 1, {sql_ratio('2', '1', 2)} * 100
  FROM tagged WHERE flightType IN ('International', 'Internatinal')
UNION ALL SELECT 'passenger-to-payment', 1, {sql_ratio('3', '2', 2)} * 100
  FROM tagged WHERE flightType IN ('International', 'Internatinal')
"""))
def q_funnel(spark, sf):
    s = summary(spark, sf)
    conv = ind.conversion_by_flight(s, ind.NATIONAL, 0).unionByName(
        ind.conversion_by_flight(s, ind.INTERNATIONAL, 1))
    return RP.funnel(conv)


@register("conversion_by_day", with_tagged(f"""
SELECT visitTime AS record_time, 0 AS flight_type, {sql_ratio('2', '1', 2)} AS conversion_rate
FROM tagged WHERE flightType IN ('National') AND visitTime = '{DAY}' GROUP BY visitTime
"""))
def q_conv_day(spark, sf):
    """Daily national query->passenger rate, read for one day and code."""
    t = ind.tagged_requests(logs(spark, sf), blacklist(spark, sf)).filter(F.col("flightType") == "National")
    per = (t.groupBy("visitTime", "requestType").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("isSpider", F.lit("0")).withColumn("flightType", F.lit("National")))
    daily = (per.groupBy("visitTime").agg(
        F.round(F.try_divide(F.sum(F.when(F.col("requestType") == "2", F.col("n")).otherwise(0)).cast("double"),
                             F.sum(F.when(F.col("requestType") == "1", F.col("n")).otherwise(0)).cast("double")),
                2).alias("conversion_rate"))
        .select(F.col("visitTime").alias("record_time"), F.lit(0).alias("flight_type"), "conversion_rate"))
    return RP.day_and_code(daily, "record_time", "flight_type", DAY, 0)


@register("rule_monitor", f"""
SELECT strftime(ts, '%Y-%m-%d') AS x, count(*) AS y FROM events WHERE event_type = 'click' GROUP BY ALL
""")
def q_rule_monitor(spark, sf):
    """(time type, rule type) lookup ordered by time."""
    e = _ev(spark, sf)
    t = (e.groupBy(F.lit("day").alias("time_type"), F.col("event_type").alias("rule_type"),
                   F.date_format("ts", "yyyy-MM-dd").alias("x"))
         .agg(F.count(F.lit(1)).alias("y")))
    return RP.point_lookup(t, {"time_type": "day", "rule_type": "click"}, "x").select("x", "y")


def _analyze_rules(spark, sf):
    """analyzerule table derived from ``nation``: flags from key bits."""
    k = F.col("n_nationkey")
    n = fx.table(spark, sf, "nation")
    return n.select(
        F.concat(F.lit("A"), k.cast("string")).alias("id"),
        (k % 2).cast("int").alias("flight_type"), (F.col("n_regionkey") % 2).cast("int").alias("behavior_type"),
        ((k / 1).cast("int") % 2 == 1).alias("is_json"), ((k / 2).cast("int") % 2 == 1).alias("is_application_json"),
        ((k / 4).cast("int") % 2 == 1).alias("is_xml"), ((k / 8).cast("int") % 2 == 1).alias("is_text_xml"),
        ((k / 16).cast("int") % 2 == 1).alias("is_normal_form"), (k % 3 == 0).alias("is_normal_get"))


_FLAGS = {"is_json": 1, "is_application_json": 2, "is_xml": 4, "is_text_xml": 8, "is_normal_form": 16}


def _sql_flag(name: str) -> str:
    if name == "is_normal_get":
        return "(n_nationkey % 3 = 0)"
    return f"((n_nationkey // {_FLAGS[name]}) % 2 = 1)"


_KIND_SQL = " UNION ALL ".join(
    f"SELECT 'A' || CAST(n_nationkey AS VARCHAR) AS id, CAST(n_nationkey % 2 AS INTEGER) AS flight_type, "
    f"CAST(n_regionkey % 2 AS INTEGER) AS behavior_type, {k} AS kind FROM nation WHERE "
    + " AND ".join(f"{_sql_flag(f)} = {str(v).lower()}" for f, v in RP.PAYLOAD_KINDS[k].items())
    for k in RP.PAYLOAD_KINDS)


@register("parse_rule_lookup", _KIND_SQL)
def q_parse_rules(spark, sf):
    return RP.parse_rule_lookup(_analyze_rules(spark, sf)).select("id", "flight_type", "behavior_type", "kind")
