"""Registered queries: window metrics, rule config and flow scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators import scoring as S
from ..operators import windows as W
from . import fixtures as fx
from .registry import logs, raw_log, register
from .fixtures import RULE_NAMES, _list_sql, requests_sql
from .sqlparts import sql_full_match

# Window length of the registered queries: the test events are spread
# over 30 days (~2 per address per day), so day windows carry real work.
DAY = 86400


def _metrics(spark, sf):
    return W.ip_window_metrics(logs(spark, sf), fx.CRITICAL_PAGES, DAY)


def _flows(spark, sf):
    return fx.flow_config(spark, sf)


def _scored(spark, sf):
    return S.score_flows(_metrics(spark, sf), R.collect_flows(_flows(spark, sf)))


def sql_event_time(t: str) -> str:
    return (f"CASE WHEN strpos({t}, '+') > 0 AND {t} <> '0' THEN try_cast(substr(replace("
            f"substr({t}, 1, strpos({t}, '+') - 1), 'T', ' '), 1, 19) AS TIMESTAMP) END")


def sql_win(ts: str, seconds: int) -> str:
    return f"time_bucket(INTERVAL '{seconds} seconds', {ts}, TIMESTAMP '1970-01-01')"


def sql_fmt(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


METRICS_CTE = f"""
req AS ({requests_sql()}),
base AS (
  SELECT remoteAddr AS ip, {sql_full_match('request', fx.CRITICAL_PAGES)} AS crit,
         httpUserAgent AS ua, depcity, arrcity, JSESSIONID AS cookie,
         {sql_event_time('timeIso8601')} AS ts
  FROM req),
b2 AS (SELECT *, {sql_win('ts', DAY)} AS win FROM base WHERE ts IS NOT NULL),
g AS (
  SELECT win, ip, count(*) AS ip_visits, count(*) FILTER (WHERE crit) AS critical_visits,
         count(DISTINCT ua) AS distinct_ua, count(DISTINCT depcity || '|' || arrcity) AS distinct_trips,
         count(DISTINCT cookie) FILTER (WHERE crit) AS critical_cookies,
         list(ts ORDER BY ts) FILTER (WHERE crit) AS tl
  FROM b2 GROUP BY win, ip),
g2 AS (
  SELECT *, list_transform(range(1, coalesce(len(tl), 0)),
              lambda i: CAST(epoch(tl[i + 1]) - epoch(tl[i]) AS BIGINT)) AS gaps
  FROM g),
metrics AS (
  SELECT {sql_fmt('win')} AS window_start, ip, ip_visits, critical_visits, distinct_ua,
         CAST(list_min(gaps) AS INTEGER) AS min_critical_gap,
         CAST(len(list_filter(gaps, lambda x: x < 10)) AS BIGINT) AS gaps_under_10s,
         distinct_trips, critical_cookies
  FROM g2)
"""

FLOWS_CTE = f"""
flows AS (
  SELECT 'P' || CAST(r_regionkey AS VARCHAR) AS flow_id, r_name AS flow_name,
         CAST(10 AS DOUBLE) + CAST(r_regionkey AS DOUBLE) * 5 AS flow_limit
  FROM region WHERE r_regionkey <> 4),
rules AS (
  SELECT 'R' || CAST(n_nationkey AS VARCHAR) AS rule_id, 'P' || CAST(n_regionkey AS VARCHAR) AS flow_id,
         CAST(n_nationkey AS INTEGER) AS rule_order, {_list_sql(RULE_NAMES)}[n_nationkey % 7 + 1] AS rule_name,
         CASE WHEN n_nationkey % 4 = 1 THEN 1 ELSE 0 END AS status,
         CAST(n_nationkey % 3 AS DOUBLE) AS arg0, CAST(n_nationkey % 2 AS DOUBLE) AS arg1,
         1 + n_nationkey % 9 AS score
  FROM nation WHERE n_nationkey % 8 <> 7)
"""

SCORES_CTE = """
per AS (
  SELECT m.window_start, m.ip, r.flow_id, r.rule_order, r.rule_id, r.status,
         coalesce(CAST(CASE r.rule_name WHEN 'ip' THEN m.ip_visits WHEN 'criticalPages' THEN m.critical_visits
              WHEN 'userAgent' THEN m.distinct_ua WHEN 'criticalPagesAccTime' THEN m.min_critical_gap
              WHEN 'criticalPagesLessThanDefault' THEN m.gaps_under_10s WHEN 'flightQuery' THEN m.distinct_trips
              WHEN 'criticalCookies' THEN m.critical_cookies END AS DOUBLE), 0.0)
         > CASE WHEN r.rule_name = 'criticalPagesLessThanDefault' THEN r.arg1 ELSE r.arg0 END AS hit,
         r.score
  FROM metrics m, rules r),
per2 AS (SELECT *, CASE WHEN hit THEN CAST(score AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS s FROM per),
agg AS (
  SELECT window_start, ip, flow_id, sum(s) AS total, count(*) AS n,
         coalesce(max(s) FILTER (WHERE status = 0), 0.0) AS max_en,
         coalesce(sum(s) FILTER (WHERE status = 0), 0.0) AS sum_en,
         coalesce(string_agg(rule_id, ',' ORDER BY rule_order) FILTER (WHERE hit), '') AS hit_rules
  FROM per2 GROUP BY window_start, ip, flow_id),
scores AS (
  SELECT a.window_start, a.ip, a.flow_id,
         CASE WHEN n = 0 OR total = 0 THEN CAST(0 AS DOUBLE)
              ELSE (total / (10 * n)) * (
                   CASE WHEN CAST(1 AS DOUBLE) < (CAST(1 AS DOUBLE) / 6) * max_en THEN CAST(60 AS DOUBLE)
                        ELSE (CAST(1 AS DOUBLE) / 6) * max_en * 60 END
                   + 40 * (sum_en / total)) END AS score,
         f.flow_limit, a.hit_rules
  FROM agg a JOIN flows f ON a.flow_id = f.flow_id)
"""


@register("ip_window_metrics", f"WITH {METRICS_CTE} SELECT * FROM metrics")
def q_metrics(spark, sf):
    return _metrics(spark, sf)


@register("flow_config", f"""
WITH {FLOWS_CTE}
SELECT f.flow_id, f.flow_name, f.flow_limit, count(r.rule_id) AS n_rules,
       coalesce(string_agg(r.rule_id || ':' || r.rule_name, ',' ORDER BY r.rule_order), '') AS rules
FROM flows f LEFT JOIN rules r ON f.flow_id = r.flow_id
GROUP BY f.flow_id, f.flow_name, f.flow_limit
""")
def q_flow_config(spark, sf):
    f = _flows(spark, sf)
    return f.select("flow_id", "flow_name", "flow_limit", F.size("rules").cast("long").alias("n_rules"),
                    F.array_join(F.transform("rules", lambda r: F.concat_ws(":", r["rule_id"], r["rule_name"])),
                                 ",").alias("rules"))


@register("flow_scores", f"""
WITH {METRICS_CTE}, {FLOWS_CTE}, {SCORES_CTE}
SELECT window_start, ip, flow_id, score, flow_limit, score > flow_limit AS is_up_limited, hit_rules
FROM scores
""")
def q_flow_scores(spark, sf):
    sc = _scored(spark, sf).select("window_start", "ip", F.explode("flows_score").alias("f"))
    return sc.select("window_start", "ip", "f.flow_id", "f.score", "f.flow_limit", "f.is_up_limited",
                     F.array_join("f.hit_rules", ",").alias("hit_rules"))


@register("blacklist_rows", f"""
WITH {METRICS_CTE}, {FLOWS_CTE}, {SCORES_CTE},
hot AS (SELECT DISTINCT window_start, ip FROM scores WHERE score > flow_limit)
SELECT s.ip || '#' || s.flow_id AS key, s.ip, s.flow_id, s.score, s.hit_rules, s.window_start AS rule_time,
       s.score > s.flow_limit AS is_up_limited
FROM scores s JOIN hot h ON s.window_start = h.window_start AND s.ip = h.ip
""")
def q_blacklist_rows(spark, sf):
    return S.blacklist_entries(S.flatten_flows(_scored(spark, sf))).drop("value")


@register("method_window_counts", f"""
WITH req AS ({requests_sql()}),
b AS (SELECT remoteAddr AS ip, requestMethod AS method, {sql_event_time('timeIso8601')} AS ts FROM req)
SELECT {sql_fmt(sql_win('ts', DAY))} AS window_start, ip, method, count(*) AS n
FROM b WHERE ts IS NOT NULL GROUP BY ALL
""")
def q_method_counts(spark, sf):
    return W.method_window_counts(logs(spark, sf), DAY)


def _raw(spark, sf):
    return raw_log(spark, sf)


RAW_FIELDS_CTE = f"""
raw AS ({fx.RAW_LINES_SQL}),
rf AS (
  SELECT string_split(value, '#CS#') AS arr FROM raw),
rf2 AS (
  SELECT {sql_event_time('arr[9]')} AS ts, coalesce(arr[10], '') AS server,
         try_cast(arr[12] AS INTEGER) AS active FROM rf)
"""


@register("link_traffic", f"""
WITH {RAW_FIELDS_CTE}
SELECT {sql_fmt(sql_win('ts', DAY))} AS window_start, server, count(*) AS n
FROM rf2 WHERE ts IS NOT NULL GROUP BY ALL
""")
def q_link_traffic(spark, sf):
    return W.link_traffic(_raw(spark, sf), DAY)


@register("active_latest", f"""
WITH {RAW_FIELDS_CTE}
SELECT {sql_fmt(sql_win('ts', DAY))} AS window_start, server, arg_max(active, (ts, active)) AS active
FROM rf2 WHERE ts IS NOT NULL AND active IS NOT NULL GROUP BY ALL
""")
def q_active_latest(spark, sf):
    return W.active_latest(_raw(spark, sf), DAY)


@register("server_three_day", f"""
WITH req AS ({requests_sql()}),
d AS (SELECT serverAddr AS server, substr(timeIso8601, 1, 10) AS day, count(*) AS n FROM req GROUP BY ALL)
SELECT a.server, a.day, a.n AS today,
       coalesce((SELECT sum(b.n) FROM d b WHERE b.server = a.server
                 AND CAST(b.day AS DATE) = CAST(a.day AS DATE) - 1), 0)::BIGINT AS yesterday,
       coalesce((SELECT sum(b.n) FROM d b WHERE b.server = a.server
                 AND CAST(b.day AS DATE) = CAST(a.day AS DATE) - 2), 0)::BIGINT AS before_yesterday,
       (SELECT sum(b.n) FROM d b WHERE b.server = a.server
                 AND CAST(b.day AS DATE) BETWEEN CAST(a.day AS DATE) - 2 AND CAST(a.day AS DATE))::BIGINT
         AS last_three_days
FROM d a
""")
def q_three_day(spark, sf):
    return W.server_three_day(W.server_daily_counts(logs(spark, sf)))


@register("flow_model_list", """
SELECT n_nationkey AS flow_num, n_name AS flow_name, r_regionkey AS model_id, r_name AS model_name
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def q_flow_model(spark, sf):
    return R.flow_model_list(fx.table(spark, sf, "nation"), fx.table(spark, sf, "region"))


@register("flow_directory", """
SELECT CAST(r_regionkey AS INTEGER) AS process_num, 'P' || CAST(r_regionkey AS VARCHAR) AS id,
       r_name AS process_name, CASE WHEN r_regionkey = 4 THEN 1 ELSE 0 END AS status
FROM region
""")
def q_flow_dir(spark, sf):
    return R.flow_directory(fx.process_table(fx.table(spark, sf, "region")))
