"""Monitoring inputs derived from the driver tables.

* throughput points (``realtime_comput_data``): one per kind and hour,
  built from ``events`` (kinds DP = all, QUERY = views, BOOK = clicks);
* link points (``{"serversCountMap": ...}`` / ``{"activeNumMap": ...}``):
  one per hour from the raw access lines (G3 / G4 over hour windows);
* host metrics (system and per-mount disk samples) from ``lineitem``.

Each exists as a DataFrame plan and as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import windows as W
from .fixtures import RAW_LINES_SQL, raw_lines, requests_sql

HOUR = 3600


def _fmt(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def throughput_points(events: DataFrame) -> DataFrame:
    """M14 points: id, kind, end_time, source_count, cost_time,
    count_per_millis and the per-server count map."""
    et = F.col("event_type")
    kinds = F.filter(F.array(F.lit("DP"), F.when(et == "view", "QUERY"), F.when(et == "click", "BOOK")),
                     lambda k: k.isNotNull())
    e = events.select(F.explode(kinds).alias("kind"),
                      F.window("ts", f"{HOUR} seconds").end.alias("end"),
                      F.concat(F.lit("192.168.0."), (F.col("user_id") % 8).cast("string")).alias("server"))
    per_server = e.groupBy("kind", "end", "server").agg(F.count(F.lit(1)).alias("n"))
    pts = per_server.groupBy("kind", "end").agg(
        F.sum("n").alias("source_count"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("server", "n")))).alias("servers_count_map"))
    cost = F.col("source_count") * 7 + 100
    return pts.select(
        F.concat_ws("#", "kind", _fmt(F.col("end"))).alias("id"), "kind",
        _fmt(F.col("end")).alias("end_time"), F.col("source_count").cast("long").alias("source_count"),
        cost.cast("long").alias("cost_time"),
        (F.col("source_count") / cost).alias("count_per_millis"), "servers_count_map")


THROUGHPUT_SQL = f"""
SELECT kind || '#' || strftime(e, '%Y-%m-%d %H:%M:%S') AS id, kind,
       strftime(e, '%Y-%m-%d %H:%M:%S') AS end_time, CAST(source_count AS BIGINT) AS source_count,
       CAST(source_count * 7 + 100 AS BIGINT) AS cost_time,
       source_count / CAST(source_count * 7 + 100 AS DOUBLE) AS count_per_millis, servers
FROM (
  SELECT kind, e, sum(n) AS source_count, list(struct_pack(server := server, n := n) ORDER BY server) AS servers
  FROM (
    SELECT kind, e, server, count(*) AS n FROM (
      SELECT unnest(list_filter(['DP', CASE WHEN event_type = 'view' THEN 'QUERY' END,
                                 CASE WHEN event_type = 'click' THEN 'BOOK' END], lambda k: k IS NOT NULL)) AS kind,
             time_bucket(INTERVAL '{HOUR} seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '{HOUR} seconds' AS e,
             '192.168.0.' || CAST(user_id % 8 AS VARCHAR) AS server
      FROM events) GROUP BY ALL)
  GROUP BY kind, e)
"""


def link_points(events: DataFrame) -> DataFrame:
    """M13 points: kind, key, end_time, server -> value map, JSON text."""
    raw = raw_lines(events)
    traffic = W.link_traffic(raw, HOUR).withColumn("kind", F.lit("serversCountMap"))
    active = W.active_latest(raw, HOUR).withColumnRenamed("active", "n").withColumn("kind", F.lit("activeNumMap"))
    both = traffic.unionByName(active)
    pts = both.groupBy("kind", "window_start").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("server", F.col("n").cast("int"))))).alias("m"))
    end = _fmt(F.to_timestamp_ntz(F.col("window_start")) + F.make_interval(secs=F.lit(HOUR)))
    return pts.select(
        "kind", F.concat_ws("#", "kind", end).alias("key"), end.alias("end_time"),
        F.col("m").alias("value_map"),
        F.to_json(F.create_map(F.col("kind"), F.col("m"))).alias("value"))


LINK_POINTS_SQL = f"""
SELECT kind, kind || '#' || end_time AS key, end_time, server, n FROM (
  SELECT 'serversCountMap' AS kind, strftime(w + INTERVAL '{HOUR} seconds', '%Y-%m-%d %H:%M:%S') AS end_time,
         server, CAST(count(*) AS INTEGER) AS n
  FROM lf GROUP BY ALL
  UNION ALL
  SELECT 'activeNumMap', strftime(w + INTERVAL '{HOUR} seconds', '%Y-%m-%d %H:%M:%S'), server,
         CAST(arg_max(active, (ts, active)) AS INTEGER)
  FROM lf WHERE active IS NOT NULL GROUP BY ALL)
"""


def link_fields_sql() -> str:
    from .queries_scoring import sql_event_time
    return f"""
lr AS ({RAW_LINES_SQL}),
la AS (SELECT string_split(value, '#CS#') AS arr FROM lr),
lf0 AS (SELECT {sql_event_time('arr[9]')} AS ts, coalesce(arr[10], '') AS server,
               try_cast(arr[12] AS INTEGER) AS active FROM la),
lf AS (SELECT *, time_bucket(INTERVAL '{HOUR} seconds', ts, TIMESTAMP '1970-01-01') AS w
       FROM lf0 WHERE ts IS NOT NULL)
"""


def host_metrics(lineitem: DataFrame) -> DataFrame:
    """System samples: host, ts, cpu (system / user share), memory."""
    li = lineitem
    return li.select(
        F.concat(F.lit("host-"), (F.col("l_suppkey") % 10).cast("string")).alias("host"),
        (F.col("l_shipdate") + F.make_interval(mins=F.col("l_linenumber").cast("int"))).alias("ts"),
        "l_orderkey", "l_linenumber",
        F.col("l_discount").alias("cpu_system_p"), F.col("l_tax").alias("cpu_user_p"),
        (F.col("l_extendedprice") * 1000000).cast("long").alias("mem_actual_used"),
        (F.col("l_extendedprice") / 64000).alias("mem_actual_used_p"),
        F.lit(64000000000).cast("long").alias("mem_total"))


def disk_metrics(lineitem: DataFrame) -> DataFrame:
    """Disk samples: host, device, mount, ts, used and total bytes."""
    li = lineitem
    k = F.col("l_linenumber") % 3
    return li.select(
        F.concat(F.lit("host-"), (F.col("l_suppkey") % 10).cast("string")).alias("host"),
        F.concat(F.lit("sd"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (k + 1).cast("int"))).alias("device"),
        F.concat(F.lit("/data"), k.cast("string")).alias("mount"),
        (F.col("l_shipdate") + F.make_interval(mins=F.col("l_linenumber").cast("int"))).alias("ts"),
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") * 100000000).cast("long").alias("fs_used"),
        (F.col("l_extendedprice") * 10000000).cast("long").alias("fs_total"))


HOST_SQL = """
SELECT 'host-' || CAST(l_suppkey % 10 AS VARCHAR) AS host,
       l_shipdate + to_minutes(CAST(l_linenumber AS BIGINT)) AS ts, l_orderkey, l_linenumber,
       l_discount AS cpu_system_p, l_tax AS cpu_user_p,
       CAST(trunc(l_extendedprice * 1000000) AS BIGINT) AS mem_actual_used, l_extendedprice / 64000 AS mem_actual_used_p, CAST(64000000000 AS BIGINT) AS mem_total
FROM lineitem
"""

DISK_SQL = """
SELECT 'host-' || CAST(l_suppkey % 10 AS VARCHAR) AS host,
       'sd' || ['a', 'b', 'c'][l_linenumber % 3 + 1] AS device, '/data' || CAST(l_linenumber % 3 AS VARCHAR) AS mount,
       l_shipdate + to_minutes(CAST(l_linenumber AS BIGINT)) AS ts, l_orderkey, l_linenumber,
       CAST(trunc(l_quantity * 100000000) AS BIGINT) AS fs_used,
       CAST(trunc(l_extendedprice * 10000000) AS BIGINT) AS fs_total
FROM lineitem
"""

__all__ = ["throughput_points", "link_points", "host_metrics", "disk_metrics", "THROUGHPUT_SQL",
           "LINK_POINTS_SQL", "HOST_SQL", "DISK_SQL", "requests_sql"]
