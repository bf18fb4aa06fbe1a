"""Registered queries: XML / form-JSON parse branches, whole-day reads and
key unions (B9, B11, B17, B18, B20, C11, U2).

Payloads are built from ``orders`` and parsed back by the operators; the
oracles compute the expected fields straight from the order columns, so
each check is a round trip ``parse(build(order)) == order``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.xml import segtype_travel, xml_flat_map
from ..operators import etl as E
from ..operators import monitor as M
from . import fixtures as fx
from . import monitor_fixtures as mf
from .fixtures import CITIES, _list_sql
from .queries_monitor import _links, _points
from .registry import raw_log, register

# Parse rules of the order payloads.
XML_QUERY_RULE = E.ParseRule("QX", "POST", 0, ".*", text_xml=True, is_xml=True, query={
    "depCity": "/page/dep", "arrCity": "/page/arr", "flightDate": "/page/date", "adultNum": "/page/adult"})
XML_BOOK_RULE = E.ParseRule("BX", "POST", 1, ".*", flight_type=0, text_xml=True, is_xml=True, book={
    "bookUnUserId": "/page/guest", "psgName": "/page/psg/name", "psgType": "/page/psg/type", "idCard": "/page/psg/id", "contractName": "/page/contact",
    "contractPhone": "/page/phone", "depCity": "/page/dep", "arrCity": "/page/arr", "flightDate": "/page/date"})
FORM_JSON_RULE = E.ParseRule("QF", "POST", 0, ".*", is_json=True, form_field="json", query={
    "depCity": "$.dep", "arrCity": "$.arr", "flightDate": "$..date", "adultNum": "$..adult"})
FLAT_PATHS = {"name": "/page/psg/name", "id": "/page/psg/id", "n": "/page/n", "n1": "/page/m"}
# Passengers and contact at their depth in a booking JSON; the same paths for a JSON body and for one in a form field.
JSON_BOOK_PATHS = {"bookUserId": "$.user", "psgFirName": "$..fir", "psgName": "$.order.psgs..name", "idType": "$..doc.type",
                   "idCard": "$..id", "contractName": "$.order.contact.name", "contractPhone": "$..phone",
                   "depCity": "$..dep", "arrCity": "$.trip.arr", "flightDate": "$..date"}
JSON_BOOK_RULES = [
    E.ParseRule("BJ", "POST", 1, "^/json/.*$", flight_type=0, application_json=True, is_json=True, book=JSON_BOOK_PATHS),
    E.ParseRule("BF", "POST", 1, "^/form/.*$", flight_type=1, is_json=True, form_field="json", book=JSON_BOOK_PATHS)]
DAYS = ("2024-01-10", "2024-01-12")


def _orders(spark, sf) -> DataFrame:
    # Building and parsing a payload is all the work: narrow rows are dealt out first, however few blocks hold the table.
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate").hint("rebalance")
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    cities = F.array(*[F.lit(c) for c in CITIES])
    s = lambda c: c.cast("string")
    return o.select(
        "o_orderkey", "o_custkey",
        F.element_at(cities, (ck % 11 + 1).cast("int")).alias("dep"),
        F.element_at(cities, (ck % 13 + 1).cast("int")).alias("arr"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        s(ok % 3 + 1).alias("adult"),
        F.when(ok % 2 == 0, "S").otherwise("R").alias("seg"),
        F.concat(F.lit("1101"), F.lpad(s(ok), 14, "0")).alias("id1"),
        F.concat(F.lit("2202"), F.lpad(s(ok), 14, "0")).alias("id2"),
        F.concat(F.lit("139"), F.lpad(s(ok % 100000000), 8, "0")).alias("phone"))


def _xml(o: DataFrame) -> DataFrame:
    """Bodies of one page each, but for four in eleven: no page, text after
    it, cut off, and a bare ampersand.  One in eleven has nodes whose
    numbered keys clash."""
    c, s = F.col, lambda x: F.col(x).cast("string")
    xml = F.concat(
        F.lit("xml=<page><SEGTYPE>"), c("seg"), F.lit("</SEGTYPE><dep>"), c("dep"), F.lit("</dep><arr>"),
        c("arr"), F.lit("</arr><date>"), c("date"), F.lit("</date><adult>"), c("adult"),
        F.lit("</adult><guest>G"), s("o_orderkey"), F.lit("</guest><psg><name>P"), s("o_custkey"),
        F.lit("A</name><type>ADT</type><id>"), c("id1"),
        F.lit("</id></psg><psg><name>P"), s("o_custkey"), F.lit("B</name><type>CHD</type><id>"), c("id2"),
        F.lit("</id></psg><contact>C"), s("o_custkey"), F.lit("|x</contact><phone>"), c("phone"),
        F.lit("/1</phone></page>"))
    nodes = "".join(f"<n>v{i}</n>" for i in range(11)) + "<m>last</m></page>"
    kind = F.col("o_orderkey") % 11
    body = (F.when(kind == 0, F.replace(xml, F.lit("page>"), F.lit("pg>"))).when(kind == 1, F.concat(xml, F.lit("tail")))
            .when(kind == 2, F.substring(xml, F.lit(1), F.length(xml) - 20))
            .when(kind == 3, F.replace(xml, F.lit("<dep>"), F.lit("<dep>&")))
            .when(kind == 4, F.replace(xml, F.lit("</page>"), F.lit(nodes))).otherwise(xml))
    return o.select("*", body.alias("body"))


_ORDERS_SQL = f"""
o AS (SELECT o_orderkey, o_custkey, {_list_sql(CITIES)}[o_custkey % 11 + 1] AS dep,
             {_list_sql(CITIES)}[o_custkey % 13 + 1] AS arr, strftime(o_orderdate, '%Y-%m-%d') AS date,
             CAST(o_orderkey % 3 + 1 AS VARCHAR) AS adult,
             '1101' || lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS id1,
             '2202' || lpad(CAST(o_orderkey AS VARCHAR), 14, '0') AS id2,
             '139' || lpad(CAST(o_orderkey % 100000000 AS VARCHAR), 8, '0') AS phone, o_orderkey % 11 > 3 AS ok
      FROM orders)
"""


def _parse_query(df: DataFrame, rule: E.ParseRule, ctype: str) -> DataFrame:
    url, body, ct, method = F.lit("/q"), F.col("body"), F.lit(ctype), F.lit("POST")
    src = E.query_source(rule, url, body, ct)
    staged = df.select("o_orderkey", E.last_match([rule], method, F.lit(rule.behavior_type), url).alias("__i"),
                       src.alias("__src"))
    q = E.query_request([rule], F.col("__i"), [F.col("__src")], F.lit(0), F.lit(-1))
    return staged.select("o_orderkey", q.alias("q")).select(
        "o_orderkey", "q.isEmpty", "q.depCity", "q.arrCity", "q.flightDate", "q.adultNum")


@register("xml_query_parse", f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey, NOT ok AS isEmpty, CASE WHEN ok THEN dep ELSE '' END AS depCity, CASE WHEN ok THEN arr ELSE '' END AS arrCity,
       CASE WHEN ok THEN date ELSE '' END AS flightDate, CASE WHEN ok THEN adult ELSE '' END AS adultNum FROM o
""")
def q_xml_query(spark, sf):
    """Query fields by rule XPath from a text/xml body."""
    return _parse_query(_xml(_orders(spark, sf)), XML_QUERY_RULE, "text/xml")


@register("form_json_query", f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey, false AS isEmpty, dep AS depCity, arr AS arrCity, date AS flightDate, adult AS adultNum FROM o
""")
def q_form_json(spark, sf):
    """B9 + B12: JSON carried in a URL-encoded form field."""
    o = _orders(spark, sf)
    js = F.to_json(F.struct(F.col("dep"), F.col("arr"), F.struct(F.array(F.struct(F.col("date"), F.struct("adult").alias("who")))
                                                                 .alias("legs")).alias("trip")))
    body = o.select("*", F.concat(F.lit("other=1&json="), F.url_encode(js)).alias("body"))
    return _parse_query(body, FORM_JSON_RULE, "application/x-www-form-urlencoded")


def _if_ok(sql: str, name: str, other: str = "''") -> str:
    return f"CASE WHEN ok THEN {sql} ELSE {other} END AS {name}"


@register("xml_book_parse", f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey, {_if_ok("'P' || CAST(o_custkey AS VARCHAR) || 'A,P' || CAST(o_custkey AS VARCHAR) || 'B'", "psgName")},
       {_if_ok("'ADT,CHD'", "psgType")}, {_if_ok("'G' || CAST(o_orderkey AS VARCHAR)", "bookUnUserId")},
       {_if_ok("upper(md5(id1)) || ',' || upper(md5(id2))", "idCard")},
       {_if_ok("'C' || CAST(o_custkey AS VARCHAR)", "contractName")},
       {_if_ok("upper(md5(phone))", "contractPhone", "upper(md5(''))")},
       {_if_ok("dep", "depCity")}, {_if_ok("arr", "arrCity")}, {_if_ok("date", "flightDate")}, 0 AS flightType
FROM o
""")
def q_xml_book(spark, sf):
    """B17 + B26: booking lists by multi-node XPath; contact name before
    '|', phone before '/', id cards and phone hashed.  A body without one
    well-formed page gives an empty record."""
    o = _xml(_orders(spark, sf))
    url, method, ct = F.lit("/b"), F.lit("POST"), F.lit("text/xml")
    staged = o.select("o_orderkey", E.last_match([XML_BOOK_RULE], method, F.lit(1), url).alias("__i"),
                      E.book_source(XML_BOOK_RULE, F.col("body"), ct).alias("__src"))
    b = E.book_request([XML_BOOK_RULE], F.col("__i"), [F.col("__src")], F.lit(-1))
    return _flat_booking(staged.select("o_orderkey", b.alias("b"))).drop("idType", "bookUserId")


def _flat_booking(r: DataFrame) -> DataFrame:
    return r.select("o_orderkey", "b.bookUserId", "b.bookUnUserId", F.array_join("b.psgName", ",").alias("psgName"),
                    F.array_join("b.psgType", ",").alias("psgType"), F.array_join("b.idType", ",").alias("idType"),
                    F.array_join("b.idCard", ",").alias("idCard"), F.col("b.contractName").alias("contractName"),
                    F.col("b.contractPhone").alias("contractPhone"),
                    F.array_join("b.depCity", "").alias("depCity"), F.array_join("b.arrCity", "").alias("arrCity"),
                    F.array_join("b.flightDate", "").alias("flightDate"), F.col("b.flightType").alias("flightType"))


@register("book_json_parse", f"""
WITH {_ORDERS_SQL}, two AS (SELECT *, o_orderkey % 3 <> 0 AS pair FROM o)
SELECT o_orderkey, 'U' || CAST(o_custkey AS VARCHAR) AS bookUserId,
       'LiP' || CAST(o_custkey AS VARCHAR) || CASE WHEN pair THEN ',WangQ' || CAST(o_custkey AS VARCHAR) ELSE '' END AS psgName,
       'ID' || CASE WHEN pair THEN ',PP' ELSE '' END AS idType,
       upper(md5(id1)) || CASE WHEN pair THEN ',' || upper(md5(id2)) ELSE '' END AS idCard,
       'C "' || CAST(o_custkey AS VARCHAR) || '"' AS contractName, upper(md5(phone)) AS contractPhone,
       dep AS depCity, arr AS arrCity, date AS flightDate, CAST(o_orderkey % 2 AS INTEGER) AS flightType
FROM two
""")
def q_book_json(spark, sf):
    """B15 + B16: booking JSON as a body or in a form field (in one pair of
    brackets), lists by recursive descent, one or two passengers."""
    o = _orders(spark, sf)
    ck = F.col("o_custkey").cast("string")

    def passenger(first: str, letter: str, kind: str, number: str):
        return F.struct(F.lit(first).alias("fir"), F.concat(F.lit(letter), ck).alias("name"),
                        F.struct(F.lit(kind).alias("type"), F.col(number).alias("id")).alias("doc"))

    one, two = passenger("Li", "P", "ID", "id1"), passenger("Wang", "Q", "PP", "id2")
    js = F.to_json(F.struct(
        F.concat(F.lit("U"), ck).alias("user"),
        F.struct(F.when(F.col("o_orderkey") % 3 == 0, F.array(one)).otherwise(F.array(one, two)).alias("psgs"),
                 F.struct(F.concat(F.lit('C "'), ck, F.lit('"')).alias("name"), "phone").alias("contact")).alias("order"),
        F.struct("dep", "arr", F.array("date").alias("dates"), F.struct("date").alias("leg")).alias("trip")))
    form = F.concat(F.lit("a=1&json="), F.url_encode(F.concat(F.lit("["), js, F.lit("]"))))
    odd = F.col("o_orderkey") % 2 == 1
    o = o.select("o_orderkey", F.when(odd, form).otherwise(js).alias("body"),
                 F.when(odd, "/form/x").otherwise("/json/x").alias("url"),
                 F.when(odd, "application/x-www-form-urlencoded").otherwise("application/json").alias("ct"))
    staged = o.select("o_orderkey", E.last_match(JSON_BOOK_RULES, F.lit("post"), F.lit(1), F.col("url")).alias("__i"),
                      *[E.book_source(r, F.col("body"), F.col("ct")).alias(f"__s{i}") for i, r in enumerate(JSON_BOOK_RULES)])
    b = E.book_request(JSON_BOOK_RULES, F.col("__i"), [F.col("__s0"), F.col("__s1")], F.lit(-1))
    return _flat_booking(staged.select("o_orderkey", b.alias("b"))).drop("bookUnUserId", "psgType")


@register("xml_flat_map", f"""
WITH {_ORDERS_SQL}
SELECT o_orderkey, 'name0' AS key, 'P' || CAST(o_custkey AS VARCHAR) || 'A' AS value FROM o WHERE ok
UNION ALL SELECT o_orderkey, 'name1', 'P' || CAST(o_custkey AS VARCHAR) || 'B' FROM o WHERE ok
UNION ALL SELECT o_orderkey, 'id0', id1 FROM o WHERE ok
UNION ALL SELECT o_orderkey, 'id1', id2 FROM o WHERE ok
UNION ALL SELECT o_orderkey, 'n' || i, CASE WHEN i = 10 THEN 'last' ELSE 'v' || i END
          FROM o, range(11) t(i) WHERE o_orderkey % 11 = 4
""")
def q_xml_flat(spark, sf):
    """Several XPaths flattened into one ``key<i> -> value`` map; the
    eleventh ``n`` and the first ``n1`` share a key, and the last wins."""
    o = _xml(_orders(spark, sf))
    return o.select("o_orderkey", F.explode(xml_flat_map("body", FLAT_PATHS)).alias("key", "value"))


@register("xml_travel_type", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 IN (0, 2, 3) THEN 'Unknown'
                        WHEN o_orderkey % 2 = 0 THEN 'OneWay' ELSE 'RoundTrip' END AS travel_type FROM orders
""")
def q_xml_travel(spark, sf):
    """SEGTYPE S / R -> OneWay / RoundTrip."""
    return _xml(_orders(spark, sf)).select("o_orderkey", segtype_travel("body").alias("travel_type"))


@register("whole_day_points", f"""
WITH tp AS ({mf.THROUGHPUT_SQL})
SELECT id, kind, end_time, source_count FROM tp
WHERE strptime(end_time, '%Y-%m-%d %H:%M:%S') >= TIMESTAMP '{DAYS[0]} 00:00:00'
  AND strptime(end_time, '%Y-%m-%d %H:%M:%S') < TIMESTAMP '{DAYS[1]} 00:00:00' + INTERVAL 1 DAY
""")
def q_whole_days(spark, sf):
    """C11: points of whole days between two dates (bounds as given, P15)."""
    return M.whole_days(_points(spark, sf), *DAYS).select("id", "kind", "end_time", "source_count")


@register("monitor_keys", f"""
WITH tp AS ({mf.THROUGHPUT_SQL}), {mf.link_fields_sql()}, lp AS ({mf.LINK_POINTS_SQL})
SELECT DISTINCT k AS key FROM (SELECT id AS k FROM tp UNION ALL SELECT key FROM lp)
""")
def q_monitor_keys(spark, sf):
    """Set union of the keys of two point stores, in key order."""
    a, b = _points(spark, sf).select(F.col("id").alias("key")), _links(spark, sf).select("key")
    return a.union(b).distinct().orderBy("key")


# ------------------------------------------------------------ end to end

def _e2e_sql() -> str:
    from .queries_etl import _ETL_SQL
    from .queries_scoring import FLOWS_CTE, METRICS_CTE, SCORES_CTE
    from .fixtures import requests_sql
    from .catalog import _ALL_SQL
    from .sqlparts import sql_request_flag, sql_spider_flag
    metrics = METRICS_CTE.replace(
        f"req AS ({requests_sql()})",
        f"lines AS ({_ETL_SQL}), req AS (SELECT * FROM lines WHERE behaviorType = 'Query')")
    return f"""
WITH {metrics}, {FLOWS_CTE}, {SCORES_CTE},
hot AS (SELECT DISTINCT window_start, ip FROM scores WHERE score > flow_limit),
bl AS (SELECT DISTINCT s.ip AS remoteAddr, s.flow_id AS flowID FROM scores s
       JOIN hot h ON s.window_start = h.window_start AND s.ip = h.ip),
tagged AS (
  SELECT r.request, {sql_request_flag('r.request')} AS requestType, {sql_spider_flag('b.flowID')} AS isSpider,
         r.travelType, r.flightType, substr(r.timeIso8601, 1, 10) AS visitTime
  FROM lines r LEFT JOIN bl b ON r.remoteAddr = b.remoteAddr)
{_ALL_SQL}
"""


def q_scored_indicators(spark, sf):
    """The three data paths chained on the derived raw lines: ETL ->
    per-IP day-window metrics -> flow scores -> blacklist store (latest
    value per ip#flow key, every flow of a flagged window, P17) -> tags ->
    all indicators.

    The processed log feeds two branches (scoring and indicators), so it
    written once below the shared folder of ``spark.checkpoint.dir`` (the
    reference hands it over through a topic), and each branch reads the
    columns that it needs.
    """
    from ..operators import indicators as ind
    from ..operators import rules as R
    from ..operators import scoring as S
    from ..operators import windows as W
    from ..session import checkpoint_root
    path = f"{checkpoint_root(spark)}/processed-{uuid.uuid4().hex}"
    E.etl(raw_log(spark, sf), fx.etl_rules(), fx.hot_ips(fx.table(spark, sf, "events"))).drop(
        "queryRequestDataStr", "bookRequestDataStr", "httpReferrer").write.parquet(path)
    processed = spark.read.parquet(path)
    queries, _ = E.split_by_behavior(processed)  # C3: only query lines are scored
    metrics = W.ip_window_metrics(queries, fx.CRITICAL_PAGES, 86400)
    flows = R.collect_flows(fx.flow_config(spark, sf))
    entries = S.blacklist_entries(S.flatten_flows(S.score_flows(metrics, flows)))
    store = entries.groupBy("ip", "flow_id").agg(
        F.max_by(F.struct("score", "hit_rules", "rule_time"), "rule_time").alias("v")).select(
        "ip", "flow_id", "v.*")
    return ind.all_indicators(ind.stage_summary(processed, S.blacklist_log(store)))


register("scored_indicators", _e2e_sql())(q_scored_indicators)
