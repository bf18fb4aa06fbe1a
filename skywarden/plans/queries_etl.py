"""Registered queries: stream-ETL operators over raw lines and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import helpers as H
from ..functions.masking import mask_columns, mask_phone, sql_mask_id_card, sql_mask_phone
from ..functions.parsing import (cookie_map, escape, form_params, json_field, json_map, parse_processed,
                                 request_url, serialise_processed, split_raw, unescape, url_params)
from ..functions.tags import DATE_VALUE_PATTERN, classify_request, hot_ip_flag, travel_type
from ..operators import etl as E
from ..schemas import PROCESSED_FIELDS, RAW_FIELDS
from . import fixtures as fx
from .registry import logs, raw_log, register
from .fixtures import requests_sql
from .sqlparts import sql_full_match


def _events(spark, sf):
    return fx.table(spark, sf, "events")


def _raw(spark, sf):
    return raw_log(spark, sf)


RAW_SQL = f"raw AS ({fx.RAW_LINES_SQL})"
RAW_KEYED_SQL = f"rawk AS ({fx.RAW_LINES_KEYED_SQL})"


# --------------------------------------------------------------- B1 / B2

_split_cols = ", ".join(f"coalesce(a[{i + 1}], '') AS {n}" for i, n in enumerate(RAW_FIELDS))


@register("request_split", f"""
WITH {RAW_SQL}, f AS (SELECT string_split(value, '#CS#') AS a FROM raw)
SELECT {_split_cols}, coalesce(string_split(coalesce(a[2], ''), ' ')[2], '') AS url FROM f
""")
def q_request_split(spark, sf):
    s = _raw(spark, sf).select(split_raw("value").alias("f")).select("f.*")
    return s.withColumn("url", request_url(F.col("requestLine")))


# --------------------------------------------------------------- C1 / C2

_FILTER = sql_full_match("coalesce(string_split(value, '#CS#')[2], '')", fx.FILTER_RULES)


@register("drop_filter", f"WITH {RAW_SQL} SELECT value FROM raw WHERE NOT {_FILTER}")
def q_drop_filter(spark, sf):
    return E.filter_lines(_raw(spark, sf), fx.FILTER_RULES)


@register("keep_filter_flag", f"WITH {RAW_SQL} SELECT value, {_FILTER} AS matched FROM raw")
def q_keep_filter(spark, sf):
    return E.filter_lines(_raw(spark, sf), fx.FILTER_RULES, drop=False)


# --------------------------------------------------------------- B24-B26

@register("mask_phone", f"SELECT doc_id, {sql_mask_phone('text')} AS masked FROM documents")
def q_mask_phone(spark, sf):
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", mask_phone("text").alias("masked"))


@register("mask_id", f"""
SELECT doc_id, {sql_mask_id_card('p')} AS masked
FROM (SELECT doc_id, {sql_mask_phone('text')} AS p FROM documents)
""")
def q_mask_id(spark, sf):
    d = fx.table(spark, sf, "documents")
    return mask_columns(d.select("doc_id", "text"), "text", "masked")


@register("mask_raw_lines", f"""
WITH {RAW_SQL}
SELECT {sql_mask_id_card('p')} AS value FROM (SELECT {sql_mask_phone('value')} AS p FROM raw)
""")
def q_mask_raw(spark, sf):
    return mask_columns(_raw(spark, sf), "value")


# --------------------------------------------------------------- D1 / D2 / C3 / D6

def _sql_travel(ref: str) -> str:
    vals = (f"list_transform(string_split(coalesce(string_split(coalesce({ref}, ''), '?')[2], ''), '&'), "
            f"lambda p: string_split(p, '=')[2])")
    n = f"len(list_filter({vals}, lambda v: coalesce(regexp_full_match(v, '{DATE_VALUE_PATTERN}'), false)))"
    return f"CASE {n} WHEN 1 THEN 'OneWay' WHEN 2 THEN 'RoundTrip' ELSE 'Unknown' END"


@register("travel_type", f"""
WITH req AS ({requests_sql()})
SELECT httpReferrer, travelType, {_sql_travel('httpReferrer')} AS travel_type FROM req
""")
def q_travel(spark, sf):
    return logs(spark, sf).select("httpReferrer", "travelType",
                                  travel_type(F.col("httpReferrer")).alias("travel_type"))


def _sql_class(url: str) -> tuple[str, str]:
    groups = [(fx.NATION_QUERY_RULES, "National", "Query"), (fx.INTERNATION_QUERY_RULES, "International", "Query"),
              (fx.NATION_BOOK_RULES, "National", "Book"), (fx.INTERNATION_BOOK_RULES, "International", "Book")]
    fl = "CASE " + " ".join(f"WHEN {sql_full_match(url, g)} THEN '{a}'" for g, a, _ in groups) + " ELSE 'Other' END"
    be = "CASE " + " ".join(f"WHEN {sql_full_match(url, g)} THEN '{b}'" for g, _, b in groups) + " ELSE 'Other' END"
    return fl, be


_FL, _BE = _sql_class("request")


@register("request_class", f"""
WITH req AS ({requests_sql()})
SELECT request, {_FL} AS flight_type, {_BE} AS behavior_type FROM req
""")
def q_request_class(spark, sf):
    c = classify_request(F.col("request"), fx.NATION_QUERY_RULES, fx.INTERNATION_QUERY_RULES,
                         fx.NATION_BOOK_RULES, fx.INTERNATION_BOOK_RULES)
    return logs(spark, sf).select("request", c["flightType"].alias("flight_type"),
                                  c["behaviorType"].alias("behavior_type"))


@register("behaviour_split", f"""
WITH req AS ({requests_sql()})
SELECT 'query' AS stream, request, remoteAddr FROM req WHERE behaviorType = 'Query'
UNION ALL
SELECT 'book', request, remoteAddr FROM req WHERE behaviorType = 'Book'
""")
def q_behaviour_split(spark, sf):
    q, b = E.split_by_behavior(logs(spark, sf))
    return (q.select(F.lit("query").alias("stream"), "request", "remoteAddr")
            .unionByName(b.select(F.lit("book").alias("stream"), "request", "remoteAddr")))


@register("hot_ip_flag", f"""
WITH req AS ({requests_sql()}), hot AS ({fx.HOT_IPS_SQL})
SELECT r.remoteAddr, r.request, h.ip_name IS NOT NULL AS is_hot
FROM req r LEFT JOIN hot h ON r.remoteAddr = h.ip_name
""")
def q_hot_ip(spark, sf):
    ev = _events(spark, sf)
    j = hot_ip_flag(fx.requests(ev), "remoteAddr", fx.hot_ips(ev), out="is_hot")
    return j.select("remoteAddr", "request", "is_hot")


# --------------------------------------------------------------- B7 / B8 / B3-B6 / B12 / B19

@register("url_params", """
WITH p AS (SELECT page_id, string_split(coalesce(string_split(url, '?')[2], ''), '&') AS ps FROM pages),
kv AS (SELECT page_id, string_split(x, '=') AS a, o FROM p, unnest(ps) WITH ORDINALITY AS t(x, o)),
ok AS (SELECT page_id, a[1] AS k, a[2] AS v, o FROM kv
       WHERE len(list_filter(a[2:], lambda t: t <> '')) > 0)
SELECT page_id, k AS key, arg_max(v, o) AS value FROM ok GROUP BY page_id, k
""")
def q_url_params(spark, sf):
    p = fx.table(spark, sf, "pages")
    return p.select("page_id", F.explode(url_params("url")).alias("key", "value"))


PARAM_RULE = E.ParseRule("QP", "GET", 0, ".*", normal_get=True, query={
    "depCity": "c1", "arrCity": "c2", "adultNum": "n", "travelType": "t"})


@register("param_fields", """
SELECT event_id, event_id % 6 = 5 AS isEmpty, CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE -1 END AS travelType,
       CASE WHEN event_id % 6 = 5 THEN '' ELSE 'D' || user_id END AS depCity,
       CASE WHEN event_id % 6 = 5 THEN '' ELSE event_type END AS arrCity,
       CASE WHEN event_id % 6 = 4 THEN '2' ELSE '' END AS adultNum
FROM events
""")
def q_param_fields(spark, sf):
    """B7 + B13: the fields that a rule names, out of a search URL; the
    travel type is a number, 0 or 1, or there is none to read."""
    eid = F.col("event_id") % 6
    more = F.array(*[F.lit(x) for x in ("&t=0", "&t= 1 ", "&t=x", "&t=%20", "&n=2&n=2", "")])
    url = F.when(eid == 5, "/q").otherwise(F.concat(F.lit("/q?c1=D"), F.col("user_id").cast("string"), F.lit("&c2="),
                                                    F.col("event_type"), F.get(more, eid.cast("int"))))
    m = _events(spark, sf).select("event_id", url_params(url).alias("m"))
    q = m.select("event_id", E.query_params(F.col("m"), PARAM_RULE).alias("q"))
    return q.select("event_id", "q.isEmpty", "q.travelType", "q.depCity", "q.arrCity", "q.adultNum")


@register("form_params", f"""
WITH {RAW_KEYED_SQL},
b AS (SELECT event_id, string_split(coalesce(string_split(value, '#CS#')[5], ''), '&') AS ps FROM rawk),
kv AS (SELECT event_id, string_split(x, '=') AS a, o FROM b, unnest(ps) WITH ORDINALITY AS t(x, o)),
ok AS (SELECT event_id, a[1] AS k, url_decode(replace(a[2], '+', ' ')) AS v, o FROM kv
       WHERE len(list_filter(a[2:], lambda t: t <> '')) > 0)
SELECT event_id, k AS key, arg_max(v, o) AS value FROM ok WHERE v IS NOT NULL GROUP BY event_id, k
""")
def q_form_params(spark, sf):
    r = fx.raw_lines_keyed(fx.table(spark, sf, "events"))
    body = F.get(F.split("value", "#CS#", -1), 4)
    return r.select("event_id", F.explode(form_params(body)).alias("key", "value"))


@register("cookie_map", f"""
WITH {RAW_KEYED_SQL},
c AS (SELECT event_id, regexp_replace(coalesce(string_split(value, '#CS#')[11], ''), '[\\x00\\s]', '', 'g')
             || CASE event_id % 5 WHEN 0 THEN ';city=%u5317%u4EAC%41' WHEN 1 THEN ';odd=%zzu4E2D' WHEN 2 THEN ';cut=u4E2D%4'
                     WHEN 3 THEN ';pair=%uD83D%uDE00;bad=%zz' ELSE ';name=%E5%8C%97+x;name=2' END AS s
      FROM rawk),
esc(raw, plain) AS (VALUES ('%u5317%u4EAC%41', '北京A'), ('%zzu4E2D', chr(1023) || 'u4E2D'), ('u4E2D%4', NULL),
                           ('%uD83D%uDE00', chr(128512))),
kv AS (SELECT event_id, string_split(x, '=') AS a, o FROM c, unnest(string_split(s, ';')) WITH ORDINALITY AS t(x, o)
       WHERE s <> ''),
ok AS (SELECT event_id, a[1] AS k, CASE WHEN regexp_matches(a[2], 'u[0-9a-fA-F]{{4}}') THEN plain
              WHEN a[2] <> '%zz' THEN url_decode(replace(a[2], '+', ' ')) END AS v, o
       FROM kv LEFT JOIN esc ON a[2] = raw WHERE len(list_filter(a[2:], lambda t: t <> '')) > 0)
SELECT event_id, k AS key, arg_max(v, o) AS value FROM ok WHERE v IS NOT NULL GROUP BY event_id, k
""")
def q_cookie_map(spark, sf):
    """B3-B6, with escaped, undecodable and repeated values among the cookies."""
    r = fx.raw_lines_keyed(fx.table(spark, sf, "events"))
    more = F.array(*[F.lit(x) for x in (";city=%u5317%u4EAC%41", ";odd=%zzu4E2D", ";cut=u4E2D%4",
                                        ";pair=%uD83D%uDE00;bad=%zz", ";name=%E5%8C%97+x;name=2")])
    cookie = F.concat(F.get(F.split("value", "#CS#", -1), 10), F.get(more, (F.col("event_id") % 5).cast("int")))
    return r.select("event_id", F.explode(cookie_map(cookie)).alias("key", "value"))


@register("json_fields", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k_value,
       CAST(coalesce(len(json_keys(props)), 0) AS INTEGER) AS n_keys
FROM events
""")
def q_json_fields(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", json_field("props", "$.k").alias("k_value"),
                    F.size(json_map("props")).alias("n_keys"))


# --------------------------------------------------------------- B21-B23

@register("serialise_roundtrip", f"""
WITH req AS ({requests_sql()})
SELECT {", ".join(f"CASE WHEN {n} IS NULL OR {n} = '' THEN 'NULL' ELSE {n} END AS {n}" for n in PROCESSED_FIELDS)}
FROM req
""")
def q_serialise(spark, sf):
    text = logs(spark, sf).select(serialise_processed().alias("value"))
    return text.select(parse_processed("value").alias("p")).select("p.*")


# --------------------------------------------------------------- full ETL

def _sql_last_param(list_expr: str, key: str, decode: bool) -> str:
    v = "kv[2]" if not decode else "url_decode(replace(kv[2], '+', ' '))"
    return (f"coalesce(list_filter(list_transform(list_filter({list_expr}, "
            f"lambda kv: kv[1] = '{key}' AND len(list_filter(kv[2:], lambda t: t <> '')) > 0), "
            f"lambda kv: {v}), lambda x: x IS NOT NULL)[-1], '')")


_Q = "list_transform(string_split(coalesce(string_split(request, '?')[2], ''), '&'), lambda p: string_split(p, '='))"
_QHAS = f"len(list_filter({_Q}, lambda kv: len(list_filter(kv[2:], lambda t: t <> '')) > 0)) > 0"
_QF = {k: f"CASE WHEN q_ok AND {_QHAS} THEN {_sql_last_param(_Q, k, False)} ELSE '' END"
       for k in ["depCity", "arrCity", "flightDate", "adultNum", "childNum", "infantNum", "country"]}
_BOOK_OK = ("(b_rule IS NOT NULL AND lower(contentType) = 'application/json' AND body <> '')")


def _sql_jlist(path: str) -> str:
    return (f"CASE WHEN {_BOOK_OK} THEN coalesce(CAST(json_extract(js, '{path}') AS VARCHAR[]), []::VARCHAR[]) "
            f"ELSE []::VARCHAR[] END")


def _sql_jone(path: str) -> str:
    return (f"CASE WHEN {_BOOK_OK} AND json_extract_string(js, '{path}') IS NOT NULL "
            f"THEN [json_extract_string(js, '{path}')] ELSE []::VARCHAR[] END")


def _sql_jstr(path: str) -> str:
    return f"CASE WHEN {_BOOK_OK} THEN coalesce(json_extract_string(js, '{path}'), '') ELSE '' END"


_FLT = sql_full_match("coalesce(string_split(value, '#CS#')[2], '')", fx.FILTER_RULES)
_FLc, _BEc = _sql_class("request")
_P = fx.BOOK_JSON_PATHS
_ETL_SQL = f"""
WITH {RAW_SQL}, hot AS ({fx.HOT_IPS_SQL}),
kept AS (SELECT value FROM raw WHERE NOT {_FLT}),
m AS (SELECT {sql_mask_id_card('p')} AS value FROM (SELECT {sql_mask_phone('value')} AS p FROM kept)),
f AS (SELECT string_split(value, '#CS#') AS a FROM m),
s AS (
  SELECT coalesce(a[3], '') AS requestMethod,
         coalesce(string_split(coalesce(a[2], ''), ' ')[2], '') AS request,
         coalesce(a[4], '') AS contentType, coalesce(a[5], '') AS body, coalesce(a[6], '') AS httpReferrer,
         coalesce(a[7], '') AS remoteAddr, coalesce(a[8], '') AS httpUserAgent, coalesce(a[9], '') AS timeIso8601,
         coalesce(a[10], '') AS serverAddr,
         list_transform(string_split(regexp_replace(coalesce(a[11], ''), '[\\x00\\s]', '', 'g'), ';'),
                        lambda p: string_split(p, '=')) AS ck
  FROM f),
c AS (
  SELECT *, {_FLc} AS flightType, {_BEc} AS behaviorType, {_sql_travel('httpReferrer')} AS travelType,
         CASE WHEN {_sql_last_param('ck', 'JSESSIONID', True)} = '' THEN 'NULL'
              ELSE {_sql_last_param('ck', 'JSESSIONID', True)} END AS JSESSIONID,
         CASE WHEN {_sql_last_param('ck', 'userId4logCookie', True)} = '' THEN 'NULL'
              ELSE {_sql_last_param('ck', 'userId4logCookie', True)} END AS USERID
  FROM s),
c2 AS (
  SELECT *,
    upper(requestMethod) = 'GET' AND behaviorType = 'Query' AND {sql_full_match('request', ['^.*/query/.*$'])} AS q_ok,
    CASE WHEN upper(requestMethod) = 'POST' AND behaviorType = 'Book' AND {sql_full_match('request', ['^.*/bookingnew/intl/.*$'])} THEN 'B2'
         WHEN upper(requestMethod) = 'POST' AND behaviorType = 'Book' AND {sql_full_match('request', ['^.*/bookingnew/.*$'])} THEN 'B1'
    END AS b_rule,
    trim(replace(body, '\\x22', '')) AS js
  FROM c),
p AS (
  SELECT *,
    struct_pack(isEmpty := NOT (q_ok AND {_QHAS}),
                flightType := CASE flightType WHEN 'National' THEN 0 WHEN 'International' THEN 1 ELSE -1 END,
                travelType := CASE travelType WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END,
                queryTime := '', queryUserId := '', queryUnUserId := '', queryIp := '',
                depCity := {_QF['depCity']}, arrCity := {_QF['arrCity']}, flightDate := {_QF['flightDate']},
                adultNum := {_QF['adultNum']}, childNum := {_QF['childNum']}, infantNum := {_QF['infantNum']},
                country := {_QF['country']}) AS q,
    struct_pack(
      flightType := CASE b_rule WHEN 'B1' THEN 0 WHEN 'B2' THEN 1 ELSE -1 END,
      travelType := CASE WHEN b_rule IS NULL THEN -1
                         ELSE CASE travelType WHEN 'OneWay' THEN 0 WHEN 'RoundTrip' THEN 1 ELSE -1 END END,
      bookTime := '', bookUserId := {_sql_jstr(_P['bookUserId'])}, bookUnUserId := '', bookIp := '',
      psgName := list_transform({_sql_jlist(_P['psgFirName'])},
                   lambda x, i: coalesce(x, 'null') || coalesce(({_sql_jlist(_P['psgName'])})[i], 'null')),
      psgType := []::VARCHAR[], idType := {_sql_jlist(_P['idType'])},
      idCard := list_transform({_sql_jlist(_P['idCard'])}, lambda x: upper(md5(x))),
      contractName := {_sql_jstr(_P['contractName'])},
      contractPhone := upper(md5({_sql_jstr(_P['contractPhone'])})), bookAgent := '',
      depCity := {_sql_jone(_P['depCity'])}, arrCity := {_sql_jone(_P['arrCity'])},
      flightDate := {_sql_jone(_P['flightDate'])}, flightNo := {_sql_jone(_P['flightNo'])},
      cabin := {_sql_jone(_P['cabin'])}) AS b
  FROM c2),
o AS (
  SELECT requestMethod, request, remoteAddr, httpUserAgent, timeIso8601, serverAddr,
    CASE WHEN h.ip_name IS NOT NULL THEN 'true' ELSE 'false' END AS highFrqIPGroup,
    flightType, behaviorType, travelType,
    CASE behaviorType WHEN 'Query' THEN q.flightDate WHEN 'Book' THEN array_to_string(b.flightDate, '') ELSE '' END AS flightDate,
    CASE behaviorType WHEN 'Query' THEN q.depCity WHEN 'Book' THEN array_to_string(b.depCity, '') ELSE '' END AS depcity,
    CASE behaviorType WHEN 'Query' THEN q.arrCity WHEN 'Book' THEN array_to_string(b.arrCity, '') ELSE '' END AS arrcity,
    JSESSIONID, USERID, to_json(q)::VARCHAR AS queryRequestDataStr, to_json(b)::VARCHAR AS bookRequestDataStr,
    httpReferrer
  FROM p LEFT JOIN hot h ON p.remoteAddr = h.ip_name)
SELECT {", ".join(f"CASE WHEN {n} = '' THEN 'NULL' ELSE {n} END AS {n}" for n in PROCESSED_FIELDS)} FROM o
"""


@register("etl_processed", _ETL_SQL)
def q_etl(spark, sf):
    ev = _events(spark, sf)
    return E.etl(_raw(spark, sf), fx.etl_rules(), fx.hot_ips(ev))


@register("processed_record", f"""
SELECT remoteAddr, timeIso8601, request, highFrqIPGroup = 'true' AS is_hot, flightType, behaviorType, travelType,
       depcity, JSESSIONID AS session, CAST(json_extract(queryRequestDataStr, '$.isEmpty') AS BOOLEAN) AS q_empty,
       CAST(json_extract(queryRequestDataStr, '$.flightType') AS INTEGER) AS q_flight,
       json_extract_string(queryRequestDataStr, '$.depCity') AS q_dep,
       json_extract_string(queryRequestDataStr, '$.adultNum') AS q_adults, true AS no_booking
FROM ({_ETL_SQL})
""")
def q_record(spark, sf):
    """B22 + B23: the processed log as text, read back into the nested record."""
    from ..functions.parsing import parse_record
    text = q_etl(spark, sf).select(serialise_processed().alias("value"))
    r = text.select(parse_record("value").alias("r"))
    return r.select("r.remoteAddr", "r.timeIso8601", "r.request", F.col("r.highFrqIPGroup").alias("is_hot"),
                    "r.requestType.flightType", "r.requestType.behaviorType", "r.travelType", "r.requestParams.depcity",
                    F.col("r.cookieValue_JSESSIONID").alias("session"), F.col("r.queryRequestData.isEmpty").alias("q_empty"),
                    F.col("r.queryRequestData.flightType").alias("q_flight"), F.col("r.queryRequestData.depCity").alias("q_dep"),
                    F.col("r.queryRequestData.adultNum").alias("q_adults"),
                    F.col("r.bookRequestData").isNull().alias("no_booking"))


@register("escape_text", """
SELECT page_id, list_aggregate([CASE WHEN regexp_matches(c, '^[A-Za-z0-9\\-_.!~*''()]$') THEN c
         WHEN ord(c) < 128 THEN '%' || lpad(printf('%X', ord(c)), 2, '0')
         WHEN ord(c) < 65536 THEN '%u' || lpad(printf('%X', ord(c)), 4, '0')
         ELSE '%u' || printf('%X', 55296 + (ord(c) - 65536) // 1024) || '%u' || printf('%X', 56320 + (ord(c) - 65536) % 1024) END
         FOR c IN regexp_extract_all(url || ' 北京é/' || chr(128512), '(?s).')], 'string_agg', '') AS escaped,
       url || ' 北京é/' || chr(128512) AS back
FROM pages
""")
def q_escape(spark, sf):
    """B5 both ways: escape, and unescape of what it gives."""
    p = fx.table(spark, sf, "pages").select("page_id", escape(F.concat("url", F.lit(" 北京é/😀"))).alias("escaped"))
    return p.select("page_id", "escaped", unescape("escaped").alias("back"))


@register("split_lists", """
SELECT event_id, array_to_string(string_split(t, ','), '|') AS items, len(string_split(t, ','))::INTEGER AS n,
       array_to_string(list_filter(string_split(t, ','), lambda x: x <> ''), '|') AS filled
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'a,,b' WHEN 1 THEN '' WHEN 2 THEN event_type || ',' ELSE ',x,x' END AS t
      FROM events)
""")
def q_split_lists(spark, sf):
    """Comma lists with empty items, and without them."""
    k = F.col("event_id") % 4
    t = F.when(k == 0, "a,,b").when(k == 1, "").when(k == 2, F.concat("event_type", F.lit(","))).otherwise(",x,x")
    items = _events(spark, sf).select("event_id", H.split_list(t).alias("i"))
    return items.select("event_id", F.array_join("i", "|").alias("items"), F.size("i").alias("n"),
                        F.array_join(H.drop_empty("i"), "|").alias("filled"))


# --------------------------------------------------------------- B29 / B34-B36

@register("date_helpers", """
SELECT o_orderkey,
  strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS zero_of_day,
  strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS plus_90_min,
  strftime(o_orderdate - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS minus_5_hours,
  strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS day_before,
  CAST(epoch_ms(o_orderdate) - epoch_ms(TIMESTAMP '1995-01-01 00:00:00') AS BIGINT) AS ms_since_1995,
  CAST(CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS INTEGER) AS days_since_1995
FROM orders
""")
def q_dates(spark, sf):
    o = fx.table(spark, sf, "orders")
    ref = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    return o.select(
        "o_orderkey",
        H.zero_of_day("o_orderdate").alias("zero_of_day"),
        H.fmt(H.plus_minutes("o_orderdate", 90)).alias("plus_90_min"),
        H.fmt(H.plus_hours("o_orderdate", -5)).alias("minus_5_hours"),
        H.yesterday("o_orderdate").alias("day_before"),
        H.millis_between(ref, F.col("o_orderdate")).alias("ms_since_1995"),
        H.days_between(ref, F.col("o_orderdate")).alias("days_since_1995"))


_BLANK_TEXT = ("CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' "
               "WHEN 3 THEN 'NuLL' ELSE event_type END")


@register("blank_filter", f"""
SELECT event_id, ({_BLANK_TEXT}) IS NULL OR trim({_BLANK_TEXT}) = '' OR lower({_BLANK_TEXT}) = 'null' AS is_blank
FROM events
""")
def q_blank(spark, sf):
    e = _events(spark, sf)
    eid = F.col("event_id")
    text = (F.when(eid % 5 == 0, F.lit(None).cast("string")).when(eid % 5 == 1, "")
            .when(eid % 5 == 2, "   ").when(eid % 5 == 3, "NuLL").otherwise(F.col("event_type")))
    return e.select("event_id", H.is_blank(text).alias("is_blank"))


@register("list_helpers", """
WITH firsts AS (SELECT user_id, event_type, min((ts, event_id)) AS f FROM events
                WHERE event_type IS NOT NULL AND event_type <> '' GROUP BY user_id, event_type)
SELECT user_id, string_agg(event_type, ',' ORDER BY f) AS types_in_order FROM firsts GROUP BY user_id
""")
def q_list_helpers(spark, sf):
    """B35 per user, skew-safe: first occurrence per (user, value) is a
    partial aggregate, so a hot user collapses to one row per value before
    the ordered list is built."""
    e = _events(spark, sf).filter(F.col("event_type").isNotNull() & (F.col("event_type") != ""))
    firsts = e.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    lists = firsts.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("f", "event_type"))).alias("l"))
    return lists.select("user_id", F.array_join(H.distinct_nonempty(
        F.transform("l", lambda x: x["event_type"])), ",").alias("types_in_order"))


@register("usage_pct", """
SELECT l_orderkey, l_linenumber,
       printf('%.1f', CAST(CAST(trunc(l_quantity) AS BIGINT) * 100 // CAST(trunc(l_extendedprice) AS BIGINT)
                           AS DOUBLE)) AS usage
FROM lineitem WHERE CAST(trunc(l_extendedprice) AS BIGINT) <> 0
UNION ALL
SELECT l_orderkey, l_linenumber, NULL FROM lineitem WHERE CAST(trunc(l_extendedprice) AS BIGINT) = 0
""")
def q_usage(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     H.usage_percent("l_quantity", "l_extendedprice").alias("usage"))
