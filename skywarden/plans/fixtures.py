"""Reference-shaped inputs derived from the driver tables.

The engine works on access logs, blacklists and rule tables.  The test
tables are a TPC-H-like star schema plus an ``events`` stream, so every
registered query first projects them into the engine's record types with
a deterministic rule.  Each derivation exists twice, once as a DataFrame
plan and once as DuckDB SQL (``*_SQL``); the two must give identical rows
so the oracle compares the operator, not the mapping.

All projections are narrow (no shuffle) and grow with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PROCESSED_FIELDS

# Airport codes used for departure / arrival cities.
CITIES = ["CAN", "PEK", "SHA", "WUH", "CTU", "XIY", "KMG", "SZX", "HGH",
          "NKG", "CKG", "TAO", "XMN"]

# The seven metric names a rule can refer to (rule type 0..6).
RULE_NAMES = ["ip", "criticalPages", "userAgent", "criticalPagesAccTime",
              "criticalPagesLessThanDefault", "flightQuery", "criticalCookies"]

# Rule sets used with the derived logs.
FILTER_RULES = [r".*\.(js|css|png|jpg|gif)( .*)?", r".*/favicon\.ico.*"]
NATION_QUERY_RULES = [r"^.*/query/dom/.*$"]
INTERNATION_QUERY_RULES = [r"^.*/query/intl/.*$"]
NATION_BOOK_RULES = [r"^.*/bookingnew/dom/.*$"]
INTERNATION_BOOK_RULES = [r"^.*/bookingnew/intl/.*$"]
CRITICAL_PAGES = [r"^.*/query/.*$", r"^.*/bookingnew/.*$"]


# Parse rules of the derived logs (M7): GET query search in
# the URL; booking JSON bodies, with a later, narrower rule for
# international bookings (the last matching rule wins).
QUERY_PARAM_KEYS = {"depCity": "depCity", "arrCity": "arrCity", "flightDate": "flightDate",
                    "adultNum": "adultNum", "childNum": "childNum", "infantNum": "infantNum",
                    "country": "country"}
BOOK_JSON_PATHS = {"bookUserId": "$.bookUserId", "psgName": "$.psgName", "psgFirName": "$.psgFirName",
                   "idType": "$.idType", "idCard": "$.idCard", "contractName": "$.contactName",
                   "contractPhone": "$.contactPhone", "depCity": "$.depCity", "arrCity": "$.arrCity",
                   "flightDate": "$.flightDate", "flightNo": "$.flightNo", "cabin": "$.cabin"}


def etl_rules():
    """Rule snapshot used with :func:`raw_lines`."""
    from ..operators.etl import EtlRules, ParseRule
    return EtlRules(
        filter_rules=FILTER_RULES,
        nation_query=NATION_QUERY_RULES, internation_query=INTERNATION_QUERY_RULES,
        nation_book=NATION_BOOK_RULES, internation_book=INTERNATION_BOOK_RULES,
        query_rules=[ParseRule("Q1", "GET", 0, "^.*/query/.*$", normal_get=True, query=QUERY_PARAM_KEYS)],
        book_rules=[ParseRule("B1", "POST", 1, "^.*/bookingnew/.*$", flight_type=0, application_json=True,
                              is_json=True, book=BOOK_JSON_PATHS),
                    ParseRule("B2", "POST", 1, "^.*/bookingnew/intl/.*$", flight_type=1,
                              application_json=True, is_json=True, book=BOOK_JSON_PATHS)])


def process_table(region: DataFrame) -> DataFrame:
    """nh_process_info derived from ``region`` (region 4 is switched off)."""
    k = F.col("r_regionkey")
    return region.select(
        F.concat(F.lit("P"), k.cast("string")).alias("id"),
        F.col("r_name").alias("process_name"),
        F.when(k == 4, 1).otherwise(0).alias("status"),
        k.cast("int").alias("process_num"))


def strategy_table(region: DataFrame) -> DataFrame:
    """nh_strategy: one blacklist threshold per process."""
    k = F.col("r_regionkey")
    return region.select(F.concat(F.lit("P"), k.cast("string")).alias("id"),
                         (F.lit(10.0) + k.cast("double") * 5).alias("crawler_blacklist_thresholds"))


def rule_table(nation: DataFrame) -> DataFrame:
    """nh_rule derived from ``nation``: 25 rules spread over the processes."""
    k = F.col("n_nationkey")
    return nation.select(
        F.concat(F.lit("R"), k.cast("string")).alias("id"),
        F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("process_id"),
        F.concat(F.lit("rule-"), (k % 7).cast("string")).alias("rule_name"),
        F.when(k % 8 == 7, 1).otherwise(0).alias("crawler_type"),
        F.when(k % 4 == 1, 1).otherwise(0).alias("status"),
        (k % 3).cast("double").alias("arg0"),
        (k % 2).cast("double").alias("arg1"),
        (F.lit(1) + k % 9).cast("int").alias("score"),
        k.cast("int").alias("rule_order"))


def rule_dictionary(spark: SparkSession) -> DataFrame:
    """nh_rules_maintenance_table: rule name of the form -> metric name."""
    return spark.createDataFrame([(f"rule-{i}", n) for i, n in enumerate(RULE_NAMES)], "rule_name string, rule_real_name string")


def flow_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four tables of the flow configuration, by the names :func:`write_rule_tables` takes."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return {"process": process_table(region), "strategy": strategy_table(region), "rule": rule_table(nation),
            "dictionary": rule_dictionary(spark)}


def flow_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.rules import flows_of
    t = flow_tables(spark, sf_dir)
    return flows_of(t["process"], t["strategy"], t["rule"], t["dictionary"])


def hot_ips(events: DataFrame) -> DataFrame:
    """nh_ip_blacklist: addresses of every 50th user."""
    u = events.select("user_id").distinct().filter(F.col("user_id") % 50 == 0)
    return u.select(F.concat(F.lit("10.0.0."), _s("user_id")).alias("ip_name"))


HOT_IPS_SQL = """
SELECT DISTINCT '10.0.0.' || CAST(user_id AS VARCHAR) AS ip_name FROM events WHERE user_id % 50 = 0
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("string")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _request_columns() -> dict[str, Column]:
    """Named column expressions over ``events`` for the processed log."""
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    seg = F.when(uid % 2 == 0, "dom").otherwise("intl")
    url = (F.when(et == "view", F.concat(F.lit("/b2c/query/"), seg, F.lit("/"), _s(eid)))
           .when(et == "click", F.concat(F.lit("/b2c/bookingnew/"), seg, F.lit("/"), _s(eid)))
           .when(et == "signup", F.concat(F.lit("/b2c/modules/permissionnew/"), _s(eid)))
           .when(et == "purchase", F.concat(F.lit("/b2c/upp_payment/pay/"), _s(eid)))
           .otherwise(F.concat(F.lit("/b2c/static/err"), _s(eid), F.lit(".js"))))
    day = F.to_date(F.col("ts"))
    fdate = F.date_format(F.date_add(day, (eid % 30).cast("int")), "yyyy-MM-dd")
    rdate = F.date_format(F.date_add(day, (eid % 30 + 3).cast("int")), "yyyy-MM-dd")
    dep = _pick(CITIES, eid % 11)
    arr = _pick(CITIES, eid % 13)
    referrer = F.concat(
        F.lit("http://www.example.com/booking.html?t=S&c1="), dep, F.lit("&c2="), arr,
        F.when(eid % 3 == 0, F.concat(F.lit("&d1="), fdate))
         .when(eid % 3 == 1, F.concat(F.lit("&d1="), fdate, F.lit("&d2="), rdate))
         .otherwise(F.lit("")))
    qjson = F.when(et == "view", F.concat(
        F.lit('{"depCity":"'), dep, F.lit('","arrCity":"'), arr,
        F.lit('","flightDate":"'), fdate, F.lit('","adultNum":"'), _s(eid % 4 + 1),
        F.lit('"}'))).otherwise(F.lit("NULL"))
    return {
        "requestMethod": F.when(et.isin("signup", "purchase"), "POST").otherwise("GET"),
        "request": url,
        "remoteAddr": F.concat(F.lit("10.0.0."), _s(uid)),
        "httpUserAgent": F.concat(F.lit("UA/"), _s(eid % 5)),
        "timeIso8601": F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")),
        "serverAddr": F.concat(F.lit("192.168.0."), _s(uid % 8)),
        "highFrqIPGroup": F.when(uid % 50 == 0, "true").otherwise("false"),
        "flightType": F.when(uid % 2 == 0, "National").otherwise("International"),
        "behaviorType": F.when(et == "view", "Query").when(et == "click", "Book").otherwise("Other"),
        "travelType": F.when(eid % 3 == 0, "OneWay").when(eid % 3 == 1, "RoundTrip").otherwise("Unknown"),
        "flightDate": fdate,
        "depcity": dep,
        "arrcity": arr,
        "JSESSIONID": F.concat(F.lit("JS"), _s(eid % 7)),
        "USERID": F.concat(F.lit("U"), _s(uid)),
        "queryRequestDataStr": qjson,
        "bookRequestDataStr": F.lit("NULL"),
        "httpReferrer": referrer,
    }


def requests(events: DataFrame) -> DataFrame:
    """events -> processed log (M10, 18 text columns, schema order)."""
    cols = _request_columns()
    return events.select(*[cols[n].alias(n) for n in PROCESSED_FIELDS])


def _list_sql(values: list[str]) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def requests_sql(extra: str = "") -> str:
    """DuckDB twin of :func:`requests`; ``extra`` prepends event columns."""
    return _REQUESTS_SQL.replace("{EXTRA}", extra)


_REQUESTS_SQL = f"""
SELECT {{EXTRA}}
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS requestMethod,
  CASE WHEN event_type = 'view' THEN '/b2c/query/' || seg || '/' || CAST(event_id AS VARCHAR)
       WHEN event_type = 'click' THEN '/b2c/bookingnew/' || seg || '/' || CAST(event_id AS VARCHAR)
       WHEN event_type = 'signup' THEN '/b2c/modules/permissionnew/' || CAST(event_id AS VARCHAR)
       WHEN event_type = 'purchase' THEN '/b2c/upp_payment/pay/' || CAST(event_id AS VARCHAR)
       ELSE '/b2c/static/err' || CAST(event_id AS VARCHAR) || '.js' END AS request,
  '10.0.0.' || CAST(user_id AS VARCHAR) AS remoteAddr,
  'UA/' || CAST(event_id % 5 AS VARCHAR) AS httpUserAgent,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS timeIso8601,
  '192.168.0.' || CAST(user_id % 8 AS VARCHAR) AS serverAddr,
  CASE WHEN user_id % 50 = 0 THEN 'true' ELSE 'false' END AS highFrqIPGroup,
  CASE WHEN user_id % 2 = 0 THEN 'National' ELSE 'International' END AS flightType,
  CASE WHEN event_type = 'view' THEN 'Query' WHEN event_type = 'click' THEN 'Book' ELSE 'Other' END AS behaviorType,
  CASE WHEN event_id % 3 = 0 THEN 'OneWay' WHEN event_id % 3 = 1 THEN 'RoundTrip' ELSE 'Unknown' END AS travelType,
  fdate AS flightDate,
  dep AS depcity,
  arr AS arrcity,
  'JS' || CAST(event_id % 7 AS VARCHAR) AS JSESSIONID,
  'U' || CAST(user_id AS VARCHAR) AS USERID,
  CASE WHEN event_type = 'view' THEN '{{"depCity":"' || dep || '","arrCity":"' || arr
       || '","flightDate":"' || fdate || '","adultNum":"' || CAST(event_id % 4 + 1 AS VARCHAR) || '"}}'
       ELSE 'NULL' END AS queryRequestDataStr,
  'NULL' AS bookRequestDataStr,
  'http://www.example.com/booking.html?t=S&c1=' || dep || '&c2=' || arr ||
  CASE WHEN event_id % 3 = 0 THEN '&d1=' || fdate
       WHEN event_id % 3 = 1 THEN '&d1=' || fdate || '&d2=' || rdate
       ELSE '' END AS httpReferrer
FROM (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN user_id % 2 = 0 THEN 'dom' ELSE 'intl' END AS seg,
         strftime(CAST(ts AS DATE) + CAST(event_id % 30 AS INTEGER), '%Y-%m-%d') AS fdate,
         strftime(CAST(ts AS DATE) + CAST(event_id % 30 + 3 AS INTEGER), '%Y-%m-%d') AS rdate,
         {_list_sql(CITIES)}[event_id % 11 + 1] AS dep,
         {_list_sql(CITIES)}[event_id % 13 + 1] AS arr
  FROM events
) e
"""


def blacklist(events: DataFrame) -> DataFrame:
    """Distinct users -> blacklist log.

    Every 10th user is flagged by flow F1, every 20th also by F2 (so the
    log join fans out), and users with id % 30 == 7 carry the text flow id
    ``null`` (treated as a normal user by the crawler tag).
    """
    uid = F.col("user_id")
    u = events.select("user_id").distinct()
    # One pass: every user gets the array of its flows (usually empty).
    flows = F.filter(F.array(F.when(uid % 10 == 0, F.lit("F1")), F.when(uid % 20 == 0, F.lit("F2")),
                             F.when(uid % 30 == 7, F.lit("null"))), lambda f: f.isNotNull())
    b = u.select(uid, F.explode(flows).alias("flowID"))
    return b.select(
        F.concat(F.lit("10.0.0."), _s(uid)).alias("remoteAddr"),
        F.col("flowID"),
        F.format_string("%.2f", (uid % 97).cast("double") / 4).alias("score"),
        F.concat(F.lit("R"), _s(uid % 25)).alias("ruleIDs"),
        F.lit("2024-01-31 00:00:00").alias("ruleTime"),
    )


BLACKLIST_SQL = """
SELECT '10.0.0.' || CAST(user_id AS VARCHAR) AS remoteAddr, flowID,
       printf('%.2f', CAST(user_id % 97 AS DOUBLE) / 4) AS score,
       'R' || CAST(user_id % 25 AS VARCHAR) AS ruleIDs,
       '2024-01-31 00:00:00' AS ruleTime
FROM (
  SELECT user_id, 'F1' AS flowID FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 10 = 0
  UNION ALL
  SELECT user_id, 'F2' FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 20 = 0
  UNION ALL
  SELECT user_id, 'null' FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 30 = 7
) b
"""


def _raw_columns() -> dict[str, Column]:
    """Per-event parts of a raw access line (method, URL, type, body)."""
    c = _request_columns()
    eid, et = F.col("event_id"), F.col("event_type")
    form = et.isin("signup", "purchase")
    url = F.when(et == "view", F.concat(
        c["request"], F.lit("?depCity="), c["depcity"], F.lit("&arrCity="), c["arrcity"],
        F.lit("&flightDate="), c["flightDate"], F.lit("&adultNum="), _s(eid % 4 + 1))).otherwise(c["request"])
    form_body = F.concat(
        F.lit("tel=13"), F.lpad(_s(eid * 7919 % 1000000000), 9, "0"),
        F.lit("&idcard=11010"), F.lpad(_s(eid * 104729 % 10000000000000), 13, "0"),
        F.lit("&depCity="), c["depcity"], F.lit("&arrCity="), c["arrcity"])
    book_body = F.concat(
        F.lit('{"bookUserId":"'), c["USERID"],
        F.lit('","psgFirName":["Li","Wang"],"psgName":["Lei","Fang"],"idType":["ID","ID"],'
              '"idCard":["11010519900101'), F.lpad(_s(eid % 10000), 4, "0"),
        F.lit('","110105199001021234"],"contactName":"Li Lei","contactPhone":"139'),
        F.lpad(_s(eid % 100000000), 8, "0"),
        F.lit('","depCity":"'), c["depcity"], F.lit('","arrCity":"'), c["arrcity"],
        F.lit('","flightDate":"'), c["flightDate"], F.lit('","flightNo":"CZ'), _s(eid % 9000 + 1000),
        F.lit('","cabin":"Y"}'))
    return {
        "method": F.when(form | (et == "click"), "POST").otherwise("GET"),
        "url": url,
        "contentType": F.when(form, "application/x-www-form-urlencoded")
                        .when(et == "click", "application/json").otherwise(""),
        "body": F.when(form, form_body).when(et == "click", book_body).otherwise(""),
    }


def raw_lines_keyed(events: DataFrame) -> DataFrame:
    """:func:`raw_lines` with the event id kept (per-line outputs)."""
    return _raw_select(events, keep_id=True)


def raw_lines(events: DataFrame) -> DataFrame:
    """events -> raw access lines (M1): one ``value`` string per request.

    Query pages carry their search in the URL, bookings post a JSON body
    and forms post a mobile and an id-card number, so filtering, masking
    and every parse branch have work to do.
    """
    return _raw_select(events, keep_id=False)


def _raw_select(events: DataFrame, keep_id: bool) -> DataFrame:
    c = _request_columns()
    r = _raw_columns()
    eid = F.col("event_id")
    return events.select(*(["event_id"] if keep_id else []), F.concat_ws(
        "#CS#",
        c["timeIso8601"],
        F.concat(r["method"], F.lit(" "), r["url"], F.lit(" HTTP/1.1")),
        r["method"], r["contentType"], r["body"],
        c["httpReferrer"], c["remoteAddr"], c["httpUserAgent"], c["timeIso8601"], c["serverAddr"],
        F.concat(F.lit("JSESSIONID="), c["JSESSIONID"], F.lit("; userId4logCookie="), c["USERID"]),
        _s(eid % 50),
    ).alias("value"))


RAW_LINES_KEYED_SQL = """
SELECT event_id, concat_ws('#CS#',
  timeIso8601, method || ' ' || url || ' HTTP/1.1', method, contentType, body,
  httpReferrer, remoteAddr, httpUserAgent, timeIso8601, serverAddr,
  'JSESSIONID=' || JSESSIONID || '; userId4logCookie=' || USERID,
  CAST(event_id % 50 AS VARCHAR)) AS value
FROM (
  SELECT r.*,
    CASE WHEN event_type IN ('signup', 'purchase', 'click') THEN 'POST' ELSE 'GET' END AS method,
    CASE WHEN event_type = 'view' THEN request || '?depCity=' || depcity || '&arrCity=' || arrcity
         || '&flightDate=' || flightDate || '&adultNum=' || CAST(event_id % 4 + 1 AS VARCHAR)
         ELSE request END AS url,
    CASE WHEN event_type IN ('signup', 'purchase') THEN 'application/x-www-form-urlencoded'
         WHEN event_type = 'click' THEN 'application/json' ELSE '' END AS contentType,
    CASE WHEN event_type IN ('signup', 'purchase') THEN
           'tel=13' || lpad(CAST(event_id * 7919 % 1000000000 AS VARCHAR), 9, '0')
           || '&idcard=11010' || lpad(CAST(event_id * 104729 % 10000000000000 AS VARCHAR), 13, '0')
           || '&depCity=' || depcity || '&arrCity=' || arrcity
         WHEN event_type = 'click' THEN
           '{"bookUserId":"' || USERID
           || '","psgFirName":["Li","Wang"],"psgName":["Lei","Fang"],"idType":["ID","ID"],'
           || '"idCard":["11010519900101' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0')
           || '","110105199001021234"],"contactName":"Li Lei","contactPhone":"139'
           || lpad(CAST(event_id % 100000000 AS VARCHAR), 8, '0')
           || '","depCity":"' || depcity || '","arrCity":"' || arrcity
           || '","flightDate":"' || flightDate || '","flightNo":"CZ' || CAST(event_id % 9000 + 1000 AS VARCHAR)
           || '","cabin":"Y"}'
         ELSE '' END AS body
  FROM (""" + requests_sql("event_id, event_type, ") + """) r
) x
"""

RAW_LINES_SQL = "SELECT value FROM (" + RAW_LINES_KEYED_SQL + ")"
