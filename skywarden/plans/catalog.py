"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads whole driver tables and
returns a DataFrame; computed columns carry the same aliases as the SQL.
"""

from __future__ import annotations

from ..operators import indicators as ind
from .sqlparts import sql_ratio, with_tagged

from .registry import ORACLES, QUERIES, blacklist, logs, register, summary  # noqa: F401


# ---------------------------------------------------------------- indicators

@register("tagged_requests", with_tagged("SELECT * FROM tagged"))
def q_tagged(spark, sf):
    return ind.tagged_requests(logs(spark, sf), blacklist(spark, sf))


def _conv_flight_sql(names: tuple[str, ...], code: int) -> str:
    inlist = ", ".join(f"'{n}'" for n in names)
    return with_tagged(f"""
SELECT 0 AS step_type, {code} AS flight_type, {sql_ratio('2', '1', 2)} AS conversion_rate,
       max(visitTime) AS record_time FROM tagged WHERE flightType IN ({inlist})
UNION ALL
SELECT 1, {code}, {sql_ratio('3', '2', 2)}, max(visitTime) FROM tagged WHERE flightType IN ({inlist})
""")


@register("conversion_national", _conv_flight_sql(ind.NATIONAL, 0))
def q_conv_nat(spark, sf):
    return ind.conversion_by_flight(summary(spark, sf), ind.NATIONAL, 0)


@register("conversion_international", _conv_flight_sql(ind.INTERNATIONAL, 1))
def q_conv_intl(spark, sf):
    return ind.conversion_by_flight(summary(spark, sf), ind.INTERNATIONAL, 1)


def _conv_user_sql(spider: str | None) -> str:
    where = "" if spider is None else f"WHERE isSpider = '{spider}'"
    code = "CAST(NULL AS INTEGER)" if spider is None else spider
    return with_tagged(f"""
SELECT 0 AS step_type, {code} AS query_spider_type, {sql_ratio('2', '1', None)} AS conversion_rate,
       max(visitTime) AS record_time FROM tagged {where}
UNION ALL
SELECT 1, {code}, {sql_ratio('3', '2', None)}, max(visitTime) FROM tagged {where}
""")


@register("conversion_crawler", _conv_user_sql("1"))
def q_conv_crawler(spark, sf):
    return ind.conversion_by_user(summary(spark, sf), "1")


@register("conversion_normal", _conv_user_sql("0"))
def q_conv_normal(spark, sf):
    return ind.conversion_by_user(summary(spark, sf), "0")


@register("conversion_all", _conv_user_sql(None))
def q_conv_all(spark, sf):
    return ind.conversion_by_user(summary(spark, sf), None)


_FREQ_SQL = """
SELECT flightType AS flight_type, travelType AS travel_type, count(*) AS frequency,
       max(visitTime) AS record_time
FROM tagged WHERE isSpider = '1' GROUP BY flightType, travelType
"""


@register("crawl_frequency", with_tagged(_FREQ_SQL))
def q_freq(spark, sf):
    return ind.crawl_frequency(summary(spark, sf))


_BQ_SQL = f"""
SELECT 2 AS user_type, {sql_ratio('1', '0', None)} AS rate, max(visitTime) AS record_time
FROM tagged WHERE isSpider = '1'
UNION ALL
SELECT 1, {sql_ratio('1', '0', None)}, max(visitTime) FROM tagged WHERE isSpider = '0'
"""


@register("book_query_ratio", with_tagged(_BQ_SQL))
def q_bq(spark, sf):
    return ind.book_query_ratio(summary(spark, sf))


_FLOW_SQL = """
SELECT 1 AS type, count(*) AS value FROM tagged WHERE isSpider = '1'
UNION ALL SELECT 2, count(*) FROM tagged WHERE isSpider = '0'
UNION ALL SELECT 0, count(*) FROM tagged
"""


@register("flow_counts", with_tagged(_FLOW_SQL))
def q_flow(spark, sf):
    return ind.flow_counts(summary(spark, sf))


_ALL_SQL = f"""
SELECT 'domestic_inter_conversion_rate' AS indicator, 0 AS step_type, 0 AS code,
       CAST(NULL AS VARCHAR) AS code2, {sql_ratio('2', '1', 2)} AS value, max(visitTime) AS record_time
  FROM tagged WHERE flightType IN ('National')
UNION ALL SELECT 'domestic_inter_conversion_rate', 1, 0, NULL, {sql_ratio('3', '2', 2)}, max(visitTime)
  FROM tagged WHERE flightType IN ('National')
UNION ALL SELECT 'domestic_inter_conversion_rate', 0, 1, NULL, {sql_ratio('2', '1', 2)}, max(visitTime)
  FROM tagged WHERE flightType IN ('International', 'Internatinal')
UNION ALL SELECT 'domestic_inter_conversion_rate', 1, 1, NULL, {sql_ratio('3', '2', 2)}, max(visitTime)
  FROM tagged WHERE flightType IN ('International', 'Internatinal')
UNION ALL SELECT 'flight_query_conversion_rate', 0, 1, NULL, {sql_ratio('2', '1', None)}, max(visitTime)
  FROM tagged WHERE isSpider = '1'
UNION ALL SELECT 'flight_query_conversion_rate', 1, 1, NULL, {sql_ratio('3', '2', None)}, max(visitTime)
  FROM tagged WHERE isSpider = '1'
UNION ALL SELECT 'flight_query_conversion_rate', 0, 0, NULL, {sql_ratio('2', '1', None)}, max(visitTime)
  FROM tagged WHERE isSpider = '0'
UNION ALL SELECT 'flight_query_conversion_rate', 1, 0, NULL, {sql_ratio('3', '2', None)}, max(visitTime)
  FROM tagged WHERE isSpider = '0'
UNION ALL SELECT 'flight_query_conversion_rate', 0, NULL, NULL, {sql_ratio('2', '1', None)}, max(visitTime)
  FROM tagged
UNION ALL SELECT 'flight_query_conversion_rate', 1, NULL, NULL, {sql_ratio('3', '2', None)}, max(visitTime)
  FROM tagged
UNION ALL SELECT 'flight_query_rule', NULL, NULL, flightType || '/' || travelType, CAST(count(*) AS DOUBLE),
  max(visitTime) FROM tagged WHERE isSpider = '1' GROUP BY flightType, travelType
UNION ALL SELECT 'flow_query_rate', NULL, 2, NULL, {sql_ratio('1', '0', None)}, max(visitTime)
  FROM tagged WHERE isSpider = '1'
UNION ALL SELECT 'flow_query_rate', NULL, 1, NULL, {sql_ratio('1', '0', None)}, max(visitTime)
  FROM tagged WHERE isSpider = '0'
UNION ALL SELECT 'flow_info', NULL, 1, NULL, CAST(count(*) AS DOUBLE), NULL FROM tagged WHERE isSpider = '1'
UNION ALL SELECT 'flow_info', NULL, 2, NULL, CAST(count(*) AS DOUBLE), NULL FROM tagged WHERE isSpider = '0'
UNION ALL SELECT 'flow_info', NULL, 0, NULL, CAST(count(*) AS DOUBLE), NULL FROM tagged
"""


@register("indicators_all", with_tagged(_ALL_SQL))
def q_all(spark, sf):
    return ind.all_indicators(summary(spark, sf))


# Further query groups register themselves on import.
from . import queries_scoring  # noqa: E402,F401
from . import queries_etl  # noqa: E402,F401
from . import queries_monitor  # noqa: E402,F401
from . import queries_xml  # noqa: E402,F401
