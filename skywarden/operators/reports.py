"""Dashboard reads and shaping.

Reports read small indicator / rank tables, but they are still plans:
ranges are filters (pushed to the scan), pages are ``orderBy + offset +
limit`` (each partition keeps only ``offset + limit`` rows), calendar
alignment is a join with a generated day spine, and series are pivots
with an explicit value list (no extra job to discover the values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.helpers import is_blank


def _blank(v) -> bool:
    """B34 on a Python value: decides whether an optional filter applies."""
    return v is None or str(v).strip() == "" or str(v).lower() == "null"


def time_range(df: DataFrame, col: str, start: str | None, end: str | None) -> DataFrame:
    """Optional inclusive timestamp range on a text / timestamp column."""
    c = F.col(col)
    if not _blank(start):
        df = df.filter(c >= F.lit(start))
    if not _blank(end):
        df = df.filter(c <= F.lit(end))
    return df


def day_range(df: DataFrame, col: str, start: str | None, end: str | None) -> DataFrame:
    """Optional inclusive range on the day part of ``col``.

    On a timestamp / date column the bounds are compared with the column
    itself (``[start 00:00, end + 1 day)``), so the filter reaches the
    scan; on text it compares the ``yyyy-MM-dd`` prefix.
    """
    dtype = df.schema[col].dataType.typeName()
    c = F.col(col)
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        cast = "date" if dtype == "date" else dtype
        if not _blank(start):
            df = df.filter(c >= F.lit(start).cast(cast))
        if not _blank(end):
            df = df.filter(c < F.date_add(F.lit(end).cast("date"), 1).cast(cast))
        return df
    d = F.substring(c.cast("string"), 1, 10)
    if not _blank(start):
        df = df.filter(d >= F.lit(start))
    if not _blank(end):
        df = df.filter(d <= F.lit(end))
    return df


def day_and_code(df: DataFrame, day_col: str, code_col: str, day: str | None, code) -> DataFrame:
    """Day equality and code equality, applied only when both given."""
    if _blank(day) or _blank(code):
        return df
    return df.filter((F.substring(F.col(day_col).cast("string"), 1, 10) == day) & (F.col(code_col) == code))


def point_lookup(df: DataFrame, filters: dict, order_col: str) -> DataFrame:
    """Equality lookup ordered by time; blank keys are ignored."""
    for k, v in filters.items():
        if not _blank(v):
            df = df.filter(F.col(k) == v)
    return df.orderBy(order_col)


def page(df: DataFrame, order: Sequence[Column], page_no: int, rows: int) -> DataFrame:
    """H1: rows ``(page_no - 1) * rows`` .. on a total order."""
    return df.orderBy(*order).offset((page_no - 1) * rows).limit(rows)


def page_count(df: DataFrame, rows: int) -> DataFrame:
    """F22 + H2: row count and number of pages ``ceil(n / rows)``."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.ceil(F.col("n") / F.lit(rows)).cast("long").alias("pages"))


def day_spine(spark, start: str, end: str) -> DataFrame:
    """Every calendar day from ``start`` to ``end`` (P24: a real calendar)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                      F.expr("INTERVAL 1 DAY"))).alias("d")) \
        .select(F.date_format("d", "yyyy-MM-dd").alias("day"))


def align_to_calendar(series: DataFrame, day_col: str, code_col: str, value_col: str,
                      codes: Sequence, start: str, end: str, order_col: str | None = None) -> DataFrame:
    """K1 + E11: one column per code, one row per calendar day, NULL fill.

    Several rows of a code on one day: the first one (by ``order_col``,
    default the value) is taken.
    """
    spark = series.sparkSession
    days = day_spine(spark, start, end)
    order = F.col(order_col) if order_col else F.col(value_col)
    s = (series.select(F.substring(F.col(day_col).cast("string"), 1, 10).alias("day"),
                       F.col(code_col).alias("code"), F.col(value_col).alias("v"), order.alias("o"))
         .filter(F.col("day").between(start, end))
         .groupBy("day").pivot("code", list(codes)).agg(F.min_by("v", "o")))
    return days.join(s, "day", "left")


def observed_pivot(series: DataFrame, day_col: str, code_col: str, value_col: str,
                   codes: Sequence) -> DataFrame:
    """K2 + F23: one row per observed day (distinct, in order), one column
    per code."""
    return (series.groupBy(F.col(day_col).alias("day")).pivot(code_col, list(codes))
            .agg(F.first(value_col)).orderBy("day"))


# Funnel stage labels (query -> passenger -> payment).
FUNNEL_STAGES = {0: "query-to-passenger", 1: "passenger-to-payment"}


def funnel(conversion: DataFrame) -> DataFrame:
    """K3 + B31: stage label and rate as a percentage."""
    labels = F.create_map(*[x for k, v in FUNNEL_STAGES.items() for x in (F.lit(k), F.lit(v))])
    return conversion.select(F.element_at(labels, F.col("step_type")).alias("stage"),
                             F.col("flight_type"), (F.col("conversion_rate") * 100).alias("percent"))


# Payload kind -> parse-rule flags it selects (C14).
PAYLOAD_KINDS = {
    0: {"is_json": True, "is_application_json": True},
    1: {"is_json": True, "is_application_json": False},
    2: {"is_xml": True, "is_text_xml": True},
    3: {"is_xml": True, "is_normal_form": True},
    4: {"is_xml": False, "is_json": False, "is_normal_form": True},
    5: {"is_normal_get": True},
}


def kind_predicate(kind: int) -> Column:
    cond = F.lit(True)
    for k, v in PAYLOAD_KINDS[kind].items():
        cond = cond & (F.col(k) == F.lit(v))
    return cond


def parse_rule_lookup(rules: DataFrame, kind: int | None = None, flight_type=None,
                      behavior_type=None) -> DataFrame:
    """C14: parse rules of a payload kind for a flight and behaviour type.

    ``kind=None`` tags every rule with every kind it belongs to.
    """
    kinds = [kind] if kind is not None else list(PAYLOAD_KINDS)
    tagged = rules.select("*", F.explode(F.filter(
        F.array(*[F.when(kind_predicate(k), F.lit(k)) for k in kinds]), lambda x: x.isNotNull())).alias("kind"))
    if flight_type is not None:
        tagged = tagged.filter(F.col("flight_type") == flight_type)
    if behavior_type is not None:
        tagged = tagged.filter(F.col("behavior_type") == behavior_type)
    return tagged


__all__ = ["time_range", "day_range", "day_and_code", "point_lookup", "page", "page_count",
           "day_spine", "align_to_calendar", "observed_pivot", "funnel", "parse_rule_lookup",
           "is_blank"]
