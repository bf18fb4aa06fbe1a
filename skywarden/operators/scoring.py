"""Rule / flow scoring (I1-I6, C4) over per-IP window metrics.

The flow configuration is one value in the plan, a nested array of flows
and their rules, evaluated per metric row by higher-order functions.  The
plan has the same shape for ten rules and for ten thousand; scoring stays
a narrow projection: no join, no shuffle.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric name -> metric column of ``ip_window_metrics``.
METRIC_COLUMNS = {
    "ip": "ip_visits",
    "criticalPages": "critical_visits",
    "userAgent": "distinct_ua",
    "criticalPagesAccTime": "min_critical_gap",
    "criticalPagesLessThanDefault": "gaps_under_10s",
    "flightQuery": "distinct_trips",
    "criticalCookies": "critical_cookies",
}
# The rule that compares against its second argument.
SECOND_ARG_RULE = "criticalPagesLessThanDefault"
FLOW_SCORE_CAP = 60.0     # factor 2 weight
ENABLED_SHARE_WEIGHT = 40.0  # factor 3 weight


_RULE = "array<struct<rule_id:string,metric:int,above:double,score:double,enabled:boolean>>"
_FLOWS = f"array<struct<flow_id:string,flow_limit:double,rules:{_RULE}>>"


def flows_value(flow_rows: list) -> Column:
    """The flow configuration as one constant: rules in their order, each
    with the place of its metric and the threshold that applies (argument 1
    for the less-than-default rule, else argument 0; I1)."""
    places = {name: i for i, name in enumerate(METRIC_COLUMNS)}
    flows = [{"flow_id": f["flow_id"], "flow_limit": f["flow_limit"], "rules": [
        {"rule_id": r["rule_id"], "metric": places.get(r["rule_name"], len(places)),
         "above": r["arg1"] if r["rule_name"] == SECOND_ARG_RULE else r["arg0"],
         "score": float(r["score"]), "enabled": r["rule_status"] == 0}
        for r in sorted(f["rules"], key=lambda r: r["rule_order"])]} for f in flow_rows]
    return F.from_json(F.lit(json.dumps(flows)), _FLOWS)


def _flow_result(metrics: Column, flow: Column) -> Column:
    """I1-I4 for one flow: hits, score and over-limit flag.

    I3 is f1 * (f2 + f3); no rule or no hit (the reference's 0 / 0) scores
    0 (P16).  Sums run left to right, in rule order.
    """
    rules = flow["rules"]
    zero = F.lit(0.0)
    add = lambda values: F.aggregate(values, zero, lambda total, x: total + x)
    # Intermediate results are bound to lambda variables, so each is worked out once.
    hits = F.transform(rules, lambda r: F.when(F.get(metrics, r["metric"]) > r["above"], r["score"]).otherwise(zero))

    def totals(hit: Column) -> Column:
        enabled = F.filter(F.zip_with(rules, hit, lambda r, h: F.when(r["enabled"], h)), lambda h: h.isNotNull())
        return F.struct(add(hit).alias("all"), add(enabled).alias("on"),
                        F.coalesce(F.array_max(enabled), zero).alias("top"))

    def score(t: Column) -> Column:
        sixth = F.lit(1.0) / F.lit(6.0)
        f1 = t["all"] / (F.lit(10) * F.size(rules))
        f2 = F.when(F.lit(1.0) < sixth * t["top"], F.lit(FLOW_SCORE_CAP)).otherwise(sixth * t["top"] * F.lit(60.0))
        value = F.when(t["all"] == 0, zero).otherwise(f1 * (f2 + F.lit(ENABLED_SHARE_WEIGHT) * (t["on"] / t["all"])))
        return F.struct(value.alias("score"), F.filter(F.zip_with(
            rules, F.transform(rules, lambda r: F.get(metrics, r["metric"]) > r["above"]),
            lambda r, h: F.when(h, r["rule_id"])), lambda i: i.isNotNull()).alias("ids"))

    def result(s: Column) -> Column:
        return F.struct(flow["flow_id"].alias("flow_id"), s["score"].alias("score"), flow["flow_limit"].alias("flow_limit"),
                        F.coalesce(s["score"] > flow["flow_limit"], F.lit(False)).alias("is_up_limited"),
                        s["ids"].alias("hit_rules"))

    bound = F.transform(F.transform(F.transform(F.array(hits), totals), score), result)
    return F.get(bound, F.lit(0))


def score_flows(metrics: DataFrame, flow_rows: list) -> DataFrame:
    """Append ``flows_score`` (one struct per configured flow) and
    ``any_up_limited``.

    Unknown rule names and NULL metrics (min gap below two visits, P11)
    count as 0.
    """
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in METRIC_COLUMNS.values()], F.lit(0.0))
    scored = metrics.select("*", F.get(F.transform(F.array(values), lambda m: F.transform(
        flows_value(flow_rows), lambda f: _flow_result(m, f))), F.lit(0)).alias("flows_score"))
    return scored.withColumn("any_up_limited", F.exists("flows_score", lambda f: f["is_up_limited"]))


def _any_up(scored: DataFrame) -> Column:
    if "any_up_limited" in scored.columns:
        return F.col("any_up_limited")
    return F.exists("flows_score", lambda f: f["is_up_limited"])


def flagged(scored: DataFrame) -> DataFrame:
    """C4: keep rows with at least one flow over its limit."""
    return scored.filter(_any_up(scored))


def flatten_flows(scored: DataFrame, only_over_limit: bool = False) -> DataFrame:
    """C4 + I5: one row per flow of a flagged IP, below-limit flows
    included (P17).

    The flag test and the flattening are one generator over the scored
    column: a separate ``filter`` would be pushed below the scoring
    projection and score every row twice.
    """
    fs = F.col("flows_score")
    keep = F.when(_any_up(scored), fs).otherwise(
        F.array().cast(scored.schema["flows_score"].dataType))
    if only_over_limit:
        keep = F.filter(keep, lambda f: f["is_up_limited"])
    rows = scored.select("window_start", "ip", F.explode(keep).alias("f"))
    return rows.select("window_start", "ip", "f.flow_id", "f.score", "f.flow_limit",
                       "f.is_up_limited", F.array_join("f.hit_rules", ",").alias("hit_rules"))


def blacklist_entries(rows: DataFrame, hit_time: Column | None = None) -> DataFrame:
    """KV text: key ``ip#flow``, value ``score|rules|time``."""
    t = hit_time if hit_time is not None else F.col("window_start")
    extra = ["is_up_limited"] if "is_up_limited" in rows.columns else []
    return rows.select(
        F.concat_ws("#", "ip", "flow_id").alias("key"),
        F.concat_ws("|", F.col("score").cast("string"), F.col("hit_rules"), t).alias("value"),
        "ip", "flow_id", "score", "hit_rules", t.alias("rule_time"), *extra)


def blacklist_log(entries: DataFrame) -> DataFrame:
    """Blacklist entries -> M11 rows, readable by the indicator job."""
    return entries.select(F.col("ip").alias("remoteAddr"), F.col("flow_id").alias("flowID"),
                          F.col("score").cast("string").alias("score"),
                          F.col("hit_rules").alias("ruleIDs"), F.col("rule_time").alias("ruleTime"))
