"""Scoring (I1-I6, C4) and masking (B24/B25) against hand-derived values
and a plain-Python restatement on random inputs."""

import hashlib
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from skywarden.functions import masking as M
from skywarden.operators import scoring as S

METRICS = "window_start string, ip string, ip_visits long, critical_visits long, distinct_ua long, " \
          "min_critical_gap int, gaps_under_10s long, distinct_trips long, critical_cookies long"


def rule(i, name, status, arg0, score, arg1=0.0):
    return {"rule_order": i, "rule_id": f"R{i}", "rule_name": name, "rule_status": status,
            "arg0": arg0, "arg1": arg1, "score": score}


def flow(fid, limit, rules):
    return {"flow_id": fid, "flow_name": fid, "flow_limit": limit, "rules": rules}


def metrics_row(spark, ip=5, crit=0, ua=0, gap=None, under=0, trips=0, cookies=0):
    return spark.createDataFrame([("w", "1.1.1.1", ip, crit, ua, gap, under, trips, cookies)], METRICS)


def scores(spark, flows, **m):
    r = S.score_flows(metrics_row(spark, **m), flows).first()["flows_score"]
    return {f["flow_id"]: f for f in r}


def test_score_two_enabled_hits(spark):
    f = flow("f", 10.0, [rule(0, "ip", 0, 1, 6), rule(1, "userAgent", 0, -1, 3), rule(2, "flightQuery", 0, 5, 4)])
    s = scores(spark, [f])["f"]
    assert math.isclose(s["score"], 30.0) and s["is_up_limited"] and s["hit_rules"] == ["R0", "R1"]


def test_score_disabled_hit_counts_in_totals(spark):
    f = flow("f", 100.0, [rule(0, "ip", 0, 1, 6), rule(1, "userAgent", 0, -1, 3), rule(2, "flightQuery", 1, -1, 4)])
    s = scores(spark, [f])["f"]
    assert math.isclose(s["score"], 13 / 30 * (60 + 360 / 13)) and round(s["score"]) == 38


def test_no_hit_scores_zero(spark):
    f = flow("f", -1.0, [rule(0, "ip", 0, 100, 6)])
    s = scores(spark, [f])["f"]
    assert s["score"] == 0.0 and s["hit_rules"] == []


def test_no_hit_not_over_limit(spark):
    f = flow("f", 0.0, [rule(0, "ip", 0, 100, 6)])
    assert scores(spark, [f])["f"]["is_up_limited"] is False


def test_second_argument_rule_and_null_gap(spark):
    f = flow("f", 0.0, [rule(0, "criticalPagesLessThanDefault", 0, 100, 5, arg1=1),
                        rule(1, "criticalPagesAccTime", 0, -1, 2)])
    s = scores(spark, [f], under=2, gap=None)["f"]
    assert s["hit_rules"] == ["R0", "R1"]  # NULL gap counts as 0 > -1


def test_flatten_keeps_below_limit_flows(spark):
    hot = flow("hot", 1.0, [rule(0, "ip", 0, 1, 6)])
    cold = flow("cold", 1000.0, [rule(1, "ip", 0, 1, 6)])
    rows = S.flatten_flows(S.score_flows(metrics_row(spark), [hot, cold])).collect()
    assert sorted(r["flow_id"] for r in rows) == ["cold", "hot"]
    assert S.flatten_flows(S.score_flows(metrics_row(spark), [cold])).count() == 0


def test_blacklist_entry_text(spark):
    f = flow("f", 10.0, [rule(0, "ip", 0, 1, 6), rule(1, "userAgent", 0, -1, 3), rule(2, "flightQuery", 0, 5, 4)])
    e = S.blacklist_entries(S.flatten_flows(S.score_flows(metrics_row(spark), [f]))).first()
    assert e["key"] == "1.1.1.1#f" and e["value"] == "30.0|R0,R1|w"


# ------------------------------------------------------- Python restatement

def py_score(values, rules):
    s = [r["score"] if values.get(r["rule_name"], 0) > (
        r["arg1"] if r["rule_name"] == "criticalPagesLessThanDefault" else r["arg0"]) else 0 for r in rules]
    en = [x for x, r in zip(s, rules) if r["rule_status"] == 0]
    total = float(sum(s))
    if not rules or total == 0:
        return 0.0
    f1 = total / (10 * len(rules))
    m = max(en) if en else 0.0
    f2 = 60 if 1 < (1.0 / 6.0) * m else (1.0 / 6.0) * m * 60
    f3 = 40 * (sum(en) / total)
    return f1 * (f2 + f3)


NAMES = ["ip", "criticalPages", "userAgent", "criticalPagesAccTime", "criticalPagesLessThanDefault",
         "flightQuery", "criticalCookies"]
rule_st = st.fixed_dictionaries({"rule_name": st.sampled_from(NAMES), "rule_status": st.sampled_from([0, 0, 1]),
                                 "arg0": st.integers(0, 4).map(float), "arg1": st.integers(0, 4).map(float),
                                 "score": st.integers(0, 9)})


@settings(max_examples=25, deadline=None)
@given(st.lists(rule_st, min_size=0, max_size=6), st.lists(st.integers(0, 6), min_size=7, max_size=7))
def test_score_matches_python(spark, rules, vals):
    rs = [dict(r, rule_order=i, rule_id=f"R{i}") for i, r in enumerate(rules)]
    values = dict(zip(NAMES, vals))
    got = scores(spark, [flow("f", 5.0, rs)], ip=vals[0], crit=vals[1], ua=vals[2], gap=vals[3],
                 under=vals[4], trips=vals[5], cookies=vals[6])["f"]["score"]
    assert math.isclose(got, py_score(values, rs), rel_tol=1e-12, abs_tol=1e-12)


def py_mask(text, pattern):
    out = text
    for m in re.finditer(pattern, text):
        g = m.group()
        i = text.index(g)
        before = text[i - 1] if i > 0 else ""
        after = text[i + len(g)] if i + len(g) < len(text) else ""
        if not before.isdigit() and not after.isdigit():
            out = out.replace(g, hashlib.md5(g.encode()).hexdigest().upper())
    return out


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["13812345678", "1381234567", "x", " ", "9", "110105199001011234",
                                 "15012345678", "1451234567X"]), max_size=8))
def test_mask_matches_python(spark, parts):
    text = "".join(parts)
    want = py_mask(py_mask(text, M.PHONE_PATTERN), M.ID_CARD_PATTERN)
    got = spark.createDataFrame([(text,)], "x string").select(M.mask_all("x")).first()[0]
    assert got == want
