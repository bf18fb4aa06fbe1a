"""Plan-shape checks: the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as entry
from skywarden.operators import rules as R
from skywarden.operators import scoring as S
from skywarden.plans import queries_scoring as qs

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_indicators_scan_events_at_most_twice(spark):
    # logs and blacklist are both derived from events; nothing rescans per indicator
    plan = optimized_of(entry.queries()["indicators_all"](spark, SF_SMALL))
    assert len(re.findall(r"Relation \[[^\]]*event_id", plan)) <= 2


def test_window_metrics_one_scan_no_join(spark):
    plan = plan_of(entry.queries()["ip_window_metrics"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_scoring_adds_no_exchange(spark):
    metrics = qs._metrics(spark, SF_SMALL)
    flows = R.collect_flows(qs._flows(spark, SF_SMALL))
    before = plan_of(metrics).count("Exchange")
    after = plan_of(S.flatten_flows(S.score_flows(metrics, flows))).count("Exchange")
    assert after == before


def test_rank_range_is_pushed_to_the_scan(spark):
    plan = plan_of(entry.queries()["occ_rank_page"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", plan)
    assert "TakeOrderedAndProject" in plan


def test_lookup_filter_is_pushed_to_the_scan(spark):
    plan = plan_of(entry.queries()["rule_monitor"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,click\)", plan)


def partition_filters(plan: str) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)


@pytest.mark.parametrize("name, bounds", [
    ("daily_flow", ["day", "kind"]), ("recent_points", ["day"]), ("whole_day_points", ["day"]), ("realtime_children", ["day"]),
    ("latest_link_map", ["day", "kind"])])
def test_time_bounds_prune_the_point_store(spark, name, bounds):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1
    for column in bounds:
        assert re.search(rf"\b{column}#", partition_filters(plan)[0]), partition_filters(plan)


def test_recent_reads_open_their_days_only(spark):
    from skywarden.operators import monitor as M
    from skywarden.plans import queries_monitor as qm
    store = qm._points(spark, SF_SMALL)
    read = M.between_minutes(store, qm.NOW, 20)
    files = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in files
    assert {f.split("day=")[1][:10] for f in read.inputFiles()} >= {"2024-01-20"}
    live = plan_of(M.liveness(store, qm.NOW))
    assert any("day#" in p for p in partition_filters(live))


def test_newest_point_reads_the_last_days(spark):
    from skywarden.operators import monitor as M
    from skywarden.plans import queries_monitor as qm
    from skywarden.sources import points as P
    path = qm._points_path(spark, SF_SMALL)
    newest = M.newest_point(P.read_newest(spark, path))
    last = {r["kind"]: str(r["day"]) for r in P.read_points(spark, path).groupBy("kind").agg({"day": "max"})
            .withColumnRenamed("max(day)", "day").collect()}
    assert {tuple(f.split("/kind=")[1].split("/")[:2]) for f in newest.inputFiles()} == {(k, f"day={d}") for k, d in last.items()}
    assert plan_of(newest).count("FileScan parquet") == 1


def test_hot_addresses_join_before_the_parse(spark):
    lines = optimized_of(entry.queries()["etl_processed"](spark, SF_SMALL)).splitlines()
    join = next(i for i, x in enumerate(lines) if "Join LeftOuter" in x)
    assert any("from_json" in x or "get_json_object" in x for x in lines[:join])
    assert not any("get_json_object" in x or "to_json" in x for x in lines[join:])
