"""Text logs, key-value store with TTL, monitor points."""

import os

from pyspark.sql import functions as F

from skywarden.plans import fixtures as fx
from skywarden.sources import sinks
from skywarden.sources.text import (read_blacklist_log, read_processed_log, write_blacklist_log,
                                    write_processed_log)

from conftest import SF_SMALL


def test_processed_log_round_trip_drops_malformed(spark, tmpdir_path):
    logs = fx.requests(fx.table(spark, SF_SMALL, "events"))
    path = os.path.join(tmpdir_path, "processed")
    write_processed_log(logs, path)
    spark.createDataFrame([("too#CS#short",), ("a" + "#CS#x" * 18,)], "value string").write.mode("append").text(path)
    back = read_processed_log(spark, path)
    assert back.count() == logs.count()
    want = logs.select(*[F.when(F.col(c) == "", "NULL").otherwise(F.col(c)).alias(c) for c in logs.columns])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_blacklist_log_round_trip(spark, tmpdir_path):
    bl = fx.blacklist(fx.table(spark, SF_SMALL, "events"))
    path = os.path.join(tmpdir_path, "bl")
    write_blacklist_log(bl, path)
    back = read_blacklist_log(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, bl.collect()))


def test_kv_latest_and_ttl(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "kv")
    schema = "key string, value string, rule_time string"
    t1 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    t2 = F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    sinks.write_blacklist_kv(spark.createDataFrame([("ip#f", "1|R1|a", "a"), ("ip#g", "2|R2|a", "a")], schema),
                             path, written_at=t1)
    sinks.write_blacklist_kv(spark.createDataFrame([("ip#f", "3|R3|b", "b")], schema), path, written_at=t2)
    at = {r["key"]: r["value"] for r in sinks.read_blacklist_kv(spark, path, "2024-01-01 00:45:00").collect()}
    assert at == {"ip#f": "3|R3|b", "ip#g": "2|R2|a"}
    later = {r["key"] for r in sinks.read_blacklist_kv(spark, path, "2024-01-01 01:10:00").collect()}
    assert later == {"ip#f"}


def test_kv_replayed_batch_does_not_duplicate(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "kv")
    df = spark.createDataFrame([("ip#f", "1|R1|a", "a")], "key string, value string, rule_time string")
    for _ in range(2):
        sinks.write_blacklist_kv(df, path, batch_id=7)
    assert spark.read.parquet(path).count() == 1


def test_monitor_points_scan(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "mon")
    per = spark.createDataFrame([("w1", "s1", 3), ("w1", "s2", 4), ("w2", "s1", 1)],
                                "window_start string, server string, n long")
    sinks.write_monitor_points(sinks.monitor_points("serversCountMap", per), path)
    pts = sinks.scan_monitor(spark, path, "servers", now="2000-01-01 00:00:00").collect()
    assert [p["key"] for p in pts] == ["serversCountMap#w1", "serversCountMap#w2"]
    assert pts[0]["parsed"]["serversCountMap"] == {"s1": 3, "s2": 4}
    assert pts[0]["value"] == '{"serversCountMap":{"s1":3,"s2":4}}'


def test_monitor_points_replay_is_idempotent(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "mon")
    per = spark.createDataFrame([("w1", "s1", 3)], "window_start string, server string, n long")
    for _ in range(2):
        sinks.write_monitor_points(sinks.monitor_points("serversCountMap", per), path, batch_id=3)
    assert spark.read.parquet(path).count() == 1


def test_backup_day_in_zone(spark):
    df = spark.createDataFrame([("x",)], "value string")
    ts = F.lit("2024-01-01 20:00:00").cast("timestamp")   # session zone is UTC in tests
    assert sinks.backup_raw(df, ts).first()["dt"] == "2024-01-02"


def test_rule_store_without_tables_is_empty(spark, tmpdir_path):
    from skywarden.plans import fixtures as fx
    from skywarden.operators.etl import etl
    from skywarden.sources.rules import RuleStore
    store = RuleStore(spark, os.path.join(tmpdir_path, "no-rules"))
    snap = store.snapshot()
    assert snap.filter_rules == [] and snap.query_rules == [] and store.hot_ips() is None
    raw = fx.raw_lines(fx.table(spark, SF_SMALL, "events"))
    out = etl(raw, snap)            # nothing filtered, everything classified Other
    assert out.count() == raw.count()
    assert {r[0] for r in out.select("behaviorType").distinct().collect()} == {"Other"}


def test_checkpoint_root_uses_session_setting(spark):
    from skywarden.session import checkpoint_root
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
