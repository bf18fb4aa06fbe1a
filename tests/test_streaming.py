"""Streaming = batch: each job on a file source equals the batch function."""

import os
import time
import uuid

from pyspark.sql import functions as F

from skywarden.operators import rules as R
from skywarden.operators import scoring as S
from skywarden.operators import windows as W
from skywarden.functions.parsing import serialise_processed
from skywarden.operators.etl import etl
from skywarden.plans import fixtures as fx
from skywarden.sources import sinks
from skywarden.sources.rules import RuleStore, write_rule_tables
from skywarden.sources.text import parse_processed_lines
from skywarden.session import checkpoint_root
from skywarden.streaming import jobs

from conftest import SF_SMALL

AVAILABLE_NOW = {"availableNow": True}


def ckpt(spark):
    """A fresh checkpoint under the session's shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/test-{uuid.uuid4().hex}"
FAR = "2030-01-01T00:00:00+08:00"


def multiset(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_etl_stream_equals_batch(spark, tmpdir_path):
    ev = fx.table(spark, SF_SMALL, "events")
    raw = fx.raw_lines(ev)
    src, rules_dir, out = (os.path.join(tmpdir_path, d) for d in ("in", "rules", "out"))
    raw.write.text(src)
    write_rule_tables(spark, rules_dir, fx.etl_rules(), critical_pages=fx.CRITICAL_PAGES, hot_ips=fx.hot_ips(ev))
    store = RuleStore(spark, rules_dir)
    q = jobs.etl_job(jobs.read_lines(spark, "files", src), store, out, checkpoint=ckpt(spark),
                     trigger=AVAILABLE_NOW)
    q.awaitTermination()
    got = parse_processed_lines(spark.read.text(out))
    want = etl(raw, fx.etl_rules(), fx.hot_ips(ev)).filter(F.col("behaviorType").isin("Query", "Book"))
    cols = ["request", "behaviorType", "depcity", "queryRequestDataStr", "bookRequestDataStr", "highFrqIPGroup"]
    assert got.count() == want.count() > 0
    assert multiset(got, cols) == multiset(want, cols)
    # A job with a new checkpoint starts at batch 0 again and must add to the output, not replace it.
    again = jobs.etl_job(jobs.read_lines(spark, "files", src), store, out, checkpoint=ckpt(spark), trigger=AVAILABLE_NOW)
    again.awaitTermination()
    assert spark.read.text(out).count() == 2 * want.count()


def test_rule_change_takes_effect(spark, tmpdir_path):
    ev = fx.table(spark, SF_SMALL, "events")
    rules_dir = os.path.join(tmpdir_path, "rules")
    r = fx.etl_rules()
    write_rule_tables(spark, rules_dir, r, version=1)
    store = RuleStore(spark, rules_dir)
    assert store.snapshot().filter_rules == r.filter_rules
    r.filter_rules = [r".*"]
    write_rule_tables(spark, rules_dir, r, version=2)
    snap = store.snapshot()
    assert snap.filter_rules == [r".*"]
    assert etl(fx.raw_lines(ev), snap).count() == 0


def write_sequence(folder, dfs):
    """Each DataFrame as one text file, oldest first (file sources read in
    modification-time order; one file per trigger)."""
    for k, df in enumerate(dfs):
        df.coalesce(1).write.mode("append").text(folder)
        time.sleep(1.1)


def test_scoring_stream_equals_batch(spark, tmpdir_path):
    ev = fx.table(spark, SF_SMALL, "events")
    logs = fx.requests(ev)
    src, kv = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "kv")
    flush = logs.limit(1).withColumn("timeIso8601", F.lit(FAR)).select(serialise_processed().alias("value"))
    # Batch 1 holds the data, batch 2 moves the watermark past every real
    # window, batch 3 lets the append-mode aggregate emit them.
    write_sequence(src, [logs.select(serialise_processed().alias("value")), flush, flush])

    loader = lambda: R.collect_flows(fx.flow_config(spark, SF_SMALL))
    day = 86400
    lines = jobs.read_lines(spark, "files", src, max_files_per_trigger=1)
    q = jobs.scoring_job(lines, fx.CRITICAL_PAGES, loader, kv, seconds=day, watermark="1 second",
                         checkpoint=ckpt(spark), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    got = sinks.read_blacklist_kv(spark, kv, now="2000-01-01 00:00:00")
    metrics = W.ip_window_metrics(logs, fx.CRITICAL_PAGES, day)
    entries = S.blacklist_entries(S.flatten_flows(S.score_flows(metrics, loader())))
    # The store keeps the latest value per ip#flow key (set-with-expiry).
    want = entries.groupBy("key").agg(F.max_by("value", "rule_time").alias("value"))
    assert got.count() == want.count() > 0
    assert multiset(got, ["key", "value"]) == multiset(want, ["key", "value"])


def test_link_stream_equals_batch(spark, tmpdir_path):
    ev = fx.table(spark, SF_SMALL, "events")
    raw = fx.raw_lines(ev)
    src, mon = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "mon")
    late = raw.limit(1).select(F.regexp_replace("value", r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+08:00",
                                                FAR).alias("value"))
    write_sequence(src, [raw, late, late])
    hour = 3600
    q = jobs.link_job(jobs.read_lines(spark, "files", src, max_files_per_trigger=1), mon, seconds=hour,
                      watermark="1 second", checkpoint=ckpt(spark), trigger=AVAILABLE_NOW)
    q.awaitTermination()
    pts = sinks.scan_monitor(spark, mon, "servers", now="2000-01-01 00:00:00")
    got = pts.select(F.explode(F.col("parsed")["serversCountMap"]).alias("server", "n")).groupBy("server").agg(
        F.sum("n").alias("n"))
    want = W.link_traffic(raw, hour).groupBy("server").agg(F.sum("n").alias("n"))
    assert multiset(got, ["server", "n"]) == multiset(want, ["server", "n"])


def test_backup_stream_partitions_by_day(spark, tmpdir_path):
    raw = fx.raw_lines(fx.table(spark, SF_SMALL, "events"))
    src, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "backup")
    raw.write.text(src)
    q = jobs.backup_job(jobs.read_lines(spark, "files", src), out, checkpoint=ckpt(spark),
                        trigger=AVAILABLE_NOW)
    q.awaitTermination()
    back = spark.read.text(out)
    assert "dt" in back.columns and back.count() == raw.count()


def test_method_counts_stream_equals_batch(spark, tmpdir_path):
    logs = fx.requests(fx.table(spark, SF_SMALL, "events"))
    src = os.path.join(tmpdir_path, "in")
    flush = logs.limit(1).withColumn("timeIso8601", F.lit(FAR)).select(serialise_processed().alias("value"))
    write_sequence(src, [logs.select(serialise_processed().alias("value")), flush, flush])
    stream = W.method_window_counts_stream(
        parse_processed_lines(jobs.read_lines(spark, "files", src, max_files_per_trigger=1)), 86400, "1 second")
    name = f"g5_{uuid.uuid4().hex}"
    q = (stream.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ckpt(spark)).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table(name)
    want = W.method_window_counts(logs, 86400)
    assert got.count() == want.count() > 0
    cols = ["window_start", "ip", "method", "n"]
    assert multiset(got, cols) == multiset(want, cols)
