"""Running jobs: rules that change, replays, restarts, expiry, rolls and throughput points."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from skywarden.functions.parsing import serialise_processed
from skywarden.operators import scoring as S
from skywarden.operators import windows as W
from skywarden.plans import fixtures as fx
from skywarden.session import checkpoint_root
from skywarden.sources import folders, rules, sinks
from skywarden.sources.rules import RuleStore, write_rule_tables
from skywarden.sources.text import parse_processed_lines
from skywarden.streaming import jobs

from conftest import SF_SMALL
from test_streaming import AVAILABLE_NOW, FAR, ckpt, multiset, write_sequence

OLD = "2000-01-01 00:00:00"


def store_of(spark, folder, **more):
    write_rule_tables(spark, folder, fx.etl_rules(), **{"critical_pages": fx.CRITICAL_PAGES, **fx.flow_tables(spark, SF_SMALL), **more})
    return RuleStore(spark, folder)


def logs_of(spark):
    return fx.requests(fx.table(spark, SF_SMALL, "events"))


def as_lines(df):
    return df.select(serialise_processed().alias("value"))


def test_flow_config_comes_through_the_store(spark, tmpdir_path):
    store = store_of(spark, tmpdir_path)
    want = [r.asDict(True) for r in fx.flow_config(spark, SF_SMALL).orderBy("flow_id").collect()]
    assert [r.asDict(True) for r in store.flows()] == want and len(want) == 4
    assert sorted(store.critical_pages()) == sorted(fx.CRITICAL_PAGES)


def test_store_finds_edits_and_deletions_by_content(spark, tmpdir_path):
    store = store_of(spark, tmpdir_path)
    rule = fx.flow_tables(spark, SF_SMALL)["rule"]
    first = store.current()
    assert store.current().flows is first.flows          # unchanged tables are not read again
    write_rule_tables(spark, tmpdir_path, fx.etl_rules(), critical_pages=fx.CRITICAL_PAGES[:1],
                      rule=rule.withColumn("score", F.when(F.col("id") == "R0", 99).otherwise(F.col("score"))))
    second = store.current()
    scores = lambda s: {r["rule_id"]: r["score"] for f in s.flows for r in f["rules"]}
    assert scores(second) == scores(first) | {"R0": 99} and second.critical_pages == fx.CRITICAL_PAGES[:1]
    write_rule_tables(spark, tmpdir_path, fx.etl_rules(), rule=rule.where("id <> 'R0'"))
    third = store.current()
    assert set(scores(first)) - set(scores(third)) == {"R0"} and third.critical_pages == []


def test_store_reader_options():
    """Options only: no database may be started here."""
    store = RuleStore(None, fmt="jdbc", options={"url": "jdbc:mysql://host/db", "user": "u", "fetchsize": "1000"})
    assert store.reader_options("nh_rule") == {"url": "jdbc:mysql://host/db", "user": "u", "fetchsize": "1000", "dbtable": "nh_rule"}
    assert RuleStore(None, "/rules/").reader_options("nh_rule") == {"path": "/rules/nh_rule"}


def test_pinned_rules_survive_edits(spark, tmpdir_path):
    store, pins = store_of(spark, f"{tmpdir_path}/rules"), f"{tmpdir_path}/pins"
    first = store.pinned(pins, "q", 0)
    changed = fx.etl_rules()
    changed.filter_rules = [".*"]
    write_rule_tables(spark, f"{tmpdir_path}/rules", changed)
    again = RuleStore(spark, f"{tmpdir_path}/rules").pinned(pins, "q", 0)      # a new driver replays the batch
    assert again.etl.filter_rules == first.etl.filter_rules and again.at == first.at and again.flows == first.flows
    later = store.pinned(pins, "q", 1)
    assert later.etl.filter_rules == [".*"] and later.critical_pages == []
    for b in range(2, 5):
        store.pinned(pins, "q", b)
    assert folders.values(spark, f"{pins}/query=q", "batch") == ["3", "4"]
    assert sum(n.startswith(rules.FILTER_TABLE) for n in folders.children(spark, f"{pins}/tables")) == 1


def test_rule_changes_take_effect_in_a_running_scorer(spark, tmpdir_path, monkeypatch):
    """Pages, a rule's score and its deletion, each between two files of one running chain."""
    monkeypatch.setattr(jobs, "checkpoint_root", lambda s, root=f"{tmpdir_path}/shared": root)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    src, tagged, kv, rule_dir = (f"{tmpdir_path}/{d}" for d in ("in", "tagged", "kv", "rules"))
    store = store_of(spark, rule_dir)
    logs = logs_of(spark).where("remoteAddr = '10.0.0.1'").limit(1)
    def line(minute, page="/b2c/query/dom/1"):
        return as_lines(logs.withColumn("request", F.lit(page)).withColumn("timeIso8601", F.lit(f"2024-01-01T00:{minute:02d}:00+08:00")))
    rule = fx.rule_table(fx.table(spark, SF_SMALL, "nation"))
    os.makedirs(src)
    tag = jobs.tag_job(jobs.read_lines(spark, "files", src), store, tagged, checkpoint=ckpt(spark))
    score, cp = None, ckpt(spark)
    steps = [(0, None), (5, {"critical_pages": [], "rule": rule.withColumn("score", F.lit(1000))}), (10, None),
             (20, {"rule": rule.where("false")}), (30, None)]
    seen = []
    try:
        for minute, change in steps:
            if change:
                write_rule_tables(spark, rule_dir, fx.etl_rules(), **{"critical_pages": fx.CRITICAL_PAGES, **change})
            line(minute).coalesce(1).write.mode("append").text(src)
            tag.processAllAvailable()
            if score is None:
                score = jobs.scoring_job(jobs.read_tagged(spark, tagged, "1 second"), None, store, kv, watermark="1 second",
                                         checkpoint=cp)
            score.processAllAvailable()
            rows = sinks._read(spark, kv, sinks._BLACKLIST, sinks.wall_clock(spark, OLD)).collect()
            seen.append({r["rule_time"][14:16]: max(float(x["value"].split("|")[0]) for x in rows if x["rule_time"] == r["rule_time"])
                         for r in rows})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        tag.stop()
        score and score.stop()
    flags = {r["timeIso8601"][14:16]: r["critical"] for r in spark.read.parquet(tagged).collect()}
    assert flags == {"00": True, "05": False, "10": False, "20": True, "30": True}
    # A window is scored by the rules of the batch that emits it: high scores from the second step on, none after the fourth.
    assert seen[0] == {} and len(seen[2]) >= 1 and all(v > 100 for v in seen[2].values()) and seen[4] == seen[2], seen


def test_replay_with_other_rules_leaves_nothing_stale(spark, tmpdir_path):
    """A batch that was written, but never committed, runs again under its first rules, and once only."""
    src, out, rule_dir = (f"{tmpdir_path}/{d}" for d in ("in", "out", "rules"))
    store, cp = store_of(spark, rule_dir), ckpt(spark)
    fx.raw_lines(fx.table(spark, SF_SMALL, "events")).limit(200).coalesce(1).write.text(src)
    run = lambda: jobs.etl_job(jobs.read_lines(spark, "files", src), store, out, cp, AVAILABLE_NOW, with_ids=True).awaitTermination()
    run()
    first = multiset(spark.read.parquet(out), ["record_id", "value", "behaviorType"])
    nothing = fx.etl_rules()
    nothing.filter_rules = [".*"]
    write_rule_tables(spark, rule_dir, nothing)
    for name in folders.children(spark, f"{cp}/commits"):
        folders.delete(spark, f"{cp}/commits/{name}")
    run()
    assert multiset(spark.read.parquet(out), ["record_id", "value", "behaviorType"]) == first
    assert len({r[0] for r in first}) == len(first) > 0
    # Without its note the batch takes the new rules: what it wrote before is gone.
    for name in folders.children(spark, f"{cp}/commits"):
        folders.delete(spark, f"{cp}/commits/{name}")
    for q in folders.values(spark, jobs._pins(spark), "query"):
        folders.delete(spark, f"{jobs._pins(spark)}/query={q}")
    run()
    assert not any(n.startswith("behaviorType") for b in folders.values(spark, out, "batch")
                   for n in folders.children(spark, f"{out}/batch={b}"))


def test_replayed_records_are_read_once(spark, tmpdir_path):
    tagged = f"{tmpdir_path}/tagged"
    rows = jobs.with_record_id(logs_of(spark), "q-0").withColumn("critical", F.lit(False))
    assert rows.select("record_id").distinct().count() == rows.count()
    same = jobs.with_record_id(logs_of(spark).repartition(7), "q-0")
    assert {r[0] for r in same.select("record_id").collect()} == {r[0] for r in rows.select("record_id").collect()}
    rows.write.parquet(f"{tagged}/batch=q-0")
    rows.write.parquet(f"{tagged}/batch=again")     # an attempt that was not removed
    name = f"t{uuid.uuid4().hex}"
    q = (jobs.read_tagged(spark, tagged, "60 days").writeStream.format("memory").queryName(name)
         .option("checkpointLocation", ckpt(spark)).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table(name).count() == rows.count()
    topics = jobs.topic_rows(logs_of(spark), {"Query": "q", "Book": "b"}, "k")
    assert {r["topic"] for r in topics.collect()} == {"q", "b"} and topics.select("key").distinct().count() == topics.count()


def test_hot_address_streams_like_batch(spark, tmpdir_path):
    """One address on a third of the rows, with many values."""
    logs = logs_of(spark).withColumn("n", F.monotonically_increasing_id())
    logs = logs.withColumn("remoteAddr", F.when(F.col("n") % 3 == 0, "10.9.9.9").otherwise(F.col("remoteAddr"))) \
        .withColumn("httpUserAgent", F.concat(F.lit("UA"), F.col("n"))).withColumn("JSESSIONID", F.when(F.col("n") % 5 > 0, F.col("n").cast("string"))).drop("n")
    src, name = f"{tmpdir_path}/in", f"m{uuid.uuid4().hex}"
    flush = as_lines(logs.limit(1).withColumn("timeIso8601", F.lit(FAR)))
    write_sequence(src, [as_lines(logs), flush, flush])
    stream = W.ip_window_metrics_stream(parse_processed_lines(jobs.read_lines(spark, "files", src, max_files_per_trigger=1)),
                                        fx.CRITICAL_PAGES, 86400, "1 second")
    q = (stream.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", ckpt(spark)).trigger(availableNow=True).start())
    q.awaitTermination()
    want = W.ip_window_metrics(parse_processed_lines(as_lines(logs)), fx.CRITICAL_PAGES, 86400)
    assert multiset(spark.table(name), want.columns) == multiset(want, want.columns) and want.count() > 10
    assert len(q.lastProgress["stateOperators"]) == 2


def test_restart_keeps_its_state(spark, tmpdir_path):
    """A window that is open when the job stops is counted on when it goes on."""
    raw = fx.raw_lines(fx.table(spark, SF_SMALL, "events"))
    src, mon, cp = f"{tmpdir_path}/in", f"{tmpdir_path}/mon", ckpt(spark)
    late = raw.limit(1).select(F.regexp_replace("value", r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\+08:00", FAR).alias("value"))
    a, b = raw.where("hash(value) % 2 = 0"), raw.where("hash(value) % 2 <> 0")
    # The watermark must not close the windows of the first half: a year.
    run = lambda: jobs.link_job(jobs.read_lines(spark, "files", src, max_files_per_trigger=1), mon, seconds=3600,
                                watermark="365 days", checkpoint=cp, trigger=AVAILABLE_NOW).awaitTermination()
    write_sequence(src, [a])
    run()
    assert sinks.scan_monitor(spark, mon, "servers", now=OLD).count() == 0
    write_sequence(src, [b, late, late])
    run()
    got = sinks.scan_monitor(spark, mon, "servers", now=OLD).select(
        F.col("end_time").alias("window_start"), F.explode(F.col("parsed")["serversCountMap"]).alias("server", "n"))
    want = W.link_traffic(raw, 3600).select("window_start", "server", F.col("n").cast("int").alias("n"))
    assert multiset(got, ["window_start", "server", "n"]) == multiset(want, ["window_start", "server", "n"])


def test_one_throughput_point_per_batch(spark, tmpdir_path):
    src, points, n = f"{tmpdir_path}/in", f"{tmpdir_path}/points", 110
    os.makedirs(src)
    for i in range(n):
        with open(f"{src}/{i:03d}.txt", "w") as f:
            f.write("a\n" * (i + 1))
    name = f"tp{uuid.uuid4().hex[:8]}"
    listener = jobs.ThroughputListener(spark, points, {name: "DP"})
    spark.streams.addListener(listener)
    try:
        q = (jobs.read_lines(spark, "files", src, max_files_per_trigger=1).writeStream.format("noop").queryName(name)
             .option("checkpointLocation", ckpt(spark)).trigger(availableNow=True).start())
        q.awaitTermination()
        for _ in range(120):
            if folders.exists(spark, f"{points}/kind=DP") and jobs.progress_points(spark, points, "DP").count() >= n:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    got = jobs.progress_points(spark, points, "DP")
    assert got.count() == n and got.agg(F.sum("source_count")).first()[0] == n * (n + 1) // 2


# -- stores ------------------------------------------------------------------------------------------------------------

def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, value string, rule_time string")


def test_reads_open_the_hours_that_are_left(spark, tmpdir_path):
    for h in range(30):
        sinks.write_blacklist_kv(kv(spark, (f"k{h}", f"{h}|R|t", "t")), tmpdir_path, written_at=f"2024-01-{1 + h // 24:02d} {h % 24:02d}:30:00")
    now = sinks.wall_clock(spark, "2024-01-02 05:40:00")
    assert [p[-2:] for p in sinks._open_hours(spark, tmpdir_path, now)] == ["05", "06"]
    read = sinks.read_blacklist_kv(spark, tmpdir_path, "2024-01-02 05:40:00")
    assert [r["key"] for r in read.collect()] == ["k29"] and len(read.inputFiles()) <= 2
    assert sorted(r["key"] for r in sinks.read_blacklist_kv(spark, tmpdir_path, "2024-01-02 05:20:00").collect()) == ["k28", "k29"]
    assert sinks.drop_expired(spark, tmpdir_path, "2024-01-02 05:40:00") == 28
    assert folders.values(spark, tmpdir_path, "expires_hour") == ["2024-01-02-05", "2024-01-02-06"]
    assert sinks.read_blacklist_kv(spark, f"{tmpdir_path}/none", OLD).count() == 0


def test_small_batches_are_merged(spark, tmpdir_path):
    for i in range(20):
        sinks.write_blacklist_kv(kv(spark, ("k", f"{i}|R|t", f"t{i:02d}"), (f"own{i}", "1", "t")), tmpdir_path,
                                 written_at=f"2024-01-01 10:00:{i:02d}", batch_id=i)
    before = multiset(sinks.read_blacklist_kv(spark, tmpdir_path, OLD), ["key", "value"])
    assert sinks.compact(spark, tmpdir_path) == 1 and sinks.compact(spark, tmpdir_path) == 0
    assert len(folders.values(spark, f"{tmpdir_path}/expires_hour=2024-01-01-11", "batch")) == 1
    assert multiset(sinks.read_blacklist_kv(spark, tmpdir_path, OLD), ["key", "value"]) == before
    assert ("k", "19|R|t") in before and len(before) == 21


def test_backup_files_roll_by_bytes(spark, tmpdir_path):
    lines = spark.range(5000).select(F.concat(F.lit("line "), F.col("id"), F.lit(" é"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int"))).alias("value"))
    long = spark.createDataFrame([("y" * 5000,)], "value string")
    sinks.write_backup(sinks.backup_raw(lines.union(long), F.lit("2024-01-01 20:00:00").cast("timestamp")), tmpdir_path, 4096, "b")
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmpdir_path) for f in fs if f.startswith("part")]
    assert max(s for s in sizes if s != 5001) <= 4096 and sum(s > 4096 for s in sizes) == 1 and len(sizes) > 40
    back = spark.read.text(tmpdir_path)
    assert back.count() == 5001 and {r[0] for r in back.select(F.col("dt").cast("string")).distinct().collect()} == {"2024-01-02"}
    sinks.write_backup(sinks.backup_raw(lines.limit(10), F.lit("2024-01-01 20:00:00").cast("timestamp")), tmpdir_path, 4096, "b")
    assert spark.read.text(tmpdir_path).count() == 10       # a replay takes the place of its first attempt


# -- rules as data -----------------------------------------------------------------------------------------------------

def many_flows(n):
    names = list(S.METRIC_COLUMNS) + ["no such metric"]
    rule = lambda i: {"rule_order": i, "rule_id": f"R{i}", "rule_name": names[i % 8], "rule_status": i % 3 % 2,
                      "arg0": float(i % 5), "arg1": float(i % 4), "score": i % 9}
    return [{"flow_id": f"F{k}", "flow_limit": 10.0 + k, "rules": [rule(i) for i in range(k, n, 5)]} for k in range(5)] + [
        {"flow_id": "empty", "flow_limit": 0.0, "rules": []}]


def scored_by_hand(m, flow):
    rules = sorted(flow["rules"], key=lambda r: r["rule_order"])
    value = lambda r: float(m.get(S.METRIC_COLUMNS.get(r["rule_name"], ""), 0) or 0)
    hits = [value(r) > (r["arg1"] if r["rule_name"] == S.SECOND_ARG_RULE else r["arg0"]) for r in rules]
    score = [float(r["score"]) if h else 0.0 for r, h in zip(rules, hits)]
    on = [s for s, r in zip(score, rules) if r["rule_status"] == 0]
    if not sum(score):
        total = 0.0
    else:
        top = max(on, default=0.0)
        total = sum(score) / (10 * len(rules)) * ((60.0 if top / 6 > 1 else top / 6 * 60) + 40 * (sum(on) / sum(score)))
    return total, [r["rule_id"] for r, h in zip(rules, hits) if h]


@pytest.mark.parametrize("n", [25, 5000])
def test_any_number_of_rules(spark, n):
    metrics = W.ip_window_metrics(logs_of(spark), fx.CRITICAL_PAGES, 86400 * 30).limit(20)
    flows = many_flows(n)
    scored = S.score_flows(metrics, flows)
    for r in scored.collect():
        for f, flow in zip(r["flows_score"], flows):
            score, ids = scored_by_hand(r.asDict(), flow)
            assert f["score"] == pytest.approx(score, rel=1e-12) and f["hit_rules"] == ids
            assert f["is_up_limited"] == (f["score"] > flow["flow_limit"])
        assert r["any_up_limited"] == any(f["is_up_limited"] for f in r["flows_score"])


def test_plan_does_not_grow_with_the_rules(spark):
    metrics = W.ip_window_metrics(logs_of(spark), fx.CRITICAL_PAGES, 86400)
    sizes = []
    for n in (25, 5000):
        plan = S.score_flows(metrics, many_flows(n))._jdf.queryExecution().analyzed()
        text = plan.toString()
        sizes.append((plan.treeString().count("\n"), text.count("lambda"), text.count("CASE")))
    assert sizes[0] == sizes[1]


def test_untested_reads_and_writes(spark, tmpdir_path, capsys):
    from skywarden.sources.text import register_views
    logs, black = logs_of(spark), fx.blacklist(fx.table(spark, SF_SMALL, "events"))
    register_views(spark, some_logs=logs, some_blacklist=black)
    assert spark.sql("SELECT count(*) FROM some_logs l LEFT JOIN some_blacklist b ON l.remoteAddr = b.remoteAddr").first()[0] >= logs.count()
    for _ in range(2):
        sinks.append_table(black, tmpdir_path + "/t")
    assert spark.read.parquet(tmpdir_path + "/t").count() == 2 * black.count()
    sinks.console(black.limit(1), "label")
    assert "label" in capsys.readouterr().out
    entries = S.blacklist_entries(spark.createDataFrame([("w", "1.2.3.4", "F1", 1.5, "R1,R2")],
                                                        "window_start string, ip string, flow_id string, score double, hit_rules string"))
    assert entries.first()["key"] == "1.2.3.4#F1" and entries.first()["value"] == "1.5|R1,R2|w"
