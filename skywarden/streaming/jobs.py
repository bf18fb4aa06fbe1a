"""Structured Streaming jobs: the three data paths as running queries.

* ``etl_job``     raw lines -> ETL (rule snapshot per micro-batch) ->
                  processed log per behaviour (A1, A7, G6, C3, A8);
* ``tag_job``     processed lines -> logs with the critical-page flag of
                  the rules at their arrival (E3, D5);
* ``scoring_job`` (tagged) logs -> 10 s per-IP windows (watermarked,
                  append mode) -> flow scores -> blacklist store (G1, I*, A9);
* ``link_job``    raw lines -> 5 s per-server traffic / active connections
                  -> monitor points with TTL (G3, G4, A10);
* ``backup_job``  raw lines -> day-bucketed text files (A11);
* ``ThroughputListener`` one throughput point per micro-batch (M14).

Every job keeps its progress in a checkpoint under the shared folder
named by ``spark.checkpoint.dir``.  Every ``foreachBatch`` write goes to a
folder of its own, named by the query id of the checkpoint and the batch
id, and overwrites it: a replayed batch after an executor or driver loss
leaves what it writes and nothing of the attempt before, and a job with a
new checkpoint leaves the output of earlier ones alone.  Rules and time of
a batch are pinned by its first attempt (``RuleStore.pinned``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.parsing import serialise_processed
from ..functions.tags import matches_any
from ..operators import scoring as S
from ..operators import windows as W
from ..operators.etl import etl
from ..schemas import PROCESSED
from ..session import checkpoint_root
from ..sources import points as P
from ..sources import sinks
from ..sources.rules import ETL_TABLES, FLOW_TABLES, PAGE_TABLES, RuleStore, Snapshot
from ..sources.text import parse_processed_lines

# Window lengths of the scorer and the link monitor.
SCORING_WINDOW_SECONDS = 10
LINK_WINDOW_SECONDS = 5
BACKUP_TRIGGER = "10 seconds"


def read_lines(spark: SparkSession, source: str = "files", path: str | None = None,
               servers: str | None = None, topic: str | None = None, starting: str = "latest",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A1 / A2: a stream of ``value`` text lines.

    ``source="kafka"`` reads a topic (``starting`` = latest / earliest;
    restarts resume from the checkpoint), ``"files"`` a folder of text
    files (tests, replays).
    """
    if source == "kafka":
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic).option("startingOffsets", starting).load()
                .select(F.col("value").cast("string").alias("value")))
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _ckpt(spark: SparkSession, name: str, given: str | None) -> str:
    return given or f"{checkpoint_root(spark)}/{name}"


def _trigger(w, trigger: dict | None):
    return w.trigger(**trigger) if trigger else w


def query_id(df: DataFrame) -> str:
    """Within ``foreachBatch``: the id of the query, which lives as long as its checkpoint."""
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("no streaming query is running in this thread")
    return query


def batch_key(df: DataFrame, batch_id: int) -> str:
    """Key of a micro-batch: the id of the query and the number of the batch."""
    return f"{query_id(df)}-{batch_id}"


def _pins(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/rule-pins"


def pinned_rules(df: DataFrame, batch_id: int, store: RuleStore, names: list[str]) -> Snapshot:
    """Rules (of the tables ``names``) and time of a micro-batch, those of its first attempt."""
    return store.pinned(_pins(df.sparkSession), query_id(df), batch_id, names)


def with_record_id(rows: DataFrame, key: str) -> DataFrame:
    """P10: add ``record_id``, the same on every attempt of a batch.

    It is a hash of the batch's key, the row's content and its place among
    the equal rows of the batch, which are interchangeable.  Equal rows are
    counted before they are numbered, so that many of them are no more than
    one in the shuffle.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n"))
    numbered = counted.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), "__n")).alias("__k"))
    content = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
               for c in rows.columns]
    return numbered.select(F.sha2(F.concat_ws("|", F.lit(key), *content, "__k"), 256).alias("record_id"), *rows.columns)


def once(records: DataFrame, watermark: str = "10 minutes", time: str = "__et") -> DataFrame:
    """Reading side of P10: records that come again within the watermark are dropped (state bounded by it)."""
    return records.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["record_id"])


def etl_job(lines: DataFrame, store: RuleStore, out_dir: str, checkpoint: str | None = None,
            trigger: dict | None = None, query_name: str = "etl", with_ids: bool = False):
    """Raw lines -> processed log, ``out_dir``/batch=<key>/behaviorType=<type>.

    The rule snapshot is that of the micro-batch (A7/G6); ``Other``
    requests are dropped (C3).  Text lines, or with ``with_ids`` parquet
    rows of record_id and value.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        rules, key = pinned_rules(df, batch_id, store, ETL_TABLES), batch_key(df, batch_id)
        out = (etl(df, rules.etl, rules.hot_ips).filter(F.col("behaviorType").isin("Query", "Book"))
               .select(serialise_processed().alias("value"), "behaviorType"))
        w = (with_record_id(out, key) if with_ids else out).write.mode("overwrite").partitionBy("behaviorType")
        w.format("parquet" if with_ids else "text").save(f"{out_dir}/batch={key}")

    w = (lines.writeStream.queryName(query_name).foreachBatch(batch)
         .option("checkpointLocation", _ckpt(lines.sparkSession, query_name, checkpoint)))
    return _trigger(w, trigger).start()


def topic_rows(processed: DataFrame, topics: dict[str, str], key: str) -> DataFrame:
    """(topic, key, value), one topic per behaviour; the key is the record id (P10)."""
    topic = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v))])
    out = (processed.filter(F.col("behaviorType").isin(*topics))
           .select(F.element_at(topic, F.col("behaviorType")).alias("topic"), serialise_processed().alias("value")))
    return with_record_id(out, key).select("topic", F.col("record_id").alias("key"), "value")


def topic_job(lines: DataFrame, store: RuleStore, servers: str, topics: dict[str, str], checkpoint: str | None = None,
              trigger: dict | None = None, query_name: str = "etl-topics"):
    """Raw lines -> one topic per behaviour (at least once; see :func:`once`)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        rules = pinned_rules(df, batch_id, store, ETL_TABLES)
        topic_rows(etl(df, rules.etl, rules.hot_ips), topics, batch_key(df, batch_id)) \
            .write.format("kafka").option("kafka.bootstrap.servers", servers).save()

    w = (lines.writeStream.queryName(query_name).foreachBatch(batch)
         .option("checkpointLocation", _ckpt(lines.sparkSession, query_name, checkpoint)))
    return _trigger(w, trigger).start()


TAGGED = "record_id string, " + ", ".join(f"{f.name} string" for f in PROCESSED.fields) + ", critical boolean"


def tag_job(processed_lines: DataFrame, store: RuleStore, tagged_dir: str, checkpoint: str | None = None,
            trigger: dict | None = None, query_name: str = "tag"):
    """Processed lines -> logs with record id and critical-page flag.

    A page is critical by the rules of the micro-batch in which its line
    arrives, as in the reference; edits take effect with the next batch.
    Each batch is a folder below ``tagged_dir`` (see :func:`read_tagged`).
    """
    logs = parse_processed_lines(processed_lines)

    def batch(df: DataFrame, batch_id: int) -> None:
        rules, key = pinned_rules(df, batch_id, store, PAGE_TABLES), batch_key(df, batch_id)
        with_record_id(df, key).withColumn("critical", matches_any("request", rules.critical_pages)) \
            .write.mode("overwrite").parquet(f"{tagged_dir}/batch={key}")

    w = (logs.writeStream.queryName(query_name).foreachBatch(batch)
         .option("checkpointLocation", _ckpt(processed_lines.sparkSession, query_name, checkpoint)))
    return _trigger(w, trigger).start()


def read_tagged(spark: SparkSession, tagged_dir: str, watermark: str = "30 seconds",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of what :func:`tag_job` writes, each record once.

    A batch that was written, but not committed, is written again under the
    same record ids; files of the first attempt that are gone by then are
    passed over.
    """
    r = spark.readStream.schema(TAGGED).option("ignoreMissingFiles", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = r.parquet(f"{tagged_dir}/batch=*").withColumn("__et", W.watermark_time(W.event_time("timeIso8601")))
    return once(rows.where(F.col("__et").isNotNull()), watermark)


def scoring_job(logs: DataFrame, critical_pages: list[str] | None, flows: RuleStore | Callable[[], list], kv_path: str,
                checkpoint: str | None = None, seconds: int = SCORING_WINDOW_SECONDS, watermark: str = "30 seconds",
                trigger: dict | None = None, query_name: str = "scoring"):
    """Logs -> per-IP window metrics -> scores -> blacklist.

    ``logs`` are processed lines (``value``) with fixed ``critical_pages``,
    or the tagged logs of :func:`read_tagged`, whose flag follows the
    rules.  The window aggregates are stateful (state store, watermark);
    scoring is a narrow projection per emitted batch, with the flows of a
    rule store at that batch, or of a loader.
    """
    spark = logs.sparkSession
    if "critical" in logs.columns:
        metrics = W.ip_window_metrics_stream(logs, F.col("critical"), seconds, watermark)
    else:
        metrics = W.ip_window_metrics_stream(parse_processed_lines(logs), critical_pages, seconds, watermark)

    def batch(df: DataFrame, batch_id: int) -> None:
        rules = pinned_rules(df, batch_id, flows, FLOW_TABLES) if isinstance(flows, RuleStore) else None
        rows = S.flatten_flows(S.score_flows(df, rules.flows if rules else flows()))
        sinks.write_blacklist_kv(S.blacklist_entries(rows), kv_path, batch_id=batch_key(df, batch_id),
                                 written_at=rules.at if rules else None)

    w = (metrics.writeStream.queryName(query_name).outputMode("append").foreachBatch(batch)
         .option("checkpointLocation", _ckpt(spark, query_name, checkpoint)))
    return _trigger(w, trigger).start()


def link_job(raw_lines: DataFrame, monitor_path: str, checkpoint: str | None = None,
             seconds: int = LINK_WINDOW_SECONDS, watermark: str = "10 seconds",
             trigger: dict | None = None, query_name: str = "link"):
    """G3 + G4 -> A10: per-server traffic and latest active connections."""
    f = (W.raw_server_fields(raw_lines).filter(F.col("ts").isNotNull())
         .withColumn("win", W.window_start(F.col("ts"), seconds))
         .withColumn("__et", W.watermark_time(F.col("ts"))).withWatermark("__et", watermark))
    agg = (f.groupBy(F.window("__et", f"{int(seconds)} seconds").alias("w"), "win", "server")
           .agg(F.count(F.lit(1)).alias("n"),
                F.max_by("active", F.struct("ts", "active")).alias("active")))
    out = agg.select(W.fmt_time(F.col("win")).alias("window_start"), "server", "n", "active")

    def batch(df: DataFrame, batch_id: int) -> None:
        pts = sinks.monitor_points("serversCountMap", df).unionByName(
            sinks.monitor_points("activeNumMap", df.filter(F.col("active").isNotNull()), value_col="active"))
        sinks.write_monitor_points(pts, monitor_path, batch_id=batch_key(df, batch_id))

    w = (out.writeStream.queryName(query_name).outputMode("append").foreachBatch(batch)
         .option("checkpointLocation", _ckpt(raw_lines.sparkSession, query_name, checkpoint)))
    return _trigger(w, trigger).start()


def backup_job(raw_lines: DataFrame, path: str, checkpoint: str | None = None,
               trigger: dict | None = None, roll_bytes: int = sinks.BACKUP_ROLL_BYTES,
               query_name: str = "backup"):
    """Raw lines to ``dt=yyyy-MM-dd`` folders (Asia/Shanghai day);
    a file rolls every trigger (10 s) and at ``roll_bytes``."""
    def batch(df: DataFrame, batch_id: int) -> None:
        sinks.write_backup(sinks.backup_raw(df), path, roll_bytes, batch_key(df, batch_id))

    w = (raw_lines.writeStream.queryName(query_name).foreachBatch(batch)
         .option("checkpointLocation", _ckpt(raw_lines.sparkSession, query_name, checkpoint)))
    return _trigger(w, trigger or {"processingTime": BACKUP_TRIGGER}).start()


def console_job(df: DataFrame, label: str = "", trigger: dict | None = None):
    """Print each micro-batch."""
    w = df.writeStream.format("console").option("truncate", "false")
    if label:
        w = w.queryName(label)
    return _trigger(w, trigger).start()


class ThroughputListener(StreamingQueryListener):
    """Writes one throughput point per micro-batch to the point store.

    Every report of a query named in ``kinds`` (query name -> kind) becomes
    a point of its own: end time, input rows, cost in ms and rows per ms.
    Its key is the query id and the batch id, so a report that comes again
    takes its own place.  Register with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, kinds: dict[str, str]):
        self.spark, self.path, self.kinds = spark, path, kinds

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name not in self.kinds:
            return
        cost = int(p.durationMs.get("triggerExecution", p.batchDuration))
        ends = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).replace(tzinfo=None) + dt.timedelta(milliseconds=cost)
        P.put_point(self.spark, self.path, self.kinds[p.name], f"{p.id}-{p.batchId}", ends.replace(microsecond=0),
                    source_count=int(p.numInputRows), cost_time=cost,
                    count_per_millis=float(p.numInputRows) / cost if cost else 0.0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_points(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """M14 throughput points of one kind, as :class:`ThroughputListener` wrote them."""
    return P.read_points(spark, path).where(F.col("kind") == kind) \
        .select("kind", "end_time", "source_count", "cost_time", "count_per_millis")
