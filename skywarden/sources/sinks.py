"""Sinks and key-value style tables.

The reference writes to a key-value store with TTLs and to relational
tables.  Here a store with expiry is a tree of folders

    <store>/expires_hour=yyyy-MM-dd-HH/batch=<key>/part-*

A batch overwrites its own folder, so a replay leaves what it writes and
nothing else.  Reads list the folders of hours that have not passed, and
no others; :func:`drop_expired` removes those that have, and
:func:`compact` merges the many small batches of an hour into one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import folders

# Time-to-live of blacklist and monitor entries, seconds.
BLACKLIST_TTL_SECONDS = 3600
MONITOR_TTL_SECONDS = 86400
# Raw backup buckets by day in this zone, files roll at 100 MB.
BACKUP_ZONE = "Asia/Shanghai"
BACKUP_ROLL_BYTES = 100 * 1024 * 1024

_HOUR = "%Y-%m-%d-%H"
_BLACKLIST = "key string, value string, rule_time string, written_at timestamp_ntz, expires_at timestamp_ntz"
_MONITOR = "kind string, key string, end_time string, value string, written_at timestamp_ntz, expires_at timestamp_ntz"


def wall_clock(spark: SparkSession, at: Column | str | dt.datetime | None = None) -> dt.datetime:
    """A moment of the session's wall clock (default: now) as a Python value."""
    if isinstance(at, dt.datetime):
        return at
    c = F.current_timestamp() if at is None else F.lit(at) if isinstance(at, str) else at
    return spark.range(1).select(c.cast("timestamp_ntz").alias("t")).first()["t"]


def _write(rows: DataFrame, path: str, at: dt.datetime, ttl: int, batch_id: int | str | None) -> None:
    """One batch into the folder of the hour in which it expires."""
    ends = at + dt.timedelta(seconds=ttl)
    folder = f"{path}/expires_hour={ends.strftime(_HOUR)}/batch={uuid.uuid4().hex if batch_id is None else batch_id}"
    rows.withColumn("written_at", F.lit(at).cast("timestamp_ntz")).withColumn("expires_at", F.lit(ends).cast("timestamp_ntz")) \
        .write.mode("overwrite").parquet(folder)


def _open_hours(spark: SparkSession, path: str, now: dt.datetime) -> list[str]:
    """Folders whose entries may be alive at ``now``: from its own hour on."""
    return [f"{path}/expires_hour={h}" for h in folders.values(spark, path, "expires_hour") if h >= now.strftime(_HOUR)]


def _read(spark: SparkSession, path: str, schema: str, now: dt.datetime) -> DataFrame:
    found = [f"{p}/batch={b}" for p in _open_hours(spark, path, now) for b in folders.values(spark, p, "batch")]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*found).where(F.col("expires_at") > F.lit(now).cast("timestamp_ntz"))


def drop_expired(spark: SparkSession, path: str, now: str | dt.datetime | None = None) -> int:
    """Remove the folders of hours that have passed; how many there were."""
    limit = wall_clock(spark, now).strftime(_HOUR)
    gone = [h for h in folders.values(spark, path, "expires_hour") if h < limit]
    for h in gone:
        folders.delete(spark, f"{path}/expires_hour={h}")
    return len(gone)


def compact(spark: SparkSession, path: str, least: int = 16) -> int:
    """Merge the batches of every hour that has ``least`` of them or more; how many hours were.

    The newest entry of a key stays.  The merged batch is written before
    the others go: reads take the newest entry per key, so they find the
    same at any moment in between, and after a crash.
    """
    done = 0
    for h in folders.values(spark, path, "expires_hour"):
        hour = f"{path}/expires_hour={h}"
        batches = folders.values(spark, hour, "batch")
        if len(batches) < least:
            continue
        rows = spark.read.parquet(*[f"{hour}/batch={b}" for b in batches])
        _newest(rows).write.parquet(f"{hour}/batch=merged-{uuid.uuid4().hex}")
        for b in batches:
            folders.delete(spark, f"{hour}/batch={b}")
        done += 1
    return done


def _newest(rows: DataFrame) -> DataFrame:
    """The newest entry per key; of entries written at once the later rule time, then the greater value."""
    rest = [c for c in rows.columns if c != "key"]
    order = [c for c in ("written_at", "rule_time", "value") if c in rest]
    return rows.groupBy("key").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("v")) \
        .select(*[F.col("key") if c == "key" else F.col(f"v.{c}").alias(c) for c in rows.columns])


def write_blacklist_kv(entries: DataFrame, path: str, written_at: Column | str | dt.datetime | None = None,
                       ttl: int = BLACKLIST_TTL_SECONDS, batch_id: int | str | None = None) -> None:
    """Write ``key -> value`` with its expiry (one batch).

    Entries are first reduced to the latest per key within the batch.  A
    replayed micro-batch overwrites its own folder if it comes with the
    same ``batch_id`` and ``written_at`` (see
    :func:`skywarden.streaming.jobs.batch_key` and
    :meth:`skywarden.sources.rules.RuleStore.pinned`).
    """
    latest = (entries.groupBy("key").agg(F.max_by(F.struct("value", "rule_time"), F.struct("rule_time", "value")).alias("v"))
              .select("key", "v.value", "v.rule_time"))
    _write(latest, path, wall_clock(entries.sparkSession, written_at), ttl, batch_id)


def read_blacklist_kv(spark: SparkSession, path: str, now: str | None = None) -> DataFrame:
    """A9 read side: latest value per key that has not expired at ``now``."""
    return _newest(_read(spark, path, _BLACKLIST, wall_clock(spark, now))).drop("written_at")


def monitor_points(kind: str, per_server: DataFrame, window_col: str = "window_start",
                   server_col: str = "server", value_col: str = "n") -> DataFrame:
    """A10 rows from per-(window, server) values: one JSON map per window,
    ``{"<kind>": {server: value}}``; key unique per kind and window."""
    pts = per_server.groupBy(window_col).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(server_col, F.col(value_col).cast("int")))))
        .alias("m"))
    return pts.select(
        F.lit(kind).alias("kind"), F.concat_ws("#", F.lit(kind), F.col(window_col)).alias("key"),
        F.col(window_col).alias("end_time"), F.to_json(F.create_map(F.lit(kind), F.col("m"))).alias("value"))


def write_monitor_points(points: DataFrame, path: str, ttl: int = MONITOR_TTL_SECONDS,
                         batch_id: int | str | None = None, written_at: Column | str | dt.datetime | None = None) -> None:
    """A10: write points with their expiry; a replayed batch overwrites its own folder."""
    _write(points.select("kind", "key", "end_time", "value"), path, wall_clock(points.sparkSession, written_at), ttl, batch_id)


def scan_monitor(spark: SparkSession, path: str, kind_prefix: str, now: str | None = None) -> DataFrame:
    """Points whose kind starts with a prefix, unexpired, JSON parsed
    (unparsable JSON dropped), in key order; a key stands once."""
    df = _read(spark, path, _MONITOR, wall_clock(spark, now)).filter(F.col("kind").startswith(kind_prefix))
    parsed = _newest(df).drop("written_at").withColumn("parsed", F.from_json("value", "map<string,map<string,int>>"))
    return parsed.filter(F.col("parsed").isNotNull()).orderBy("key")


def backup_raw(lines: DataFrame, ts_col: Column | None = None) -> DataFrame:
    """A11 layout: raw lines with their ``dt`` bucket (yyyy-MM-dd, zone)."""
    ts = ts_col if ts_col is not None else F.current_timestamp()
    # Session wall clock -> wall clock of the backup zone, whatever the
    # session time zone is.
    local = F.convert_timezone(None, F.lit(BACKUP_ZONE), ts.cast("timestamp_ntz"))
    return lines.select("value", F.date_format(local, "yyyy-MM-dd").alias("dt"))


def rolled(lines_with_dt: DataFrame, roll_bytes: int = BACKUP_ROLL_BYTES) -> DataFrame:
    """Add ``roll``, the file of each line within its day.

    Every partition of the input sums up the bytes of its own lines per day
    and cuts the sums into shares of ``roll_bytes`` less its longest line,
    so that no file grows beyond ``roll_bytes``, unless one line does.  No
    day passes through one task.
    """
    size = F.octet_length("value") + 1
    numbered = lines_with_dt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    own = Window.partitionBy("dt", "part")
    share = F.greatest(F.lit(roll_bytes) - F.max(size).over(own), F.lit(1))
    before = F.sum(size).over(own.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) - size
    return numbered.withColumn("share", share).withColumn("before", before).withColumn("roll", F.concat_ws(
        "-", F.lpad(F.col("part").cast("string"), 6, "0"), F.lpad(F.expr("before div share").cast("string"), 12, "0"))) \
        .drop("part", "at", "share", "before")


def write_backup(lines_with_dt: DataFrame, path: str, roll_bytes: int = BACKUP_ROLL_BYTES, batch_id: str | None = None) -> None:
    """Text files by day and roll, one each; a batch overwrites its own folder."""
    rolled(lines_with_dt, roll_bytes).write.mode("overwrite").partitionBy("dt", "roll").text(
        f"{path}/batch={uuid.uuid4().hex if batch_id is None else batch_id}")


def append_table(df: DataFrame, path: str | None = None, jdbc_url: str | None = None,
                 table: str | None = None, batch_size: int = 1000, props: dict | None = None) -> None:
    """One append of a result set (parquet, or JDBC in batches)."""
    if jdbc_url:
        df.write.mode("append").option("batchsize", batch_size).jdbc(jdbc_url, table, properties=props or {})
    else:
        df.write.mode("append").parquet(path)


def console(df: DataFrame, label: str = "", n: int = 20) -> None:
    """A15 (batch): print a labelled sample."""
    if label:
        print(label)
    df.show(n, truncate=False)
