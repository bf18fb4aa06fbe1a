"""Time-indexed store of monitor points.

Points lie in folders by kind and day,

    <store>/kind=<kind>/day=yyyy-MM-dd/part-*

and carry their time as text (``end_time``) and as a timestamp (``ts``).
Bounds on time become bounds on ``day``, so a read lists and opens the
folders of its days and no others.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders

TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def point_time(col: str = "end_time") -> Column:
    return F.to_timestamp_ntz(F.col(col), F.lit(TIME_FMT))


def with_time(points: DataFrame) -> DataFrame:
    """Points with ``ts`` and ``day``: those of the store, or read from a text ``end_time``
    (points without a readable time are left out)."""
    if "ts" in points.columns and "day" in points.columns:
        return points
    return points.withColumn("ts", point_time()).where(F.col("ts").isNotNull()).withColumn("day", F.to_date("ts"))


def write_points(points: DataFrame, path: str) -> None:
    """Add points (kind, end_time, …) to the store, one file per kind and day."""
    with_time(points).repartition("kind", "day").write.mode("append").partitionBy("kind", "day").parquet(path)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The store; ``kind`` (text) and ``day`` (date) are partition columns."""
    return spark.read.option("basePath", path).parquet(path)


def between(points: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None,
            with_start: bool = True, with_end: bool = False) -> DataFrame:
    """Points from ``start`` to ``end``; each bound is one on the day folders and one on the time."""
    out, at = with_time(points), lambda t: F.lit(t).cast("timestamp_ntz")
    if start is not None:
        out = out.where(F.col("day") >= F.lit(start.date())).where(
            F.col("ts") >= at(start) if with_start else F.col("ts") > at(start))
    if end is not None:
        out = out.where(F.col("day") <= F.lit(end.date())).where(F.col("ts") <= at(end) if with_end else F.col("ts") < at(end))
    return out


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The points of the last day of each kind: only those folders are read.

    The last days come from the folder names, without a look into any file.
    """
    days = [f"{path}/kind={k}/day={folders.values(spark, f'{path}/kind={k}', 'day')[-1]}"
            for k in folders.values(spark, path, "kind")]
    return spark.read.option("basePath", path).parquet(*days) if days else read_points(spark, path)


def put_point(spark: SparkSession, path: str, kind: str, key: str, at: dt.datetime, **values) -> None:
    """One point under its own key; written again, it takes its own place."""
    row = {"id": key, "end_time": at.strftime("%Y-%m-%d %H:%M:%S"), "ts": at, **values}
    schema = "id string, end_time string, ts timestamp_ntz, " + ", ".join(
        f"{k} {'double' if isinstance(v, float) else 'long'}" for k, v in values.items())
    spark.createDataFrame([tuple(row.values())], schema).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/kind={kind}/day={at:%Y-%m-%d}/point={key}")
