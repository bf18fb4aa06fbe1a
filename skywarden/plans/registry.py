"""Query registry and the derived inputs shared by the query modules."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import indicators as ind
from ..schemas import PROCESSED
from ..session import checkpoint_root
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


_STORES: dict[tuple[str, str, str], str] = {}
# Lines of one file of the derived logs.
LOG_LINES = 4000


def derived(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a store derived from the driver tables, written once per application.

    The engine reads logs of many files and stores that others have
    written; the test tables are one file each, so the derived input is
    written first, below the shared folder of ``spark.checkpoint.dir``.
    """
    key = spark.sparkContext.applicationId, sf, name
    if key not in _STORES:
        path = f"{checkpoint_root(spark)}/derived-{uuid.uuid4().hex}/{name}"
        write(path)
        _STORES[key] = path
    return _STORES[key]


def logs(spark: SparkSession, sf: str) -> DataFrame:
    """The processed log, a parquet store of many files."""
    path = derived(spark, sf, "logs", lambda p: fx.requests(fx.table(spark, sf, "events")).write
                   .option("maxRecordsPerFile", LOG_LINES).parquet(p))
    return spark.read.schema(PROCESSED).parquet(path)


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    """The raw access log, text files as a collector leaves them."""
    path = derived(spark, sf, "raw", lambda p: fx.raw_lines(fx.table(spark, sf, "events")).write
                   .option("maxRecordsPerFile", LOG_LINES).text(p))
    return spark.read.text(path)


def blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return fx.blacklist(fx.table(spark, sf, "events"))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return ind.stage_summary(logs(spark, sf), blacklist(spark, sf))
