"""Delimited text logs (A3, A4, A5) and their writers.

The processed log uses the multi-character separator ``#CS#`` and no
quoting; malformed rows (wrong field count) are skipped.  Reading the
lines as text and splitting them keeps that exact whatever the session's
CSV pruning settings: a row is kept only when it has exactly the
expected number of fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import serialise_processed
from ..schemas import BLACKLIST_FIELDS, BLACKLIST_SEP, PROCESSED_FIELDS, RAW_SEP


def _split_fields(lines: DataFrame, sep: str, names: list[str]) -> DataFrame:
    import re
    arr = F.split(F.col("value"), re.escape(sep), -1)
    return (lines.select(arr.alias("__a"))
            .filter(F.size("__a") == len(names))
            .select(*[F.get(F.col("__a"), i).alias(n) for i, n in enumerate(names)]))


def parse_processed_lines(lines: DataFrame) -> DataFrame:
    """A3 on a DataFrame of ``value`` lines (batch or stream)."""
    return _split_fields(lines, RAW_SEP, PROCESSED_FIELDS)


def read_processed_log(spark: SparkSession, path: str) -> DataFrame:
    """A3: ``#CS#``-separated processed log, 18 text fields."""
    return parse_processed_lines(spark.read.text(path))


def parse_blacklist_lines(lines: DataFrame) -> DataFrame:
    return _split_fields(lines, BLACKLIST_SEP, BLACKLIST_FIELDS)


def read_blacklist_log(spark: SparkSession, path: str) -> DataFrame:
    """A4: ``|``-separated blacklist log, 5 text fields."""
    return parse_blacklist_lines(spark.read.text(path))


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """A5: expose DataFrames to SQL under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_processed_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """B22 + sink: the 18 fields as ``#CS#`` text lines."""
    df.select(serialise_processed().alias("value")).write.mode(mode).text(path)


def write_blacklist_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """Blacklist rows (M11) as ``|`` text lines (P18: the separator between
    rule ids and time is written, so A4 reads it back)."""
    df.select(F.concat_ws(BLACKLIST_SEP, *[F.coalesce(F.col(c), F.lit("")) for c in BLACKLIST_FIELDS])
              .alias("value")).write.mode(mode).text(path)
