"""Staging, exact distributed ranks and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skywarden.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Executors need not have it installed; Spark's file server hands out
    the archive, as with ``--py-files``.
    """
    sc = spark.sparkContext
    if getattr(sc, "_skywarden_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="skywarden-"), "skywarden.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "skywarden")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    sc._skywarden_shipped = True


def text_of(docs: DataFrame) -> Column:
    """The text, with null read as the empty string."""
    return F.coalesce(docs["text"], F.lit(""))


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table that every executor can read again, and
    gives the optimizer true sizes for what follows.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lookup(rows: DataFrame, found: DataFrame, keys: list[str], hot: Column, salts: int = 64) -> DataFrame:
    """Left join with ``found`` (one row per key), safe where many ``rows`` share a key.

    Keys for which ``hot`` holds are copied to ``salts`` tasks, among which
    their rows are dealt; all others are joined plainly.
    """
    values = [c for c in found.columns if c not in keys]
    hot = F.coalesce(hot, F.lit(False))
    many = found.where(hot).select(*keys, F.struct(*values).alias("__many"),
                                   F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    few = found.where(~hot).select(*keys, F.struct(*values).alias("__few"), F.lit(-1).alias("__salt"))
    out = rows.withColumn("__salt", (F.rand(5) * salts).cast("int")).join(many, [*keys, "__salt"], "left") \
        .withColumn("__salt", F.when(F.col("__many").isNotNull(), F.col("__salt")).otherwise(-1)) \
        .join(few, [*keys, "__salt"], "left").withColumn("__found", F.coalesce("__many", "__few"))
    return out.select(*rows.columns, *[F.col("__found")[c].alias(c) for c in values])


def ranked(df: DataFrame, by: list[str], order: list[str], out: str,
           chunk_rows: int = 5_000) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each group of ``by``.

    A group larger than ``chunk_rows`` is cut into chunks by a hash of the
    ``order`` columns and each chunk numbered on its own, so that no task
    sorts a whole group.  Numbers run in ``order`` inside a chunk only.
    Rows equal in ``order`` get different numbers.  ``df`` is read three
    times: stage it first.  Null is a group like any other.
    """
    keys = by or ["__all"]
    if not by:
        df = df.withColumn("__all", F.lit(0))
    same = lambda a, b, cols: [a[c].eqNullSafe(b[c]) for c in cols]
    big = staged(df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > chunk_rows)
                 .withColumn("__chunks", F.ceil(F.col("__n") / chunk_rows)).drop("__n"), "rank-big")
    plain = df.columns
    df = df.join(big, same(df, big, keys), "left").select(
        *[df[c] for c in plain],
        F.coalesce(F.pmod(F.xxhash64(*[df[c] for c in order]), big["__chunks"]), F.lit(0)).alias("__chunk"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(df.join(big, same(df, big, keys), "left_semi").groupBy(*keys, "__chunk")
                    .agg(F.count("*").alias("__n"))
                    .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"), "rank-starts")
    place = F.row_number().over(Window.partitionBy(*keys, "__chunk").orderBy(*order)) - 1
    df = df.withColumn("__place", place)
    df = df.join(starts, same(df, starts, [*keys, "__chunk"]), "left").select(
        *[df[c] for c in plain], (F.coalesce(starts["__start"], F.lit(0)) + df["__place"]).cast("long").alias(out))
    return df if by else df.drop("__all")


def _is_forest(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: a star around each root."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")) \
        .unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    return ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in")) \
        .where("out > 1 or out > 0 and in > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over (u, v) edges.

    Alternates large-star and small-star steps, each two joins and a
    pre-aggregated minimum, until every edge points at a root.  A chain of
    n links needs about log(n) rounds.  Nodes without edges are absent.
    """
    def by_min(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    edges = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .where(F.col("u") != F.col("v")).distinct(), "cc")
    while not _is_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(by_min(both), "u").where(F.col("v") > F.col("u")) \
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        small = large.join(by_min(large), "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")) \
            .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        done, edges = edges, staged(small, "cc")
        drop_staged(done)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
