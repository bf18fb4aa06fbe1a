"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.llm.common import staged, text_of

#: Rows of the broadcast filter at most, whatever the input: 8 MB of longs.
SLOTS = 1 << 20


def exact_duplicates(docs: DataFrame, prefix_chars: int = 256, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are first grouped by byte length, the survivors by a hash of
    their first ``prefix_chars`` characters, and only texts whose length
    and prefix occur twice are read in full and grouped by SHA-256.  The
    surviving (length, prefix) groups reach the second scan as a set of
    hashed slots of fixed size; a slot that two groups share costs a hash
    more and changes no result.  ``text_sha256`` is null where no hash was
    needed, unless ``digest`` asks for all.

    Of equal texts the row with the largest doc_id stays.  A null text is
    the empty text, and empty texts are equal.  A row without doc_id is in
    no group: keep_id null, group_size 1, kept.  Rows that repeat a doc_id
    with the same text each count, and all of them carry kept = true if
    that doc_id stays; :func:`drop_duplicates` leaves one.  Other columns
    are not read.
    """
    text = text_of(docs)
    n_bytes, prefix = F.octet_length(text), F.xxhash64(F.substring(text, 1, prefix_chars))
    slot = F.pmod(F.xxhash64("n_bytes", "prefix"), F.lit(SLOTS))
    keys = staged(docs.where(docs["doc_id"].isNotNull()).select(n_bytes.alias("n_bytes"), prefix.alias("prefix")),
                  "exact-keys")
    lengths = keys.groupBy("n_bytes").count().where("count > 1").drop("count")
    prefixes = keys.groupBy("n_bytes", "prefix").count().join(lengths, "n_bytes", "left_semi").where("count > 1")
    slots = staged(prefixes.select(slot.alias("slot")).distinct(), "exact-slots").withColumn("hit", F.lit(True))

    read = docs.select("doc_id", text.alias("text"), n_bytes.alias("n_bytes"), prefix.alias("prefix")) \
        .withColumn("slot", slot).join(F.broadcast(slots), "slot", "left")
    grouped = F.col("hit").isNotNull() & F.col("doc_id").isNotNull()
    rows = staged(read.select(
        "doc_id", grouped.alias("grouped"),
        (F.sha2("text", 256) if digest else F.when(grouped, F.sha2("text", 256))).alias("text_sha256"),
        # alone: a key of its own, so that unmatched rows spread over the join
        F.when(~grouped, F.concat(F.lit("-"), F.coalesce(F.col("doc_id"), F.col("prefix")).cast("string")))
        .alias("alone")), "exact-rows")
    groups = rows.where("grouped").groupBy(F.col("text_sha256").alias("key")) \
        .agg(F.max("doc_id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    rows = rows.withColumn("key", F.coalesce("alone", "text_sha256"))
    return rows.join(groups, "key", "left").select(
        "doc_id", F.coalesce("keep", "doc_id").alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep") == F.col("doc_id"), F.lit(True)).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` drops.

    Rows without doc_id all stay; of rows that repeat a kept doc_id with
    the same text, one stays.
    """
    found = staged(exact_duplicates(docs), "exact-found")
    sha = "__text_sha256"
    keyed = docs.withColumn(sha, F.sha2(text_of(docs), 256))
    dropped = found.where("not kept").select("doc_id", F.col("text_sha256").alias(sha)).distinct()
    left = keyed.join(dropped, ["doc_id", sha], "left_anti")
    again = staged(found.where("kept and group_size > 1").groupBy("doc_id", F.col("text_sha256").alias(sha)).count()
                   .where("count > 1").drop("count"), "exact-again")
    if not again.isEmpty():
        once = left.join(again, ["doc_id", sha], "left_semi").dropDuplicates(["doc_id", sha])
        left = left.join(again, ["doc_id", sha], "left_anti").unionByName(once)
    return left.select(*docs.columns)
