"""Document fingerprints: the shingle hashes below a fixed fraction."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.llm.common import staged, text_of

#: Hashes are read as unsigned; those with so many leading zero bits stay, one in eight.
ZERO_BITS = 3


def add_sketch(df: DataFrame, text: str, out: str, words: int = 5, zero_bits: int = ZERO_BITS) -> DataFrame:
    """Add ``out``: the sorted distinct shingle hashes of a column below 2^(64 - zero_bits).

    Words are runs without ASCII white space; a shingle is ``words`` of
    them, and a text of fewer words is one shingle.  A text of which no
    shingle stays is represented by one hash over the whole of it, kept
    whatever its value, so that short texts are told apart too.
    """
    df = df.withColumn("__w", F.transform(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
                                          lambda w: F.xxhash64(w)))
    hashes = F.when(F.size("__w") < words, F.array(F.xxhash64("__w"))).otherwise(F.transform(
        F.sequence(F.lit(0), F.size("__w") - words),
        lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(words)])))
    df = df.withColumn("__h", F.array_sort(F.array_distinct(F.filter(
        hashes, lambda h: F.shiftrightunsigned(h, 64 - zero_bits) == 0))))
    kept = F.when(F.size("__h") > 0, F.col("__h")).otherwise(F.array(F.xxhash64(F.lit("whole"), F.col(text))))
    return df.withColumn(out, kept).drop("__w", "__h")


def as_string(hashes: Column) -> Column:
    """Sixteen hexadecimal digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of what two sketches were made of."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has as well, however long ``b`` is."""
    return F.size(F.array_intersect(a, b)) / F.size(a)


def merged(sketches: DataFrame, by: list[str], column: str = "sketch") -> DataFrame:
    """The sketch of each group's texts taken together, one hash a row: ``by``, hash.

    One row a hash keeps a large group out of any single task.
    """
    return sketches.select(*by, F.explode(column).alias("hash")).distinct()


#: Ranges of the order per shuffle partition, so that those that fall together are small.
RANGES = 4


def _firsts(rows: DataFrame, order: list[Column]) -> list[tuple[int, int]]:
    """The first (id, th) of each range of the order, at most ``RANGES`` times the shuffle partitions."""
    parts = RANGES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.distinct().repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    found = dealt.groupBy("part").agg(F.max(F.struct("id", "th")).alias("first")).collect()
    return sorted((tuple(r["first"]) for r in found), reverse=True)


def _followed(rows: DataFrame, firsts: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with next_text and next_sketch: those of the row that follows in falling order of (id, th).

    Each range of the order is sorted by itself.  Its last row is followed
    by the first of the next range, of which the range gets a copy: one
    row per range.  After the last row comes the first.
    """
    bounds = F.from_json(F.lit(json.dumps([{"id": i, "th": t} for i, t in firsts])), "array<struct<id:long,th:long>>")
    n, key = len(firsts), F.struct("id", "th")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, n.bit_length())))])
    # The last range that begins at or before the key, by halving.
    part = F.aggregate(steps, F.lit(-1), lambda at, step: F.when(
        (at + step < n) & (F.get(bounds, at + step) >= key), at + step).otherwise(at))
    rows = rows.withColumn("part", part)
    own = F.struct(F.col("part").alias("at"), F.lit(False).alias("copy"))
    before = F.struct(((F.col("part") + (n - 1)) % n).alias("at"), F.lit(True).alias("copy"))
    rows = rows.select("*", F.inline(F.when(F.get(bounds, F.col("part")) == key, F.array(own, before)).otherwise(F.array(own)))) \
        .drop("part")
    order = Window.partitionBy("at").orderBy("copy", F.col("id").desc(), F.col("th").desc())
    # Both in one select: one window, so one shuffle of the texts.
    return rows.select("*", F.lead("text").over(order).alias("next_text"), F.lead("sketch").over(order).alias("next_sketch")) \
        .where("not copy").drop("at", "copy")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its fingerprint, that of its edited text, and likenesses.

    Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The edited text has the
    last floor(n_chars / 3) code points replaced by the first as many (or
    all) of the next document in falling order of doc_id; after the last
    comes the first.

    The texts, of any length, are shuffled once, with their sketches, by
    ranges of the order, so each is sketched once as itself and once
    edited.

    A null text is the empty text.  Rows without doc_id come last in the
    order; rows that share a doc_id stand in the order of a hash of their
    texts, and repeated rows are one document there.  A table of one
    document is its own next; an empty one gives no rows.  Other columns
    are not read.
    """
    texts = docs.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), text_of(docs).alias("text")) \
        .withColumn("th", F.xxhash64("text"))
    rows = staged(texts.select("id", "th"), "print-rows")
    firsts = _firsts(rows, [F.col("id").desc(), F.col("th").desc()])
    repeated = not rows.groupBy("id", "th").count().where("count > 1").isEmpty()
    if repeated:
        texts = texts.groupBy("doc_id", "id", "th").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    own = _followed(add_sketch(texts, "text", "sketch"), firsts or [(0, 0)])
    own = own.withColumn("n_chars", F.length("text")).withColumn("n_cut", F.expr("n_chars div 3").cast("int"))
    own = own.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - n_cut)"), F.expr("substring(next_text, 1, n_cut)")))
    if repeated:
        own = own.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    own = add_sketch(own, "edited", "edited_sketch")
    return own.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"), as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
