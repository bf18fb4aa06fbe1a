"""Near duplicates: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skywarden.llm.common import components, ship_package, staged

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``words``-word shingles.

    A-Z are lower-cased and words end at ASCII white space.  A text of
    fewer words is one shingle; a text without words has none.
    """
    parts = text.translate(_LOWER).split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed((out + h[i:i + len(out)]) * _ODD[0])
    return np.unique(out)


def sketch(hashes: np.ndarray, bins: int) -> np.ndarray:
    """Fast similarity sketch: ``bins`` coordinates, all of them filled.

    Round i < bins throws every element into a hashed bin with value
    i + hash fraction; round bins + j throws all into bin j.  A bin keeps
    its least value, so rounds after the one that fills the last bin
    change nothing, and 2 * bins rounds always suffice.
    """
    out = np.full(bins, ~np.uint64(0))
    done, step = 0, max(1, math.ceil(bins * (math.log(bins) + 1) / max(1, len(hashes))))
    while done < bins:
        rounds = np.arange(done, min(bins, done + step), dtype=np.uint64)
        h = _mixed((hashes[None, :] ^ ((rounds[:, None] + np.uint64(1)) * _ODD[0])))
        at = (((h >> np.uint64(40)) * np.uint64(bins)) >> np.uint64(24)).astype(np.int64)
        value = (rounds[:, None] << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))
        np.minimum.at(out, at.ravel(), value.ravel())
        done += len(rounds)
        if out.max() != ~np.uint64(0):
            return out
        step = 4
    for j in np.flatnonzero(out == ~np.uint64(0)):
        h = _mixed(hashes ^ (np.array([bins + j + 1], np.uint64) * _ODD[0]))
        out[j] = (np.uint64(bins + int(j)) << np.uint64(40)) | (h & np.uint64((1 << 40) - 1)).min()
    return out


def bands_for(percent: int, rows: int = 4, miss: float = 1e-6) -> int:
    """Bands of ``rows`` coordinates that miss a pair at the threshold with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _signer(words: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _mixed(np.arange(1, bands + 1, dtype=np.uint64) * _ODD[0])
        for batch in batches:
            ids, counts, sets, keys = batch.column(0), [], [], []
            for text in batch.column(1):
                h = shingle_hashes(text.as_py() or b"", words)
                counts.append(len(h))
                if not len(h):
                    sets.append(None)
                    keys.append(None)
                    continue
                sets.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                s, key = sketch(h, bands * rows).reshape(bands, rows), seeds
                for i in range(rows):
                    key = _mixed((key + s[:, i]) * _ODD[0])
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(counts, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_id", "bands"])
    return run


def _setter(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([shingle_hashes(t.as_py() or b"", words).view(np.int64)
                                               for t in part.column(1)], pa.list_(pa.int64()))], ["node", "hashes"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (u, v) whose full sets reach the threshold."""
    a = sets.select(F.col("node").alias("u"), F.col("hashes").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("hashes").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(a, "u").join(b, "v") \
        .withColumn("both", both) \
        .where(100 * F.col("both") >= percent * (F.size("a") + F.size("b") - F.col("both"))).select("u", "v")


def rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(node, key, after): of each set the shingles of which a linked set must hold one at least.

    A set of n shingles shares percent * n / 100 of them with any set it is
    linked to.  With all shingles in one order, the rarest first, two such
    sets meet among the first n - ceil(percent * n / 100) + 1 of each.
    ``after`` counts the shingles of the set from this one on: at the first
    one that two sets share, no more than the lesser count are shared.
    Shingles that no other set holds come first and are left out, so a set
    that differs from all others in enough of them has none to look at.
    """
    each = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    often = each.groupBy("hash").agg(F.count("*").alias("df")).where("df > 1")
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("held"))
    return each.join(often, "hash").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "hash"))).alias("held")) \
        .withColumn("first", first.cast("int")).where("first > 0") \
        .select("node", F.size("held").alias("size"), F.posexplode(F.slice("held", F.lit(1), F.col("first"))["hash"])
                .alias("pos", "key")).select("node", "key", (F.col("size") - F.col("pos")).alias("after"))


_PAIR = ["least(node, node_2) u", "greatest(node, node_2) v"]


def _other(df: DataFrame) -> DataFrame:
    return df.select("key", *[F.col(c).alias(f"{c}_2") for c in df.columns if c != "key"])


def _close(percent: int) -> Column:
    return 100 * F.least("n", "n_2") >= percent * F.greatest("n", "n_2")


def star_pairs(members: DataFrame, percent: int, centres: int) -> DataFrame:
    """(u, v): each member of a bucket with its most central one, which shares most buckets, and ``centres`` others.

    The others are the least of the bucket in orders that all buckets
    share, so the buckets of one group choose mostly the same and a member
    of a large group has few partners, however many buckets it lies in.
    No bucket is sorted.
    """
    weighed = members.join(members.groupBy("node").agg(F.sum("size").alias("weight")), "node")
    by = [-F.col("weight"), *[F.xxhash64("node", F.lit(i)) for i in range(centres)]]
    chosen = weighed.groupBy("key").agg(*[F.min_by(c, o).alias(f"{c}_{i}") for i, o in enumerate(by) for c in ("node", "n")]) \
        .select("key", F.explode(F.array_distinct(F.array(*[F.struct(F.col(f"node_{i}").alias("node"), F.col(f"n_{i}").alias("n"))
                                                            for i in range(len(by))]))).alias("c")).select("key", "c.*")
    return members.join(_other(chosen), "key").where(_close(percent) & (F.col("node") != F.col("node_2"))) \
        .selectExpr(*_PAIR).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, rows: int = 4, centres: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |A & B| >= percent * |A | B| on
    their sets of distinct ``words``-word shingles (64-bit hashes of whole
    texts).  component_id is the smallest doc_id reachable over links, the
    document itself included; kept says that it is that document.

    Documents with the same set form a class, named by its smallest
    doc_id; only classes are banded.  In a bucket of equal band keys every
    member is first verified against a few (:func:`star_pairs`), so a group
    of near copies costs a few stars and not a square.  A bucket that is then still in several components has
    the members outside its largest one compared with those that are not
    of their own component, share a bucket with them and hold one of their
    rarest shingles (:func:`rarest`), which loses no pair at the threshold.

    A text that is null or without words has an empty set and is linked
    with nothing.  A row without doc_id is linked with nothing either:
    component_id null, kept.  Rows that repeat a doc_id are each judged by
    their own text.  Other columns are not read.
    """
    ship_package(docs.sparkSession)
    bands = bands_for(percent, rows)
    signed = staged(docs.select("doc_id", docs["text"].cast("binary").alias("text"))
                    .mapInArrow(_signer(words, bands, rows), "doc_id long, n_shingles long, set_id binary, bands array<long>"),
                    "near-signed")
    named = signed.where("doc_id is not null and set_id is not null")
    classes = staged(named.groupBy("set_id").agg(
        F.min(F.struct("doc_id", "n_shingles", "bands")).alias("c"), F.count("*").alias("copies"))
        .select("set_id", F.col("c.doc_id").alias("node"), F.col("c.n_shingles").alias("n"), "c.bands", "copies"),
                     "near-classes")
    keyed = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("lo"), F.max("node").alias("hi")) \
        .where("lo < hi").select("key", "size")
    members = staged(keyed.join(shared, "key"), "near-members")
    needed = members.select(F.col("node").alias("doc_id")).distinct()
    sets = staged(docs.select("doc_id", docs["text"].cast("binary").alias("text")).join(needed, "doc_id", "left_semi")
                  .mapInArrow(_setter(words), "node long, hashes array<long>"), "near-sets")

    close = _close(percent)
    stars = star_pairs(members, percent, centres)
    linked = staged(components(_verified(stars, sets, percent)), "near-linked")

    now = members.where(F.col("size") > 2).join(linked, "node", "left") \
        .select("key", "node", "n", F.coalesce("component", "node").alias("c"))
    largest = now.groupBy("key", "c").count().groupBy("key").agg(
        F.max_by("c", F.struct("count", "c")).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    now = staged(now.join(largest, "key").groupBy("node", "n", "c").agg(F.max(F.col("c") != F.col("main")).alias("out"))
                 .join(classes.select("node", "bands"), "node"), "near-open")
    found = now.join(rarest(sets.join(now.select("node"), "node", "left_semi"), percent), "node")
    enough = (100 + percent) * F.least("after", "after_2") >= percent * (F.col("n") + F.col("n_2"))
    once = (~F.col("out_2") | (F.col("node") < F.col("node_2"))) & (F.col("c") != F.col("c_2"))
    rest = found.where("out").join(_other(found), "key") \
        .where(once & close & enough & F.arrays_overlap("bands", "bands_2")).selectExpr(*_PAIR).distinct()
    c_u = linked.select(F.col("node").alias("u"), F.col("component").alias("c_u"))
    c_v = linked.select(F.col("node").alias("v"), F.col("component").alias("c_v"))
    joined = staged(components(
        _verified(rest, sets, percent).join(c_u, "u", "left").join(c_v, "v", "left")
        .select(F.coalesce("c_u", "u").alias("u"), F.coalesce("c_v", "v").alias("v"))), "near-joined")

    copies = classes.where("copies > 1").select("set_id", F.col("node").alias("class"))
    out = signed.select("doc_id", "n_shingles", F.coalesce(
        F.when(F.col("doc_id").isNotNull(), F.col("set_id")),
        F.coalesce("doc_id", F.xxhash64("set_id")).cast("string").cast("binary")).alias("set_id"))
    out = out.join(copies, "set_id", "left") \
        .withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))) \
        .join(linked, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component") \
        .join(joined.withColumnRenamed("node", "c"), "c", "left")
    component = F.coalesce("component", "c")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component (see :func:`near_duplicates`).

    The document with the smallest doc_id stays; rows without doc_id stay.
    """
    dropped = near_duplicates(docs, words, percent).where("not kept").select("doc_id").distinct()
    return docs.join(staged(dropped, "near-dropped"), "doc_id", "left_anti").select(*docs.columns)
