"""Prefix trie of conversations: blocks of turns first, single turns only where siblings part."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skywarden.llm.common import drop_staged, lookup, staged

#: Turns that one block digest covers.
BLOCK = 4
#: Blocks of one conversation that one task puts in order.
CHUNK_BLOCKS = 1024
#: Children from which on a parent's row is dealt to several tasks.
HOT_CHILDREN = 10_000
#: Ids that one row of a list of ends holds.
END_IDS = 4096


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, n_chars of every row: the only read of the texts.

    The digest is the first half of a SHA-256 over role and text; null
    role and text are empty.  Rows without conv_id are in no conversation
    and are left out.  Other columns are not read.
    """
    return _keyed(conversations).select("conv_id", "turn", "digest", F.length("text").cast("long").alias("n_chars"))


def _keyed(conversations: DataFrame) -> DataFrame:
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        "conv_id", conversations["turn"].cast("long").alias("turn"),
        *[F.coalesce(conversations[c], F.lit("")).alias(c) for c in ("role", "text")])
    whole = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    return rows.withColumn("digest", F.unhex(F.substring(whole, 1, 32)))


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, place, digest, n_chars: the turns of each conversation counted from 1.

    In ascending order of turn, null first; rows with the same turn follow
    their digests.  The rows are dealt by ranges of (conversation, turn),
    so that one long conversation is counted by many tasks, each of which
    starts from the counts of the ranges before it.
    """
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows may stand in any order; a random last key deals them out.
    turns = staged(turns.withColumn("__any", F.rand(11)), "trie-turns")
    order = [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("__any")]
    dealt = staged(turns.repartitionByRange(parts, "conv_id", *order)
                   .withColumn("part", F.spark_partition_id()), "trie-dealt")
    drop_staged(turns)
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n")) \
        .select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return dealt.withColumn("place", place).join(starts, ["conv_id", "part"]) \
        .select("conv_id", (F.col("start") + F.col("place")).cast("long").alias("place"), "digest", "n_chars")


def block_paths(turns: DataFrame) -> DataFrame:
    """One row per block of ``BLOCK`` turns (the last may be shorter) of each conversation.

    A turn's word is a 128-bit hash (two longs) of its place and digest,
    and a prefix is named by the xor of its words: the name of any prefix
    follows from the parts that it is cut into, so even one conversation
    need not pass through one task.  p is the name before the block, o the
    one after it; u, v, c hold words and characters of the block's turns,
    ``before`` the characters ahead of it.
    """
    at = (F.col("place") - 1) % BLOCK
    words = turns.select(
        "conv_id", at.alias("at"), "n_chars", F.expr(f"(place - 1) div {BLOCK}").alias("block"),
        F.xxhash64(F.lit(1), "place", "digest").alias("u"), F.xxhash64(F.lit(2), "place", "digest").alias("v")) \
        .withColumn("chunk", F.expr(f"block div {CHUNK_BLOCKS}"))
    one = lambda c, i: F.max(F.when(F.col("at") == i, F.col(c)))
    blocks = words.repartition("conv_id", "chunk").groupBy("conv_id", "chunk", "block").agg(
        F.count("*").alias("m"), F.sum("n_chars").alias("chars"), F.bit_xor("u").alias("x1"), F.bit_xor("v").alias("x2"),
        *[one(a, i).alias(b + str(i)) for a, b in (("u", "u"), ("v", "v"), ("n_chars", "c")) for i in range(BLOCK)])
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = words.groupBy("conv_id", "chunk").agg(
        F.bit_xor("u").alias("s1"), F.bit_xor("v").alias("s2"), F.sum("n_chars").alias("s")).select(
        "conv_id", "chunk", *[F.expr(f).over(ahead).alias(c) for f, c in (
            ("bit_xor(s1)", "s1"), ("bit_xor(s2)", "s2"), ("sum(s)", "s"))]).where("chunk > 0")
    blocks = blocks.withColumn("o1", F.bit_xor("x1").over(so_far)).withColumn("o2", F.bit_xor("x2").over(so_far)) \
        .withColumn("to", F.sum("chars").over(so_far)).join(starts, ["conv_id", "chunk"], "left")
    o1, o2 = (F.col(f"o{i}").bitwiseXOR(F.coalesce(F.col(f"s{i}"), F.lit(0))) for i in (1, 2))
    return blocks.select(
        "conv_id", "chunk", "block", "m", o1.bitwiseXOR(F.col("x1")).alias("p1"), o2.bitwiseXOR(F.col("x2")).alias("p2"),
        o1.alias("o1"), o2.alias("o2"), (F.col("to") - F.col("chars") + F.coalesce("s", F.lit(0))).alias("before"),
        "chars", *[a + str(i) for a in "uvc" for i in range(BLOCK)])


def _turn_nodes(groups: DataFrame, values: list[str]) -> DataFrame:
    """The groups of equal blocks cut into their turns: node n, parent q, depth, chars, before and ``values``."""
    nodes, n1, n2, before = [], F.col("p1"), F.col("p2"), F.col("before")
    for i in range(BLOCK):
        q1, q2 = n1, n2
        n1, n2 = n1.bitwiseXOR(F.col(f"u{i}")), n2.bitwiseXOR(F.col(f"v{i}"))
        nodes.append(F.struct(n1.alias("n1"), n2.alias("n2"), q1.alias("q1"), q2.alias("q2"),
                              (F.col("block") * BLOCK + i + 1).alias("depth"), F.col(f"c{i}").alias("chars"),
                              before.alias("before")))
        before = before + F.col(f"c{i}")
    return groups.select("single", *values, F.inline(F.slice(F.array(*nodes), 1, F.col("m").cast("int"))))


def _refined(groups: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Nodes of all groups; only those of blocks with siblings are grouped again, turn by turn."""
    nodes = _turn_nodes(groups, list(values))
    fixed = ["q1", "q2", "depth", "chars", "before"]
    apart = nodes.where("not single").groupBy("n1", "n2").agg(
        *[F.first(c).alias(c) for c in fixed], *[v.alias(k) for k, v in values.items()])
    alone = nodes.where("single").select("n1", "n2", *fixed, *values)
    return alone.unionByName(apart)


def end_digests(ends: DataFrame) -> DataFrame:
    """e1, e2, ends_sha256: SHA-256 of the ascending conv_ids of each node, joined by commas.

    The ids of one node may be any number: ranges of (node, id) are first
    joined into texts of at most ``END_IDS`` ids, and each node's texts
    then run through one hash, a row at a time.
    """
    spark = ends.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, key, ids = ["e1", "e2", "first", "ids"], None, []
        for batch in batches:
            out = [[], [], [], []]
            for e1, e2, conv_id in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ids and (key != (e1, e2) or len(ids) == END_IDS):
                    for column, value in zip(out, (*key, ids[0], ",".join(map(str, ids)))):
                        column.append(value)
                    ids = []
                key = e1, e2
                ids.append(conv_id)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, ids[0], ",".join(map(str, ids)))], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        names = ["e1", "e2", "ends_sha256"]
        for batch in batches:
            out = [[], [], []]
            for e1, e2, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if key == (e1, e2):
                    sha.update(b"," + ids.encode())
                    continue
                if sha:
                    for column, value in zip(out, (*key, sha.hexdigest())):
                        column.append(value)
                key, sha = (e1, e2), hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string()))], names)
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, sha.hexdigest())], names)

    joined = ends.select("e1", "e2", "conv_id").repartitionByRange(parts, "e1", "e2", "conv_id") \
        .sortWithinPartitions("e1", "e2", "conv_id").mapInArrow(texts, "e1 long, e2 long, first long, ids string")
    return joined.repartition(parts, "e1", "e2").sortWithinPartitions("e1", "e2", "first") \
        .mapInArrow(digests, "e1 long, e2 long, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of ``turns`` (conv_id, place, digest, n_chars).

    ``conversations`` (conv_id, each once) also holds those without turns.
    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (code points that the subtree does
    not store again), ends_sha256.

    Conversations are grouped by the names of whole blocks, level under
    level, with counts added up before any shuffle.  A block without
    siblings is one run of turns with the same members; only blocks that
    have siblings are grouped again by their first one, two, three and four
    turns.  With no conversation there is no row.

    Sums over a subtree need no walk over it: skip(r), the characters of r
    that a smaller conversation holds as well, gives for a node v the saved
    characters as the sum of skip(r) - before(v) over all its members but
    the smallest one, and its leaves as the count of those conversations
    that are the smallest at a childless node.
    """
    paths = staged(block_paths(turns), "trie-paths")
    last = paths.groupBy("conv_id").agg(F.max("block").alias("last"), F.max_by("o1", "block").alias("e1"),
                                        F.max_by("o2", "block").alias("e2"), F.sum("chars").alias("total"))
    ends = staged(conversations.select("conv_id").join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("last", F.lit(0)).alias("last"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("e1", "e2", "total")]), "trie-ends")

    block = ["p1", "p2", "block", "m", "before", *[a + str(i) for a in "uvc" for i in range(BLOCK)]]
    groups = staged(paths.groupBy("o1", "o2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.first(c).alias(c) for c in block]), "trie-groups")
    single = groups.groupBy("p1", "p2").agg(F.count("*").alias("n"), F.max("o1").alias("o1"), F.max("o2").alias("o2")) \
        .where("n = 1").select("o1", "o2", F.lit(True).alias("single"))
    groups = staged(groups.join(single, ["o1", "o2"], "left").fillna(False, ["single"]), "trie-siblings")

    members = {"n_convs": F.sum("n_convs"), "conv_id": F.min("conv_id")}
    root = ends.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("n1"), F.lit(0).cast("long").alias("n2"), F.lit(None).cast("long").alias("q1"),
        F.lit(None).cast("long").alias("q2"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"),
        F.lit(0).cast("long").alias("before"), "n_convs", "conv_id")
    nodes = staged(_refined(groups, members).unionByName(root), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("q1").alias("n1"), F.col("q2").alias("n2")) \
        .agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, ["n1", "n2"], "left").fillna(0, ["n_children"]), "trie-counted")

    owned = nodes.groupBy("conv_id").agg(F.sum("chars").alias("owned"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    values = ends.join(owned, "conv_id", "left").select(
        "conv_id", "last", (F.col("total") - F.coalesce("owned", F.lit(0))).alias("skip"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))
    by_chunk = values.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"last div {CHUNK_BLOCKS}")))) \
        .drop("last")
    sums = [F.sum("skip").alias("skip"), F.sum("leaf").alias("leaf"), F.min_by("skip", "conv_id").alias("own"),
            F.min("conv_id").alias("least")]
    over_blocks = paths.select("conv_id", "chunk", "o1", "o2").join(by_chunk, ["conv_id", "chunk"]) \
        .groupBy("o1", "o2").agg(*sums)
    again = {"skip": F.sum("skip"), "leaf": F.sum("leaf"), "own": F.min_by("own", "least"), "least": F.min("least")}
    over_nodes = _refined(groups.drop("n_convs", "conv_id").join(over_blocks, ["o1", "o2"]), again) \
        .select("n1", "n2", "skip", "leaf", "own")
    over_root = values.agg(*sums).where("least is not null").select(
        F.lit(0).cast("long").alias("n1"), F.lit(0).cast("long").alias("n2"), "skip", "leaf", "own")
    parents = nodes.select(F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    out = nodes.join(over_nodes.unionByName(over_root), ["n1", "n2"]) \
        .join(end_digests(ends).withColumnsRenamed({"e1": "n1", "e2": "n2"}), ["n1", "n2"], "left").select(
        "q1", "q2", "conv_id", "depth", "n_convs", "n_children", F.col("leaf").alias("n_leaves"),
        (F.col("skip") - F.col("own") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    out = lookup(out, parents.withColumnRenamed("n_children", "width"), ["q1", "q2"], F.col("width") > HOT_CHILDREN)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations as they stand (conv_id, turn, role, text); see :func:`trie`.

    Null role and text are empty, a null turn comes first, rows that repeat
    (conv_id, turn) each count as a turn in the order of their digests, and
    rows without conv_id are left out.  Whole texts of any length pass
    through a digest only.  Other columns, whatever their names, are not
    read.  An empty table gives no rows.
    """
    turns = staged(numbered(turn_digests(conversations)), "trie-numbered")
    return trie(turns, turns.select("conv_id").distinct())


def with_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` of :func:`prefix_trie` with role and text of each node's last turn, null for the root.

    They come from the smallest member, at the place of the node's depth.
    """
    texts = _keyed(conversations).select("conv_id", "digest", "role", "text").dropDuplicates(["conv_id", "digest"])
    places = numbered(turn_digests(conversations)).select("conv_id", F.col("place").alias("depth"), "digest")
    return nodes.join(places, ["conv_id", "depth"], "left").join(texts, ["conv_id", "digest"], "left").drop("digest")
