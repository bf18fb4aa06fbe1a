"""Token ids in files: frequency-ranked, byte-aligned variable-length coding."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skywarden.llm.common import drop_staged, ship_package, staged, staging_path
from skywarden.llm.tokens import encoded

# Fixed values of the file format.  A file is a row of blocks; a block is
# the header, doc ids (int64, the least value for none), ids per document
# (uint32), control bytes (two bits per id: its data bytes less one) and
# data bytes (rank of the id, little end first), then one line feed.
MAGIC = b"SKTK"
HEADER = struct.Struct("<4sIQQI")  # magic, documents, ids, data bytes, crc32 of what follows
NO_ID = -(1 << 63)

#: Data bytes of the four ids that a control byte stands for.
_SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def write_block(doc_ids: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> bytes:
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    more = codes[:len(ranks)]
    for most in (0xFF, 0xFFFF, 0xFFFFFF):
        more += ranks > most
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    # No rank of the block takes more than ``width`` bytes.
    width = int(more.max(initial=0)) + 1
    raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    data = raw[np.arange(width, dtype=np.uint8) <= more[:, None]]
    body = doc_ids.astype("<i8").tobytes() + lengths.astype("<u4").tobytes() + control.tobytes() + data.tobytes()
    return HEADER.pack(MAGIC, len(doc_ids), len(ranks), len(data), zlib.crc32(body)) + body


def read_blocks(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, ids per document, ranks) of each block of a file."""
    at = 0
    while at < len(content):
        magic, n_docs, n_ids, n_data, crc = HEADER.unpack_from(content, at)
        at += HEADER.size
        n_control = -(-n_ids // 4)
        end = at + 12 * n_docs + n_control + n_data
        if magic != MAGIC or zlib.crc32(content[at:end]) != crc or content[end:end + 1] != b"\n":
            raise ValueError("not a token file, or a damaged one")
        doc_ids = np.frombuffer(content, "<i8", n_docs, at)
        lengths = np.frombuffer(content, "<u4", n_docs, at + 8 * n_docs)
        control = np.frombuffer(content, np.uint8, n_control, at + 12 * n_docs)
        data = np.concatenate([np.frombuffer(content, np.uint8, n_data, end - n_data), np.zeros(3, np.uint8)])
        sizes = _SIZES[control].ravel()[:n_ids]
        first = np.cumsum(sizes) - sizes
        ranks = data[first].astype(np.uint32)
        for byte in (1, 2, 3):
            longer = np.flatnonzero(sizes > byte)
            ranks[longer] |= data[first[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
        yield doc_ids, lengths, ranks
        at = end + 1


def write_tokens(docs: DataFrame, path: str, vocab_path: str, vocab_size: int, end_id: int = 2,
                 file_ids: int = 4_000_000, block_ids: int = 500_000) -> None:
    """Encode whole texts and write them to ``path`` in ascending doc_id order.

    ``path``/ids holds the token files, in order of their names, of about
    ``file_ids`` ids each; ``path``/ranks the ids by falling frequency over
    the whole table (at most ``vocab_size`` rows, the only thing that
    passes through the driver).  Spark's writers make both, so a task that
    is run again leaves one copy, and any file system will do.

    A null or empty text is a document of the end id alone.  Rows without
    doc_id come first; rows that repeat a doc_id follow one another.
    """
    ship_package(docs.sparkSession)
    kind = "<u2" if vocab_size <= 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [np.frombuffer(x, "<u4").astype(kind).tobytes() for x in encoded(part, 1, vocab_path, end_id)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab_size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                # One count over many documents: it is as long as the vocabulary.
                total += np.bincount(np.frombuffer(b"".join(batch.column(0).slice(at, 500).to_pylist()), kind), minlength=vocab_size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    ids = staged(docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary"), "ids", "zstd")
    counts = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    by_rank = [r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))]
    total = sum(r["n"] for r in counts)
    rank_of = np.zeros(vocab_size, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, held, n = [], [], 0
        block = lambda: pa.RecordBatch.from_arrays([pa.array([write_block(
            np.array(doc_ids, np.int64), np.array([len(x) for x in held]), rank_of[np.concatenate(held)])],
            pa.binary())], ["block"])
        for batch in batches:
            for doc_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(NO_ID if doc_id is None else doc_id)
                held.append(np.frombuffer(x.as_py(), kind))
                n += len(held[-1])
                if n >= block_ids:
                    yield block()
                    doc_ids, held, n = [], [], 0
        if held:
            yield block()

    files = max(1, -(-total // file_ids))
    ids.repartitionByRange(files, F.col("doc_id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids").mapInArrow(blocks, "block binary") \
        .select(F.col("block").cast("string")).write.option("compression", "none").text(f"{path}/ids")
    docs.sparkSession.createDataFrame([(r, i) for r, i in enumerate(by_rank)], "rank long, id long") \
        .coalesce(1).write.parquet(f"{path}/ranks")
    drop_staged(ids)


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document of the files.

    start counts the ids of all documents before it, in file order.
    """
    ship_package(spark)
    ranks = spark.read.parquet(f"{path}/ranks").collect()
    id_of = np.zeros(len(ranks), "<u4")
    for r in ranks:
        id_of[r["rank"]] = r["id"]
    names = ["file", "doc_id", "at", "n_tokens", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = 0
                for doc_ids, lengths, ranks in read_blocks(content.as_py()):
                    ids, ends = id_of[ranks], np.cumsum(lengths, dtype=np.int64)
                    starts = ends - lengths
                    own = [ids[a:b] for a, b in zip(starts, ends)]
                    out = [pa.array([file] * len(own)), pa.array(doc_ids, mask=doc_ids == NO_ID),
                           pa.array(at + starts), pa.array(lengths.astype(np.int64)),
                           pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())]
                    if keep_ids:
                        out.append(pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(out, names[:len(out)])
                    at += len(ids)

    schema = "file string, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids
    read = staged(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
                  .select("path", "content").mapInArrow(run, schema), "tokens-read")
    # One row per file: a window over them is a small list.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = read.groupBy("file").agg(F.max(F.col("at") + F.col("n_tokens")).alias("n")) \
        .select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return read.join(files, "file").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)


def fresh_folder(spark: SparkSession) -> str:
    return staging_path(spark, "tokens")
