"""WARC archives of one Zstandard frame per record, with the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.llm.common import drop_staged, lookup, ship_package, staged, staging_path

# Fixed values of the formats: frame magics, and the profile of a revisit.
FRAME, SKIPPABLE, DICTIONARY, TRAINED = 0xFD2FB528, 0x184D2A50, 0x184D2A5D, 0xEC30A437
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An empty skippable frame, all of it ASCII: Spark's text writer puts it after each record as its line end.
LINE_END = "P*M\x18\0\0\0\0"
_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


class DamagedArchive(ValueError):
    """A frame or record that breaks the format."""


def frames(content: bytes) -> Iterator[tuple[int, int, int]]:
    """(magic, start, end) of each frame; its length follows from the headers of its blocks."""
    at, size = 0, len(content)
    try:
        while at < size:
            magic, = struct.unpack_from("<I", content, at)
            if magic & 0xFFFFFFF0 == SKIPPABLE:
                end = at + 8 + struct.unpack_from("<I", content, at + 4)[0]
            elif magic == FRAME:
                flags = content[at + 4]
                single = flags >> 5 & 1
                end = at + 6 - single + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
                last = 0
                while not last:
                    head = int.from_bytes(content[end:end + 3], "little")
                    if end + 3 > size or head >> 1 & 3 == 3:
                        raise DamagedArchive(f"broken block at byte {end}")
                    last = head & 1
                    end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
                end += 4 * (flags >> 2 & 1)
            else:
                raise DamagedArchive(f"no frame at byte {at}")
            if end > size:
                raise DamagedArchive(f"frame at byte {at} is cut off")
            yield magic, at, end
            at = end
    except (struct.error, IndexError):
        raise DamagedArchive(f"frame at byte {at} is cut off") from None


def read_dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    """The dictionary of a leading skippable frame, which may itself be compressed."""
    if not data:
        return None
    if data[:4] == struct.pack("<I", FRAME):
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    if data[:4] != struct.pack("<I", TRAINED):
        raise DamagedArchive("no dictionary in the dictionary frame")
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT)


def records(content: bytes) -> Iterator[tuple[int, bytes | DamagedArchive]]:
    """(byte, record) of each frame; a frame that cannot be decoded gives the error in place of the record.

    Where the frames themselves cannot be told apart, nothing after it is read.
    """
    reader = zstandard.ZstdDecompressor()
    try:
        for magic, start, end in frames(content):
            if magic == DICTIONARY and start == 0:
                dictionary = read_dictionary(content[8:end])
                reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else reader
            elif magic == FRAME:
                try:
                    one = reader.decompressobj()
                    data = one.decompress(content[start:end])
                    if not one.eof or one.unused_data:
                        raise DamagedArchive(f"frame at byte {start} does not end where its blocks do")
                    yield start, data
                except (zstandard.ZstdError, DamagedArchive) as e:
                    yield start, DamagedArchive(f"frame at byte {start}: {e}")
    except (zstandard.ZstdError, DamagedArchive) as e:
        yield len(content), DamagedArchive(str(e))


def _fields(head: bytes) -> dict[str, str]:
    fields, name = {}, None
    for line in head.split(b"\r\n"):
        if line[:1] in b" \t" and line and name:
            fields[name] += " " + line.strip().decode()
            continue
        key, colon, value = line.partition(b":")
        if not colon or not key or len(key.split()) != 1 or key != key.strip():
            raise DamagedArchive(f"header line without a name: {line[:60]!r}")
        name = key.decode().lower()
        fields.setdefault(name, value.strip().decode())
    return fields


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_record(record: bytes) -> dict:
    """Fields and payload of one record; whatever breaks the format raises :class:`DamagedArchive`.

    Checked are the version line, the needed headers, the length against
    the bytes there are, the end mark, the payload's length of the HTTP
    header and its digest.  ``payload`` is None for a revisit, whose
    ``payload_bytes`` and ``payload_digest`` are those of what it refers to.
    """
    version, _, rest = record.partition(b"\r\n")
    head, mark, rest = rest.partition(b"\r\n\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", version) or not mark:
        raise DamagedArchive("no WARC header")
    try:
        fields = _fields(head)
    except UnicodeDecodeError:
        raise DamagedArchive("header is not UTF-8") from None
    missing = [n for n in _NEEDED if not fields.get(n)]
    if missing:
        raise DamagedArchive(f"no {', '.join(missing)}")
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise DamagedArchive(f"content-length is {length}, {len(rest) - 4} bytes stand there")
    block, kind = rest[:-4], fields["warc-type"].lower()
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2].upper() or None
    payload, stated = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise DamagedArchive("no end of the HTTP header")
        try:
            about = _fields(http.partition(b"\r\n")[2])
        except UnicodeDecodeError:
            raise DamagedArchive("HTTP header is not UTF-8") from None
        stated = about.get("content-length") if "transfer-encoding" not in about else None
        stated = int(stated) if stated and stated.isascii() and stated.isdigit() else None
    if kind == "revisit":
        n_bytes, payload = stated, None
        if fields.get("warc-profile") == REVISIT_PROFILE and not (digest and fields.get("warc-refers-to")):
            raise DamagedArchive("revisit without digest or record that it refers to")
    else:
        n_bytes, found = len(payload), payload_digest(payload)
        if stated is not None and stated != n_bytes and "warc-truncated" not in fields:
            raise DamagedArchive(f"payload of {n_bytes} bytes, {stated} announced")
        if digest and fields["warc-payload-digest"].lower().startswith("sha1:") and digest != found:
            raise DamagedArchive("payload digest differs")
        digest = digest or found
    return {"record_id": fields["warc-record-id"], "record_type": kind, "date": fields["warc-date"],
            "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to"),
            "payload_bytes": n_bytes, "payload_digest": digest, "payload": payload}


def _safe(url: str | None) -> bytes:
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], (url or "").encode())


def record_id(page_id: int | None, url: str | None, digest: str, copy: int) -> str:
    tag = "" if url is None else hashlib.md5(url.encode()).hexdigest()
    return f"<urn:x-page:{'' if page_id is None else page_id}:{digest}:{tag}:{copy}>"


def record_bytes(page_id: int | None, url: str | None, digest: str, n_bytes: int, date: str, copy: int = 0,
                 payload: bytes | None = None, refers_to: str | None = None) -> bytes:
    """A response record with its payload, or a revisit record that refers to another one."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n_bytes
    block += payload or b""
    lines = [f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, digest, copy)}",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to:
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head = "\r\n".join(["WARC/1.1", *lines, "Content-Type: application/http; msgtype=response",
                        f"Content-Length: {len(block)}"]).encode()
    if url is not None:
        head += b"\r\nWARC-Target-URI: " + _safe(url)
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, samples: int = 400, sample_bytes: int = 16_384, size: int = 65_536) -> bytes:
    """A dictionary trained on the heads of ``samples`` payloads (at most 6.5 MB), or nothing where they are too few.

    It bears on the size of the files alone; each file carries it.
    """
    heads = pages.where(F.octet_length("html") > 0).limit(samples) \
        .select(F.substring(F.col("html").cast("binary"), 1, sample_bytes).alias("b")).collect()
    try:
        return zstandard.train_dictionary(size, [bytes(r["b"]) for r in heads]).as_bytes() if heads else b""
    except zstandard.ZstdError:
        return b""


def _decided(pages: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct (page_id, url, sha1, n_bytes) rows that share their payload, and the keyed pages themselves.

    ``copies`` counts the rows alike in all four; ``first`` marks the one
    row of each payload that becomes its response.
    """
    keys = ["page_id", "url", "sha1", "n_bytes"]
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("sha1", F.sha1("html")).withColumn("n_bytes", F.octet_length("html").cast("long"))
    once = staged(keyed.where(F.col("n_bytes") >= min_bytes).groupBy(*keys).agg(F.count("*").alias("copies")), "warc-rows", "zstd")
    groups = staged(once.groupBy("sha1", "n_bytes").agg(
        F.sum("copies").alias("n"), F.count("*").alias("width"), F.max(F.struct("page_id", "url")).alias("keep"))
        .where("n > 1"), "warc-groups")
    alike = staged(lookup(once, groups, ["sha1", "n_bytes"], F.col("width") > 10_000).where("n is not null").withColumn(
        "first", F.col("page_id").eqNullSafe(F.col("keep.page_id")) & F.col("url").eqNullSafe(F.col("keep.url"))), "warc-alike")
    drop_staged(once)
    return alike, groups, keyed


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to ``path``, each as one zstd frame.

    Of the rows with equal payloads of at least ``min_bytes`` bytes the one
    with the largest page_id (of equal ones, the last url; null lowest)
    becomes a response, the others revisit it; rows alike in all columns
    give one response and as many revisits as there are further copies.
    A null html is the empty payload, a null url leaves its header away,
    and control characters and blanks of a url are percent-encoded there.
    Payloads of any length that a row can hold are written whole.  Other
    columns are not read; an empty table gives no record.

    Every file starts with the dictionary in a skippable frame, unless the
    table is too small to train one.  Spark's text writer makes the files,
    so a task that is run again leaves one copy and any file system will
    do; its line ends are empty skippable frames, which every zstd reader
    passes over.  A file holds one input split; to be read by
    :func:`read_archives` it has to stay below 2 GB.
    """
    ship_package(pages.sparkSession)
    dictionary = train_dictionary(pages)
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
    leading = struct.pack("<II", DICTIONARY, len(packed)) + packed if dictionary else b""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level)
        writer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True)
        out, size = [leading] if leading else [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 3, 5, 6, 7)]
            for (page_id, url, sha1, n_bytes, copy, to_page, to_url), html in zip(zip(*columns), batch.column(4)):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                refers = record_id(to_page, to_url, digest, 0) if copy else None
                out.append(writer.compress(record_bytes(page_id, url, digest, n_bytes, date, copy, html.as_py(), refers)))
                size += len(out[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                    out, size = [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    keys = ["page_id", "url", "sha1", "n_bytes"]
    alike, _, keyed = _decided(pages, min_bytes)
    none = F.lit(None)
    revisits = alike.withColumn("more", F.col("copies") - F.col("first").cast("long")).where("more > 0").select(
        *keys, none.cast("binary").alias("html"), F.explode(F.sequence(F.lit(1).cast("long"), "more")).alias("copy"),
        F.col("keep.page_id").alias("to_page"), F.col("keep.url").alias("to_url"))
    # Rows that share a payload are marked by their keys, null or not; all others keep their place.
    tell = lambda df: df.withColumn("k", F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys],
                                                  F.col("page_id").isNull(), F.col("url").isNull()).cast("string"))
    marks = tell(alike).select("k", "first", "copies")
    marked = lookup(tell(keyed), marks, ["k"], F.col("copies") > 10_000)
    alone = marked.where("first is null or first and copies = 1").select(*keys, "html")
    again = marked.where("first and copies > 1").groupBy(*keys).agg(F.first("html").alias("html"))
    if alike.where("first and copies > 1").isEmpty():
        responses = alone
    else:
        responses = alone.unionByName(again)
    responses = responses.select(*keys, F.col("html").cast("binary").alias("html"), F.lit(0).cast("long").alias("copy"),
                                 none.cast("long").alias("to_page"), none.cast("string").alias("to_url"))
    responses.unionByName(revisits).mapInArrow(encode, "frame binary").select(F.col("frame").cast("string")) \
        .write.option("compression", "none").option("lineSep", LINE_END).text(path)


_FOUND = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("date", pa.string()), ("target_uri", pa.string()),
                    ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("file", pa.string()), ("at", pa.int64()), ("error", pa.string()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True, on_error: str = "raise",
                  glob: str = "*") -> DataFrame:
    """One row per record of the archives at ``path``.

    Columns: record_id, record_type, date, target_uri, refers_to,
    payload_bytes, payload_digest (base32 SHA-1), file, at (byte of the
    frame), error, and payload unless ``keep_payload`` is off.  Files with
    and without a leading dictionary frame are read, and so are other
    skippable frames.  A damaged frame or record stops the job, or with
    ``on_error="row"`` gives a row with its error and place; after a frame
    whose end cannot be told the rest of the file is one such row.  A
    revisit has no payload (see :func:`with_payloads`).  Empty files give
    no rows.
    """
    ship_package(spark)
    schema = _FOUND if keep_payload else pa.schema(list(_FOUND)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for at, record in records(content.as_py()):
                    try:
                        if isinstance(record, DamagedArchive):
                            raise record
                        found = parse_record(record)
                    except DamagedArchive as e:
                        if on_error != "row":
                            raise DamagedArchive(f"{file}, byte {at}: {e}") from None
                        found = {"error": str(e)}
                    out.append(found | {"file": file, "at": at})
                    size += 500 + (len(found.get("payload") or b"") if keep_payload else 0)
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)
    kinds = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content") \
        .mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))


def with_payloads(found: DataFrame) -> DataFrame:
    """``found`` of :func:`read_archives` with each revisit's payload filled in from the record that it refers to.

    A revisit whose record is not there keeps a null payload.
    """
    wanted = found.where("record_type = 'revisit'").groupBy(F.col("refers_to")).agg(F.count("*").alias("width"))
    given = found.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("payload").alias("given")) \
        .join(wanted, "refers_to").dropDuplicates(["refers_to"])
    out = lookup(found, given, ["refers_to"], F.col("width") > 10_000)
    return out.withColumn("payload", F.coalesce("payload", "given")).select(*found.columns)


def fresh_folder(spark: SparkSession) -> str:
    return staging_path(spark, "warc")
