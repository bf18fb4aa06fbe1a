"""The driver's queries: each operator over its whole table, with its digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.llm import (
    alignment, bpe, exact, fingerprint, minhash, packing, pii, quality, sharding, tokenfile, trie, urlfilter, warc,
)
from skywarden.llm.common import staged, table

END_ID = 2
VOCAB_SIZE = 50_257
#: Stands for a secret that a real run takes from its own configuration.
PII_KEY = "surrogate key of the registered query"
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN, keep_ids=False)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"), digest=True)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents"), PII_KEY).select("doc_id", "text", "n_entities")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfile.fresh_folder(spark)
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"),
                           VOCAB_SIZE, END_ID)
    return tokenfile.read_tokens(spark, path, keep_ids=False)


def _rebuilt(turns: DataFrame, head: int = 5, chunk: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Numbered turns with the first h of each conversation taken from conversation c - c % 100, and all conv_ids.

    What a conversation needs to know is copied to each ``chunk`` of its
    turns, so that a long one is not joined in one task.
    """
    n_head = (F.crc32(F.col("conv_id").cast("string")) % (head + 1)).alias("h")
    convs = staged(turns.groupBy("conv_id").agg(F.max("place").alias("n")).select(
        "conv_id", "n", F.expr("conv_id - conv_id % 100").alias("base"), n_head), "rebuilt-convs")
    heads = turns.where(f"conv_id % 100 = 0 and place <= {head}").withColumnRenamed("conv_id", "base")
    given = convs.join(heads, "base").where("place <= h").select("conv_id", "place", "digest", "n_chars")
    lengths = heads.groupBy("base").agg(F.max("place").alias("given"))
    moves = convs.join(lengths, "base", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("given", F.lit(0))).alias("given"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"n div {chunk}"))).alias("chunk"))
    own = turns.withColumn("chunk", F.expr(f"place div {chunk}")).join(moves, ["conv_id", "chunk"]).where("place > h") \
        .select("conv_id", F.expr("place - h + given").alias("place"), "digest", "n_chars")
    return given.unionByName(own), convs.select("conv_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(trie.numbered(trie.turn_digests(table(spark, sf_dir, "conversations"))), "op11-turns")
    return trie.trie(*_rebuilt(turns))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))[0]


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.fresh_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:x-page:(-?\d*):", 1), F.lit("")).cast("long")
    return warc.read_archives(spark, path, keep_payload=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup, op2_fingerprints, op3_sharding, op4_bpe, op5_url_filter, op6_quality, op7_packing, op8_exact_dedup,
    op9_pii, op10_token_files, op11_prefix_trie, op12_alignment, op13_warc)}

ORACLES = {
    "op1_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) <= 3 THEN array_to_string(ws, ' ')
         ELSE array_to_string(ws[i:i + 2], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
d AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r(doc_id, hit) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, d.y FROM r JOIN d ON d.x = r.hit),
m AS (SELECT doc_id, min(hit) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op11_prefix_trie": """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
t AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
o AS (SELECT conv_id, length(text) AS c, sha, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha) AS p
      FROM (SELECT conv_id, turn, coalesce(text, '') AS text, substring(sha256(concat(length(coalesce(role, '')), ':',
            coalesce(role, ''), coalesce(text, ''))), 1, 32) AS sha FROM conversations WHERE conv_id IS NOT NULL)),
ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
          list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
          lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM o), t),
n AS (SELECT conv_id AS base, count(*) AS n FROM o GROUP BY 1),
r AS (SELECT i.conv_id, p, c, sha FROM ids i JOIN o ON o.conv_id = i.base AND p <= h
      UNION ALL
      SELECT i.conv_id, p - h + least(h, coalesce(n, 0)), c, sha FROM ids i JOIN o ON o.conv_id = i.conv_id AND p > h
      LEFT JOIN n ON n.base = i.base),
w AS (SELECT conv_id, p AS depth, c, string_agg(sha, '') OVER (PARTITION BY conv_id ORDER BY p) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
nodes AS (SELECT path, any_value(depth) AS depth, any_value(c) AS c, min(conv_id) AS conv_id, count(*) AS n_convs
          FROM w GROUP BY path),
kids AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
sub AS (SELECT w.path, count(*) FILTER (k.path IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.c)::BIGINT AS saved_tokens
        FROM nodes d JOIN w ON w.conv_id = d.conv_id AND w.depth <= d.depth LEFT JOIN kids k ON k.path = d.path GROUP BY 1),
ends AS (SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
         FROM (SELECT conv_id, max_by(path, depth) AS path FROM w GROUP BY 1) GROUP BY 1)
SELECT a.conv_id, a.depth::BIGINT AS depth, b.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes a LEFT JOIN nodes b ON a.depth > 0 AND b.path = left(a.path, length(a.path) - 32)
LEFT JOIN kids ON kids.path = a.path JOIN sub ON sub.path = a.path LEFT JOIN ends ON ends.path = a.path""",
    "op13_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT hex, array_to_string([substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
        (('0x' || substring(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)
        FOR i IN range(32)], '') AS payload_digest FROM (SELECT DISTINCT hex FROM p)),
r AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM r JOIN d USING (hex)""",
}
