"""The pipeline stage by stage, and fingerprints, against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from skywarden.llm import fingerprint

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(df):
    return [r.asDict() for r in df.collect()]


def shingles(text, words=5):
    parts = [bytes(c + 32 if 65 <= c <= 90 else c for c in p) for p in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return {tuple(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def kept_by_hand(docs):
    """Of equal texts the largest doc_id, then of each near group (five words, 0.8) the smallest."""
    last = {}
    for d in docs:
        last[d["text"] or ""] = max(d["doc_id"], last.get(d["text"] or "", -1))
    own = {i: shingles(t) for t, i in last.items()}
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(own)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(own[a] & own[b])
            if both and 5 * both >= 4 * (len(own[a]) + len(own[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {find(i) for i in ids}


def documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    base = next(d["text"] for d in rows(docs) if d["text"] and len(d["text"].split()) > 80)
    words = base.split()
    more = [(9001, base), (9002, " ".join([*words[:40], "changed", *words[41:]])), (9003, base), (9004, None), (9005, ""),
            (9006, f"{base} Write to jane.doe@mail.example.org or call +1 (988) 555-2485 today.")]
    return docs.unionByName(spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in more], SCHEMA))


def test_pipeline_equals_brute_force(spark):
    docs, outs = documents(spark), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        path = corpus_pipeline.staging_path(spark, "test-pipeline")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        outs.append(docs)
    good, exact, near, clean, packed = (rows(d) for d in outs)
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(d.columns == names for d in outs[:4])
    want = kept_by_hand(good)
    assert {d["doc_id"] for d in near} == want and len(near) == len(want) and len(exact) == len({d["text"] or "" for d in good})
    before = {d["doc_id"]: d["text"] for d in near}
    assert {d["doc_id"] for d in clean} == want and all(d["n_chars"] == len(d["text"] or "") for d in clean if d["text"] != before[d["doc_id"]])
    assert not any("jane.doe@mail.example.org" in (d["text"] or "") for d in clean)
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packed:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and r["length"] == len(r["ids"]) <= 1024
        pieces[r["doc_id"]].append((r["piece"], r["ids"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for d in clean:
        got = [i for _, ids in sorted(pieces[d["doc_id"]]) for i in ids]
        assert got == tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2]
    assert pieces.keys() == want and all(sum(n for _, n in b) <= 1024 for b in bins.values())


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0


def test_fingerprints_equal_brute_force(spark):
    texts = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(3 + i * 5))) for i in range(30)]
    texts += [(3, "other text of three é"), (None, "no id"), (31, None), (32, ""), (30, texts[30 - 1][1]), (5, texts[5][1])]
    df = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, copies int")
    hashed = {(r["doc_id"], r["t"]): r["h"] for r in df.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(hashed, key=lambda k: (-(1 << 63) if k[0] is None else k[0], hashed[k]), reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    prints = lambda s: {s[i:i + 16] for i in range(0, len(s), 16)}
    likeness = lambda a, b: len(a & b) / len(a | b)
    got = rows(fingerprint.fingerprints(df))
    own = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in hashed}
    assert len(got) == len(texts) and own
    by_key = defaultdict(list)
    for r in got:
        by_key[r["doc_id"], r["n_chars"]].append(r)
    sketch_of = {r["t"]: r["s"] for r in fingerprint.add_sketch(
        spark.createDataFrame([(t,) for t in {t for _, t in hashed}], "t string"), "t", "x")
        .select("t", fingerprint.as_string(F.col("x")).alias("s")).collect()}
    for (i, text), (_, after) in following.items():
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        match = [r for r in by_key[i, len(text)] if r["edited_sha256"] == sha]
        assert match, (i, text[:30])
        for r in match:
            assert r["fingerprint"] == sketch_of[text]
            assert abs(r["near_next"] - likeness(prints(sketch_of[text]), prints(sketch_of[after]))) < 1e-12
            assert abs(r["near_edited"] - likeness(prints(r["fingerprint"]), prints(r["edited_fingerprint"]))) < 1e-12
