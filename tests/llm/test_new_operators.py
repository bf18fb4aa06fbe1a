"""Alignment, prefix trie and WARC archives against brute force and libraries, and their edge cases."""

import base64
import hashlib
import random
import struct
from collections import Counter, defaultdict
from itertools import accumulate

import duckdb
import public_tokenizers as P
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skywarden.llm import alignment, queries, trie, warc
from skywarden.llm.common import lookup, staging_path

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def rows(df):
    return [r.asDict() for r in df.collect()]


# -- general helper ----------------------------------------------------------------------------------------------------

def test_lookup_deals_hot_keys(spark):
    left = spark.createDataFrame([("a", i) for i in range(200)] + [("b", 1), (None, 2), ("c", 3)], "k string, x long")
    right = spark.createDataFrame([("a", 7, 200), ("b", 8, 1), ("d", 9, 50)], "k string, v long, n long")
    got = Counter((r["k"], r["v"]) for r in rows(lookup(left, right, ["k"], F.col("n") > 100)))
    assert got == {("a", 7): 200, ("b", 8): 1, (None, None): 1, ("c", None): 1}


# -- alignment ---------------------------------------------------------------------------------------------------------

ALIGN_TEXTS = [
    (1, "the quick brown fox"), (1, "the quick brown fox"), (None, "the the the"), (3, None), (4, ""), (5, " "), (6, "  two  blanks  "),
    (7, "tabs\tand\nlines\r\n  more"), (8, "日本語 テキスト é   x"), (9, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (10, "ends with blank "), (11, "▁ is read as a blank"), (12, "word " * 3000), (13, "z" * 20_000), (14, "　 wide   space"),
    (15, "a\x1c b \x85 c"), (16, "emoji 👩‍👩‍👧 and 🏳️‍🌈 flags"), (17, "\n"), (18, "1234567890 12.5% $3")]


def aligned_by_hand(texts):
    t, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    name = {i: s for s, i in t.get_vocab().items()}
    found, count = [], Counter()
    for doc_id, text in texts:
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        a_bytes = [bytes(byte_of[c] for c in name[i]) for i in a]
        b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, 0, 0, [], ""))
            continue
        at_a, at_b = ({e: i for i, e in enumerate(accumulate(map(len, x)))} for x in (a_bytes, b_bytes))
        groups, links, i0, j0 = [], [], 0, 0
        for e in sorted(at_a.keys() & at_b.keys()):
            i, j = at_a[e] + 1, at_b[e] + 1
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            links.append((a[i - 1], b[j - 1]))
            i0, j0 = i, j
        count.update(links)
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((d, na, nb, len(k), len(k), sum(count[x] == most[x[1]] for x in k), sum(count[x] for x in k), sha)
                   for d, na, nb, k, sha in found), key=repr), count, most


@pytest.mark.parametrize("small_runs", [False, True])
def test_alignment_equals_brute_force(spark, monkeypatch, small_runs):
    if small_runs:  # many runs: several rounds of merging, several tasks a partition
        for name, value in (("RUN_DOCS", 1), ("FAN_IN", 2), ("STREAMED", 2)):
            monkeypatch.setattr(alignment, name, value)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in ALIGN_TEXTS], "doc_id long, text string, n_a long, run string")
    got, counted = alignment.align_documents(docs, A, B)
    want, count, most = aligned_by_hand(ALIGN_TEXTS)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in rows(got)), key=repr) == want
    pairs = {(r["a_id"], r["b_id"]): (r["count"], r["best"]) for r in rows(alignment.pair_table(counted))}
    assert pairs == {k: (n, n == most[k[1]]) for k, n in count.items()}


def test_alignment_keeps_groups_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    got = rows(alignment.align_documents(docs, A, B, keep_groups=True)[0])[0]
    assert hashlib.sha256(got["groups"].encode()).hexdigest() == got["groups_sha256"] and got["groups"].count(";") == got["n_groups"] - 1
    assert rows(alignment.align_documents(docs.where("false"), A, B)[0]) == []
    blank = rows(alignment.align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B)[0])
    assert len(blank) == 2 and all(r["n_a"] == r["count_sum"] == 0 and r["groups_sha256"] == "" for r in blank)


def test_words_new_to_many_texts_are_encoded_together():
    align, calls = alignment.Aligner(A, B), []

    class Counting:
        def __init__(self, of, name):
            self.of, self.name = of, name

        def __getattr__(self, name):
            if name == self.name:
                calls.append(name)
            return getattr(self.of, name)

    align.a, align.b = Counting(align.a, "encode_ordinary"), Counting(align.b, "encode")
    texts = [f"w{i} and w{i}x here" for i in range(1000)]
    groups, sizes, links = align(texts)
    assert calls.count("encode") <= 4 and calls.count("encode_ordinary") < 100
    assert len(groups) == len(set(groups)) == 1000 and sizes[:, 2].sum() == len(links)
    calls.clear()
    assert align(texts)[0] == groups and not calls


@pytest.mark.parametrize("keep, size", [(400_000, 1), (400_000, 99), (2, 2), (6, 1)])
def test_odd_words_do_not_change_others_of_their_group(keep, size):
    texts = [t or "" for _, t in ALIGN_TEXTS] + ["ﬁ ligature the quick", "the quick ▁ brown", "the " + "q" * 60, "the " + "q" * 60]
    align = alignment.Aligner(A, B, keep=keep)
    got = []
    for _ in range(2):
        for at in range(0, len(texts), size):
            groups, sizes, links = align(texts[at:at + size])
            assert sizes[:, 2].sum() == len(links) and len(align.shown) == len(align.slot) == len(align.sizes) == len(align.used)
            assert align.sizes[:, 2].sum() == len(align.links) and all(len(w) <= 48 for w in align.slot)
            got += [(*n, hashlib.sha256(g).hexdigest() if g else "") for n, g in zip(sizes.tolist(), groups)]
    want = [(na, nb, n, sha) for _, na, nb, n, _, _, _, sha in (aligned_by_hand([(0, t)])[0][0] for t in texts)]
    assert got == want * 2


def test_word_that_a_model_rewrites_empties_only_its_texts():
    class Rewriting:
        def __init__(self, of):
            self.of = of

        def encode(self, texts, **options):
            return self.of.encode([t.replace("ﬁ", "fi") for t in texts], **options)

    texts = ["the quick brown fox", "a ﬁne day", "the fine day", "quick ﬁ", "ﬁ"]
    align = alignment.Aligner(A, B)
    want, _, want_links = align([t if "ﬁ" not in t else "" for t in texts])
    align = alignment.Aligner(A, B)
    align.b = Rewriting(align.b)
    groups, sizes, links = align(texts)
    assert groups == want and (sizes > 0).all(axis=1).tolist() == ["ﬁ" not in t for t in texts]
    assert links.tolist() == want_links.tolist()


def test_runs_count_links_by_pair_and_document():
    random.seed(4)
    ids = (1 << alignment.ID_BITS) - 1
    links = [random.choice([0, 1, 63, 64, ids]) << 32 | random.choice([0, 7, ids]) for _ in range(500)]
    docs = [random.choice([0, 5, alignment.RUN_DOCS - 1]) for _ in links]
    got, before = {}, -1
    for bucket, pairs, posts in alignment.runs_of(*map(alignment.np.array, (links, docs))):
        keys, counts, more = alignment.unpack_pairs(pairs)
        raw = zstandard.ZstdDecompressor().decompress(posts)
        n = len(raw) // 6
        own = list(zip(struct.unpack(f"<{n}H", raw[:2 * n]), struct.unpack(f"<{n}I", raw[2 * n:])))
        assert bucket > before and list(keys) == sorted(set(keys.tolist())) and sum(more) == n
        before, i = bucket, 0
        for key, count, m in zip(keys.tolist(), counts.tolist(), more.tolist()):
            assert (key >> 32) % alignment.BUCKETS == bucket and count == sum(c for _, c in own[i:i + m])
            got |= {(key, d): c for d, c in own[i:i + m]}
            i += m
    assert got == Counter(zip(links, docs))


def test_heap_merge_and_maxima():
    random.seed(3)
    runs, total = [], Counter()
    for _ in range(9):
        own = Counter(random.choices([b << 32 | a for b in range(4) for a in range(5)], k=30))
        total += own
        keys = sorted(own)
        runs.append(alignment.unpack_pairs(alignment.pack_pairs(
            *map(alignment.np.array, (keys, [own[k] for k in keys], [1] * len(keys)))))[:2])
    got = list(alignment.with_maxima(alignment.merged(runs)))
    assert [(k, n) for k, n, _ in got] == sorted(total.items())
    assert all(best == (n == max(m for x, m in total.items() if x >> 32 == k >> 32)) for k, n, best in got)


# -- prefix trie -------------------------------------------------------------------------------------------------------

CONV_SCHEMA = "conv_id long, turn long, role string, text string, depth long, n_convs string, block string"


def conversations(spark, found):
    data = [(c, i, role, text, 1, "x", "y") for c, turns in found.items() for i, (role, text) in enumerate(turns)]
    random.Random(5).shuffle(data)
    return spark.createDataFrame(data, CONV_SCHEMA)


def trie_by_hand(found):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    out = []
    for node, own in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = sum(len(x) == len(node) + 1 for x in below)
        leaves = sum(not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), kids, leaves, saved, sha))
    return sorted(out, key=repr)


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(trie, "CHUNK_BLOCKS", 2)   # long conversations cross several chunks
    monkeypatch.setattr(trie, "HOT_CHILDREN", 2)
    monkeypatch.setattr(trie, "END_IDS", 2)
    r = random.Random(seed)
    found = {}
    for c in range(60):
        found[c * 7 - 50] = [(r.choice(["user", "bot"]), r.choice(["é", "hello", "日本"])) for _ in range(r.randint(1, 6))]
    found[1001] = found[-50] * 9
    found[1002] = found[1001][:30] + [("user", "other")]
    for c in range(2000, 2012):  # a group of copies
        found[c] = [("user", "same"), ("bot", "same")] * 4
    got = rows(trie.prefix_trie(conversations(spark, found)))
    assert sorted((tuple(x[n] for n in NODE) for x in got), key=repr) == trie_by_hand(found)


def test_trie_edge_cases(spark):
    long = "x" * 300_000
    data = [(1, None, None, None), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, None, "", ""), (3, 0, "user", long),
            (3, 0, "user", long), (None, 0, "user", "a"), (4, 2, "b", "2"), (4, 2, "a", "1")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    tied = sorted([("b", "2"), ("a", "1")], key=lambda t: hashlib.sha256(f"1:{t[0]}{t[1]}".encode()).digest()[:16])
    want = {1: [("", ""), ("user", "a")], 2: [("", ""), ("user", "a")], 3: [("user", long)] * 2, 4: tied}
    got = rows(trie.prefix_trie(df))
    assert sorted((tuple(x[n] for n in NODE) for x in got), key=repr) == trie_by_hand(want)
    shown = {(r["conv_id"], r["depth"]): (r["role"], r["text"]) for r in rows(trie.with_turns(trie.prefix_trie(df), df))}
    assert shown[1, 0] == (None, None) and shown[1, 1] == ("", "") and shown[3, 2] == ("user", long) and shown[4, 1] == tied[0]
    assert rows(trie.prefix_trie(df.where("false"))) == []


def test_rebuilt_conversations_equal_sql(spark, tmpdir_path):
    r = random.Random(8)
    found = {c: [("u", r.choice(["a", "b"])) for _ in range(r.randint(1, 8))] for c in [*range(95, 130), 200, 250, 299, 310, -7]}
    conversations(spark, found).write.parquet(f"{tmpdir_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmpdir_path}/conversations.parquet/*.parquet')")
    want = con.execute(queries.ORACLES["op11_prefix_trie"])
    names = [d[0] for d in want.description]
    got = rows(queries.op11_prefix_trie(spark, tmpdir_path))
    assert sorted((tuple(x[n] for n in names) for x in got), key=repr) == sorted(want.fetchall(), key=repr)


# -- WARC --------------------------------------------------------------------------------------------------------------

def pages(spark):
    data = [(i, f"http://h/{i % 3}", f"<p>page {i % 7} " + "word " * 200 + "</p>", "x", 1, True) for i in range(200)]
    data += [(900, None, None, "", 0, None), (901, "http://e", "", "", 0, None), (None, "http://n", "", "", 0, None),
             (None, "http://n2", "alone", "", 0, None), (902, "bad url\r\nX: y", "é日本" * 10, "", 0, None),
             (903, "u", "b" * 400_000, "", 0, None)] + [(904, "http://same", "same row", "", 0, None)] * 5
    return spark.createDataFrame(data, "page_id long, url string, html string, sha1 string, k long, first boolean")


def test_warc_round_trip(spark):
    df, path = pages(spark), staging_path(spark, "warc-test")
    warc.write_archives(df, path)
    found = warc.read_archives(spark, path)
    got = rows(warc.with_payloads(found))
    by_payload = defaultdict(list)
    for p in rows(df):
        by_payload[p["html"] or ""].append(p["page_id"])
    kinds = defaultdict(list)
    for r in got:
        kinds[r["payload"].decode()].append(r)
    assert {k: len(v) for k, v in kinds.items()} == {k: len(v) for k, v in by_payload.items()}
    for text, group in kinds.items():
        data, ids = text.encode(), by_payload[text]
        assert {(r["payload_bytes"], r["payload_digest"]) for r in group} == {
            (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())}
        first = [r for r in group if r["record_type"] == "response"]
        assert len(first) == 1 and len({r["record_id"] for r in group}) == len(group)
        assert first[0]["record_id"].split(":")[2] == str(max((i for i in ids if i is not None), default=""))
        assert {r["refers_to"] for r in group if r["record_type"] == "revisit"} <= {first[0]["record_id"]}
        assert sorted(r["record_id"].split(":")[2] for r in group) == sorted("" if i is None else str(i) for i in ids)
    assert [r["target_uri"] for r in got if r["record_id"].startswith("<urn:x-page:902:")] == ["bad%20url%0D%0AX:%20y"]
    # The files start with their dictionary, and the plain library reads them from end to end.
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect():
        data = bytes(r["content"])
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY
        known = warc.read_dictionary(data[8:8 + size])
        text = zstandard.ZstdDecompressor(dict_data=known).stream_reader(data, read_across_frames=True).read()
        assert text.count(b"WARC/1.1\r\n") == sum(x["file"].endswith(r["path"].rsplit("/", 1)[1]) for x in got)


def test_warc_small_payloads_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "u", "ab" if i < 3 else "longer text") for i in range(6)], "page_id long, url string, html string")
    path = staging_path(spark, "warc-test")
    warc.write_archives(df, path, min_bytes=5)   # too few samples: no dictionary
    got = Counter((r["record_type"], r["payload_bytes"]) for r in rows(warc.read_archives(spark, path, keep_payload=False)))
    assert got == {("response", 2): 3, ("response", 11): 1, ("revisit", 11): 2}
    path = staging_path(spark, "warc-test")
    warc.write_archives(df.where("false"), path)
    assert rows(warc.read_archives(spark, path)) == []


def _record(**changes):
    fields = {"WARC-Type": "resource", "WARC-Record-ID": "<urn:x:1>", "WARC-Date": "2024-01-01T00:00:00Z",
              "Content-Type": "text/plain", "Content-Length": "5"} | changes
    return ("WARC/1.0\r\n" + "\r\n".join(f"{k}: {v}" for k, v in fields.items() if v is not None) + "\r\n\r\nhello\r\n\r\n").encode()


@pytest.mark.parametrize("record, says", [
    (_record(**{"WARC-Date": None}), "no warc-date"), (_record(**{"Content-Length": "6"}), "content-length"),
    (_record(**{"Content-Length": "x"}), "content-length"), (_record()[:-2], "content-length"), (_record()[4:], "no WARC header"),
    (_record(**{"WARC-Payload-Digest": "sha1:AAAA"}), "digest differs"), (_record().replace(b"Date: ", b"Date "), "without a name"),
    (_record(**{"Content-Type": "application/http"}), "HTTP header")])
def test_warc_records_are_validated(record, says):
    with pytest.raises(warc.DamagedArchive, match=says):
        warc.parse_record(record)


def test_warc_reads_foreign_files_and_reports_damage(spark, tmpdir_path):
    good = warc.parse_record(_record(**{"X-Long": "one\r\n two"}))
    assert good["payload"] == b"hello" and good["payload_bytes"] == 5 and good["refers_to"] is None
    plain = zstandard.ZstdCompressor(write_content_size=False)
    frame = plain.compress(_record())
    streamed = plain.compressobj()
    parts = {"a": frame + struct.pack("<II", warc.SKIPPABLE + 3, 4) + b"skip" + streamed.compress(_record()) + streamed.flush(),
             "b": frame + plain.compress(b"no record") + frame, "c": frame + frame[:-3], "d": b"", "e": b"garbage!"}
    for name, data in parts.items():
        with open(f"{tmpdir_path}/{name}.warc.zst", "wb") as f:
            f.write(data)
    got = defaultdict(list)
    for r in sorted(rows(warc.read_archives(spark, tmpdir_path, on_error="row", glob="*.warc.zst")), key=lambda r: (r["file"], r["at"])):
        got[r["file"][-10]].append(r["error"] is None)
    assert got == {"a": [True, True], "b": [True, False, True], "c": [True, False], "e": [False]}
    with pytest.raises(Exception, match="DamagedArchive"):
        rows(warc.read_archives(spark, tmpdir_path, glob="b.warc.zst"))


def test_warc_query_equals_sql_with_copies(spark, tmpdir_path):
    df = pages(spark).where("page_id is not null").dropDuplicates(["page_id"])
    df.write.parquet(f"{tmpdir_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmpdir_path}/pages.parquet/*.parquet')")
    want = con.execute(queries.ORACLES["op13_warc"])
    names = [d[0] for d in want.description]
    got = rows(queries.op13_warc(spark, tmpdir_path))
    assert sorted((tuple(x[n] for n in names) for x in got), key=repr) == sorted(want.fetchall(), key=repr)
