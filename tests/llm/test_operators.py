"""Edge cases of the dealt operators, and small brute-force versions."""

import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from skywarden.llm import exact, fingerprint, minhash, packing, pii, quality, sharding, tokenfile, tokens, urlfilter
from skywarden.llm.common import components, ranked

VOCAB = P.path("byte_bpe_50k.json")
BASE = " ".join(f"w{i} and" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w30", "new")), (4, BASE.replace("w30 and w31", "x")), (5, None), (6, ""),
    (7, "one"), (8, "one two"), (9, "ONE two"), (None, BASE), (None, None), (12, "y " * 5000), (13, "z" * 40_000),
    (7, "one"), (15, "   \n\t "), (16, "mail a.b@x.example.org or +1 (988) 555-2485 twice a.b@x.example.org"),
    (17, "from 10.20.30.40 to 4111 1111 1111 1111, Mrs. Clara Lind met Mr. Lind"), (18, None),
    (19, "BUY!! NOW!! " * 40), (20, "a  b\n\n c <|endoftext|> \x85 é日本 " * 30),
]
SCHEMA = "doc_id long, text string, n_tokens string, kept string, shard string, key string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", "y", "z", "k") for i, t in TEXTS], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def shingles(text, words):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    parts = [bytes(c + 32 if 65 <= c <= 90 else c for c in p) for p in parts]
    return {tuple(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def test_exact(docs):
    got = rows(exact.exact_duplicates(docs, digest=True))
    assert len(got) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[1]["keep_id"] == 2 and by_id[1]["group_size"] == 2 and not by_id[1]["kept"] and by_id[2]["kept"]
    assert by_id[5]["keep_id"] == by_id[6]["keep_id"] == 18 and by_id[7]["group_size"] == 2
    assert all(r["kept"] and r["keep_id"] is None for r in got if r["doc_id"] is None)
    left = rows(exact.drop_duplicates(docs))
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == [2, 3, 4, 7, 8, 9, 12, 13, 15, 16, 17, 18, 19, 20]
    assert sum(r["doc_id"] is None for r in left) == 2
    assert exact.drop_duplicates(docs.limit(0)).columns == docs.columns


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near(spark, words, percent):
    rng = np.random.default_rng(1)
    texts = [(i, t) for i, t in enumerate(t for _, t in TEXTS)]
    for base in range(4):
        source = [f"t{base}x{i}" for i in range(120)]
        for _ in range(12):
            own = list(source)
            for at in rng.choice(120, rng.integers(0, 9), replace=False):
                own[at] = f"e{rng.integers(10**6)}"
            texts.append((len(texts), " ".join(own)))
    sets = {i: shingles(t, words) for i, t in texts}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and sets[a] and 100 * both >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = rows(minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), words, percent))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == \
        {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}


def test_near_edge_cases(docs):
    got = rows(minhash.near_duplicates(docs, 3, 85))
    assert len(got) == len(TEXTS) and all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["n_shingles"] for r in got if r["doc_id"] in (5, 6, 15, 18)} == {0}
    assert minhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_sketch_fills_and_estimates():
    a = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert (minhash.sketch(a[:1], 64) != ~np.uint64(0)).all()
    x, y = minhash.sketch(a[:300], 512), minhash.sketch(a[100:], 512)
    assert abs((x == y).mean() - 200 / 399) < 0.1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 201: 200}


def test_ranked(spark):
    df = spark.createDataFrame([(i % 3 if i % 7 else None, i // 2) for i in range(200)], "g int, v int")
    per = defaultdict(list)
    for r in ranked(df, ["g"], ["v"], "n", chunk_rows=9).collect():
        per[r["g"]].append(r["n"])
    assert all(sorted(v) == list(range(len(v))) for v in per.values()) and len(per) == 4


def test_fingerprints(docs):
    got = rows(fingerprint.fingerprints(docs))
    assert len(got) == len(TEXTS)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}
    assert len(same) == 1 and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    one = next(r for r in got if r["doc_id"] == 3)
    assert one["near_next"] > 0.5 and one["n_chars"] == len(TEXTS[2][1])
    assert fingerprint.fingerprints(docs.limit(0)).count() == 0


def test_shards(docs):
    got = rows(sharding.shard_documents(docs, shards=4))
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(map(len, slots.values())) == [5, 5, 5, 5]
    assert all(sorted(s) == list(range(5)) for s in slots.values())
    assert {r["size"] for r in got if r["doc_id"] in (5, 6)} == {1}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_propagation_gathers_a_large_group(spark):
    docs = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"t{i // 4 if i < 90 else i}") for i in range(300)], "doc_id long, text string")
    got = rows(sharding.shard_documents(docs, shards=6))
    assert sorted(np.bincount([r["shard"] for r in got])) == [50] * 6
    assert len({r["shard"] for r in got if r["doc_id"] % 3 == 0}) <= 3


def _ids():
    tokenizer = Tokenizer.from_file(VOCAB)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in TEXTS]


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y", " <|endoftext|> ",
                                  "a\n <|endoftext|>\n  b", "<|endoftext", "<|<|endoftext|>|>", "é<|endoftext|>日本 <|endoftext|>"])
def test_added_tokens_as_the_library_reads_them(text):
    got = np.frombuffer(b"".join(tokens.id_encoder(VOCAB)(text)), "<u4").tolist()
    assert got == Tokenizer.from_file(VOCAB).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "it's a\n b \n\n  c\t \u3000 1234 日本 é", "wherer thonre " * 300, "x" * 3000])
def test_a_text_without_added_tokens_is_encoded_in_one_call(text):
    got = tokens.id_encoder(VOCAB)(text)
    assert len(got) == 1
    assert np.frombuffer(got[0], "<u4").tolist() == Tokenizer.from_file(VOCAB).encode(text, add_special_tokens=False).ids


def test_packed_pieces_are_those_of_the_library(docs):
    found = defaultdict(list)
    for r in rows(packing.pack(docs, VOCAB, capacity=256, keep_ids=True)):
        found[r["doc_id"]].append((r["piece"], r["start"], tuple(r["ids"])))
    want = defaultdict(list)
    for (doc_id, _), ids in zip(TEXTS, _ids()):
        cuts = [0, *range(len(ids) % 256 or 256, len(ids), 256), len(ids)]
        want[doc_id] += [(i, a, tuple(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_packing(docs):
    got = rows(packing.pack(docs, VOCAB, capacity=256, keep_ids=True))
    assert sum(r["length"] for r in got) == sum(map(len, _ids()))
    bins = defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 256
    assert packing.pack(docs.limit(0), VOCAB).count() == 0


def test_plan_is_full_where_it_can_be():
    rng = np.random.default_rng(2)
    sizes = {int(k): int(n) for k, n in zip(range(1, 101), rng.integers(0, 50, 100))}
    plan = packing.plan_bins(dict(sizes), 100)
    used = defaultdict(int)
    for chosen, times in plan:
        assert sum(chosen) <= 100
        for k in chosen:
            used[k] += times
    assert dict(used) == {k: n for k, n in sizes.items() if n}
    assert sum(t for _, t in plan) <= -(-sum(k * n for k, n in sizes.items()) // 100) * 1.02 + 1
    assert packing.fullest({7: 3, 5: 1, 4: 9}, 13) in ([5, 4, 4], [4, 4, 5], [4, 5, 4])


def test_token_files(spark, docs):
    path = tokenfile.fresh_folder(spark)
    tokenfile.write_tokens(docs, path, VOCAB, 50_257, file_ids=2000, block_ids=700)
    got = sorted(rows(tokenfile.read_tokens(spark, path)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i or 0))
    assert sorted(map(tuple, (r["ids"] for r in got))) == sorted(map(tuple, _ids()))
    assert [r["start"] for r in got] == [sum(len(x["ids"]) for x in got[:i]) for i in range(len(got))]
    empty = tokenfile.fresh_folder(spark)
    tokenfile.write_tokens(docs.limit(0), empty, VOCAB, 50_257)
    assert tokenfile.read_tokens(spark, empty).count() == 0


def test_blocks_hold_wide_ranks():
    ranks = np.array([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1, 3, 4], np.uint32)
    block = tokenfile.write_block(np.array([5, 6]), np.array([4, 5]), ranks)
    (ids, lengths, back), = tokenfile.read_blocks(block + b"\n")
    assert list(ids) == [5, 6] and list(lengths) == [4, 5] and list(back) == list(ranks)
    with pytest.raises(ValueError):
        list(tokenfile.read_blocks(block[:-1] + b"x\n"))


def test_urls(spark):
    pages = [(1, None), (2, "no scheme"), (3, "HTTP://A.NET/x"), (4, "http://netx/y"), (5, "https://w.example.net/en/1?a#b"),
             (6, "http://a.net"), (7, "http://example.com/de/"), (7, "http://example.com/de/"), (None, "x://q.org/fr/z#/en"),
             (9, "http://casino-win.example.org/en/1")] + [(100 + i, f"http://site{i}.example.org/en/{i}") for i in range(60)]
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    df = spark.createDataFrame([(*p, "h", "v") for p in pages], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: r for r in rows(urlfilter.filter_urls(df, rules))}
    assert (got[1]["host"], got[1]["path"], got[1]["verdict"]) == ("", "", "allow") and got[2]["host"] == ""
    assert (got[3]["host"], got[3]["rule"], got[3]["verdict"]) == ("a.net", "net/", "block")
    assert got[4]["rule"] is None and got[6]["rule"] is None and got[5]["rule"] == "example.net/en/"
    assert got[7]["verdict"] == "block" and got[None]["rule"] == "org/fr/" and got[5]["path"] == "/en/1"
    assert urlfilter.filter_urls(df.limit(0), rules).count() == 0


def test_quality(docs):
    got = rows(quality.classify(docs))
    assert len(got) == len(TEXTS) and {r["kept"] for r in got if r["n_words"] == 0} == {True}
    assert quality.keep_good(docs).columns == docs.columns and quality.classify(docs.limit(0)).count() == 0


def test_label_model_finds_the_good_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(3000) < 0.8
    cast = np.stack([np.where(rng.random(3000) < a, truth, ~truth) for a in (0.97, 0.9, 0.95)], 1) * 2 - 1
    cast[rng.random(cast.shape) < 0.3] = 0
    seen, n = np.unique(cast, axis=0, return_counts=True)
    prior, table = quality.label_model([(tuple(map(int, p)), int(k)) for p, k in zip(seen, n)])
    assert abs(prior - 0.8) < 0.06 and table[1, 0] > 0.9 and table[0, 0] < 0.15
    assert ((quality.posterior(cast, prior, table) > 0.5) == truth).mean() > 0.9


def test_pii(docs):
    got = {r["doc_id"]: r for r in rows(pii.replace_entities(docs, "k1")) if r["doc_id"] is not None}
    a, b = got[16]["text"], got[17]["text"]
    mails = re.findall(r"\S+@\S+\.example", a)
    assert len(mails) == 2 and len(set(mails)) == 1 and "a.b@x" not in a and "988" not in a and got[16]["n_entities"] == 3
    assert "10.20.30.40" not in b and "4111 1111" not in b and re.search(r"\d{4} \d{4} \d{4} \d{4}", b)
    names = re.search(r"Mrs\. (\w+) (\w+) met Mr\. (\w+)$", b)
    assert names[2] == names[3] != "Lind" and names[1] in pii._GIVEN["latin"]["f"]
    assert got[1]["text"] == BASE and got[5]["text"] is None and got[1]["n_entities"] == 0
    other = {r["doc_id"]: r for r in rows(pii.replace_entities(docs, "k2"))}
    assert other[16]["text"] != a and pii.replace_entities(docs.limit(0), "k1").count() == 0


def test_colliding_surrogates_are_drawn_again(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(f"e{i}",) for i in range(30)], "entity string")
    make = lambda salt: F.concat(F.lit("e"), F.pmod(F.hash("entity", salt), F.lit(120)).cast("string"))
    got = rows(pii.distinct_surrogates(df, make))
    own = [r["surrogate"] for r in got]
    assert len(set(own)) == 30 and not set(own) & {r["entity"] for r in got}
