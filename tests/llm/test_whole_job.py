"""Inputs on which an operator once did less than the whole job."""

from collections import defaultdict

from skywarden.llm import pii, quality, sharding


def rows(df):
    return [r.asDict() for r in df.collect()]


def _surrogates(spark, entities):
    got = {r["entity"]: r["surrogate"] for r in rows(pii.surrogates(spark.createDataFrame([(e,) for e in entities], "entity string"), "k"))}
    assert set(got) == set(entities) and len(set(got.values())) == len(entities) and not set(got.values()) & set(entities)
    return got


def test_pii_values_are_never_used_up(spark):
    given = [f"Given{chr(97 + i)}" for i in range(20)]
    persons = [f"{title} {g} {last}" for title, last in (("Mr.", "Smith"), ("Dr.", "Smith"), ("Prof.", "Иванов")) for g in given]
    mails = [f"{c}@t.{end}" for c in "abc" for end in ("com", "org", "net", "de", "fr", "es", "ru")]
    phones = [f"+1 22 {i // 100:02d} {i % 100:02d}" for i in range(20)]
    got = _surrogates(spark, persons + mails + phones + [f"password=-------{i}" for i in range(10)])
    assert len({got[p].split()[-1] for p in persons if p.endswith("Smith")}) == 1
    assert all(got[p].split()[0] == p.split()[0] for p in persons)


def test_pii_more_surnames_than_three_parts_make(spark):
    name = lambda i, first: "".join(chr(first + i // 20 ** k % 20) for k in range(3))
    _surrogates(spark, [f"Mr. L{name(i, 97)}" for i in range(5000)] + [f"Mr. Ж{name(i, 1072)}" for i in range(600)])


def _measured(text):
    words = quality.Words()
    n, found = words.rows_of(text)
    places, amounts = words.features(found)
    return n, words.votes(text, n, found), dict(zip(places.tolist(), amounts.tolist()))


def test_quality_reads_all_of_long_words():
    blob = "data:image/png;base64," + "Ab9" * 30
    n, _, features = _measured(blob + "xyz")
    assert n == 1 and features != _measured(blob + "123!")[2]
    prose = "".join(chr(0x4E00 + i * 7919 % 5000) + "。" * (i % 12 == 11) for i in range(3000))
    votes = _measured(prose)[1]
    assert min(votes) == 0 and max(votes) == 1
    assert min(_measured("z" * 40_000)[1]) == -1 and min(_measured("{}=>" * 1000)[1]) == -1
    assert sum(_measured(prose)[2].values()) > 2 * len(prose) // 64
    assert _measured("one two three")[1] == [0] * len(quality.LABELLERS)


def test_shards_gather_copies_where_all_are_linked(spark):
    docs = spark.createDataFrame([(i, f"t{i // 2}") for i in range(2000)], "doc_id long, text string")
    got = rows(sharding.shard_documents(docs, shards=8))
    shards_of, load = defaultdict(set), defaultdict(int)
    for r in got:
        shards_of[r["text_crc32"]].add(r["shard"])
        load[r["shard"]] += 1
    cut = sum(len(x) > 1 for x in shards_of.values())
    print("cut pairs", cut, "of", len(shards_of))
    assert set(load.values()) == {250} and cut <= 0.02 * len(shards_of)


def test_shard_flows_keep_the_counts():
    wants = {(0, 1): 5, (1, 2): 4, (2, 0): 3, (1, 0): 1, (3, 0): 2}
    flows = sharding._flows(wants, [0, 0, 0, 0])
    assert flows == {(0, 1): 4, (1, 2): 3, (2, 0): 3, (1, 0): 1, (3, 0): 0}
    assert sharding._flows(wants, [1, 0, 0, 0])[3, 0] + sharding._flows(wants, [1, 0, 0, 0])[2, 0] == 4
