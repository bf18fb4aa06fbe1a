"""Pairs of a large group of near copies that are verified first."""

import random

from pyspark.sql import functions as F

from skywarden.llm.minhash import near_duplicates, star_pairs


def test_few_partners_in_a_large_group(spark):
    """A member shares many buckets with changing others, and is still paired with few of them."""
    r = random.Random(3)
    rows = [(node, 100, key, 200) for key in range(24) for node in r.sample(range(400), 200)]
    pairs = star_pairs(spark.createDataFrame(rows, "node long, n long, key long, size long"), 80, 3)
    assert pairs.count() <= 25 * 400
    linked = {x for p in pairs.collect() for x in p}
    assert linked == {node for node, *_ in rows}


def test_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        words = base.copy()
        words[i % 120] = f"own{i}"
        texts.append((i + 10, " ".join(words)))
    docs = spark.createDataFrame([*texts, (3, "quite another text of some seven words")], "doc_id long, text string")
    out = near_duplicates(docs)
    assert {(r["component_id"], r["n"]) for r in out.groupBy("component_id").agg(F.count("*").alias("n")).collect()} == {(10, 150), (3, 1)}
