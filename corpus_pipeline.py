"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skywarden.llm import exact, minhash, packing, pii, quality
from skywarden.llm.common import staging_path
from skywarden.llm.queries import PII_KEY


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 0.8)."""
    return minhash.drop_near_duplicates(docs)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities become surrogates; n_chars follows the new texts."""
    out = pii.replace_entities(docs, PII_KEY)
    return out.withColumn("n_chars", F.when(F.col("n_entities") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, as pieces placed in sequences of up to 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_dedup), ("minhash near-dedup", near_dedup),
          ("pii", replace_pii), ("best-fit packing", best_fit_packing)]

#: Sketches, trained weights and tokenizers are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = staging_path(spark, f"pipeline-{i}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
