"""A corpus pipeline: stages that each apply one operator to what the stage before kept.

``run`` applies them in memory; a scheduler may as well write each stage's result as Parquet
and hand the reread rows to the next, for every stage but the last returns the columns of
``documents``. Each stage learns and counts on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeledger.llm import jaccard_join, language_id, packing, sparse_suffix, toxicity
from tradeledger.llm.checkpoints import cut
from tradeledger.llm.queries import table, tokenizer_path

# Learned models, hashing and packing are not SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.keep_civil(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    learn = docs.filter(~language_id.held_out())
    return language_id.keep_identified(docs, language_id.train(language_id.training_windows(learn)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has as well."""
    return sparse_suffix.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in training sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES):
            docs = cut(docs)
    return docs
