"""The operators' registered queries over the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.llm import (
    collocations,
    fill_middle,
    jaccard_join,
    language_id,
    license_scan,
    multi_index,
    packing,
    quality_rules,
    quality_trees,
    sentencepiece_sampling,
    sparse_suffix,
    toxicity,
    url_lists,
)
from tradeledger.llm.sql import COLLOCATION_SQL, FILL_SQL, QUALITY_SQL, URL_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(language_id.training_windows(docs.filter(~language_id.held_out())))
    return language_id.predict(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"
    )


def op3_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's whole text: sampled segmentations, and whether each spells the text."""
    model = tokenizer_path("piece_bpe_32k.model")
    decoded = sentencepiece_sampling.encode_and_decode(table(spark, sf_dir, "documents"), model, ("doc_id",))
    return decoded.select(
        "doc_id", "sample", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), "log_prob",
        "inclusion", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeated_passages(table(spark, sf_dir, "documents"))


def _number(text: Column) -> Column:
    """A number from 0 to 2**28-1 that SQL elsewhere can compute as well."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("int")


def captures_and_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dates for the pages' captures, and a log of list entries on their hosts and first path segments.

    The tables have no dates, so both are derived from hashes: captures fall on 730 days. Of
    the hosts a quarter is blocked for a while, some of them again later; a fifth of the first
    path segments is allowed from some day on.
    """
    day = F.lit("2023-01-01").cast("date")
    captures = pages.select(
        "page_id", "url", F.date_add(day, _number(F.col("page_id").cast("string")) % 730).alias("fetched_at")
    )
    site = url_lists.host(F.col("url"))
    first = F.regexp_extract("url", r"^[a-z]+://[^/?#]*/([^/?#]+)", 1)
    names = pages.filter("url is not null").select(site.alias("host"), first.alias("first")).distinct()
    hosts = names.filter("host <> ''").select("host").distinct().withColumn("h", _number(F.col("host")))
    begin = (F.col("h") / 4).cast("int") % 500
    end = begin + 30 + (F.col("h") / 97).cast("int") % 150
    events = F.array(
        F.struct(F.lit("add").alias("event"), begin.alias("d")),
        F.struct(F.when(F.col("h") % 8 == 0, F.lit("remove")).alias("event"), end.alias("d")),
        F.struct(F.when(F.col("h") % 16 == 0, F.lit("add")).alias("event"), (end + 60).alias("d")),
    )
    blocked = hosts.filter("h % 4 = 0").select("host", "h", F.explode(events).alias("e")).select(
        F.lit("domain").alias("kind"), F.col("host").alias("entry"), F.lit("block").alias("action"),
        F.concat(F.lit("c"), (F.col("h") % 3).cast("string")).alias("category"), "e.event",
        F.date_add(day, F.col("e.d")).alias("at"),
    )
    paths = names.filter("host <> '' and first <> ''").withColumn("entry", F.concat("host", F.lit("/"), "first"))
    paths = paths.withColumn("h", _number(F.col("entry"))).filter("h % 5 = 0")
    allowed = paths.select(
        F.lit("prefix").alias("kind"), "entry", F.lit("allow").alias("action"), F.lit("reviewed").alias("category"),
        F.lit("add").alias("event"), F.date_add(day, (F.col("h") / 5).cast("int") % 730).alias("at"),
    )
    return captures, blocked.union(allowed)


def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_lists.judged(*captures_and_entries(table(spark, sf_dir, "pages")))
    return found.withColumn("fetched_at", F.col("fetched_at").cast("string"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.measures(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "n_stop_words", "base_failed", "kept",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.rearrange(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_trees.fit(docs, table(spark, sf_dir, "labels"))
    return quality_trees.predict(docs, forest).select(
        "doc_id", quality_trees.held_out().alias("held_out"), "score",
        (F.col("score") >= quality_trees.GOOD).cast("int").alias("predicted"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_language_id": op2_language_id,
        "op3_sentencepiece_sampling": op3_sentencepiece_sampling,
        "op4_toxicity": op4_toxicity,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_url_lists": op7_url_lists,
        "op8_quality_rules": op8_quality_rules,
        "op9_packing": op9_packing,
        "op10_embedding_neardup": op10_embedding_neardup,
        "op11_collocations": op11_collocations,
        "op12_fill_middle": op12_fill_middle,
        "op13_quality_trees": op13_quality_trees,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_url_lists": URL_SQL,
        "op8_quality_rules": QUALITY_SQL,
        "op11_collocations": COLLOCATION_SQL,
        "op12_fill_middle": FILL_SQL,
    }
