"""The operators as queries over the corpus tables, with SQL where it can say the same."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    chat_format,
    collocations,
    conversation_repair,
    decontaminate,
    jaccard_join,
    language,
    minhash_dedup,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from .tables import remainder, table

#: tokens from which on a document is over the limit of op8
TOKEN_LIMIT = 2048


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.learn(docs, labels.where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted")
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = substring_dedup.dedup(table(spark, sf_dir, "documents"), joined=True)
    return rest.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = language.identify(docs, language.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotate(table(spark, sf_dir, "conversations"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.round_trip(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.query(table(spark, sf_dir, "conversations"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.dedup(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    name: fn for name, fn in list(globals().items()) if name.startswith("op") and name[2].isdigit()
} | {"pipeline": pipeline}

ORACLES = {
    "op1_quality_rules": quality_rules.sql(),
    "op3_substring_dedup": substring_dedup.SQL,
    "op5_jaccard_join": jaccard_join.SQL,
    "op6_decontamination": decontaminate.SQL,
    "op7_chat_format": chat_format.SQL,
    "op9_url_filter": url_filter.sql(),
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_minhash_dedup": minhash_dedup.SQL,
    "op13_collocations": collocations.SQL,
}
