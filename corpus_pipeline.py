"""From raw documents to token ids in five stages.

Every stage takes the documents that its predecessor kept, with the columns doc_id, text, lang, source
and n_chars, and but for the last returns the same columns. ``run`` writes each stage's result as
Parquet below ``spark.checkpoint.dir`` and reads it again.

Defined results: null and empty texts pass all stages and have no tokens. In the near-duplicate stage rows of
one id with different texts are documents of their own, and rows without an id come after those with one; rows
repeated as they are become one, but for those without an id and without words. Further columns are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import byte_bpe, decontaminate, jaccard_join, substring_dedup, toxicity
from changeloom.llm.tables import remainder, table
from changeloom.workdir import work_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEPT = ("lang", "source", "n_chars")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns as in the query op2_toxicity."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(remainder(F.col("doc_id"), 3) != 1))
    scored = toxicity.score(docs, model, keep=KEPT)
    return scored.where(F.col("score") < toxicity.TOXIC).select("doc_id", "text", "kept.*")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, by id and hash of the text."""
    classes = jaccard_join.join(docs, keyed=True)
    first = F.col("doc_id").eqNullSafe(F.col("lead.id")) & (F.col("row") == F.col("lead.row"))
    later = classes.where(F.col("lead").isNotNull() & ~first)
    later = later.select(F.col("doc_id").alias("later"), F.col("row").alias("later_row")).distinct()
    rows = docs.select(*COLUMNS).withColumn("row", F.xxhash64(F.col("text").cast("string")))
    gone = F.col("doc_id").cast("bigint").eqNullSafe(F.col("later")) & (F.col("row") == F.col("later_row"))
    rest = rows.join(later, gone, "left_anti")
    # rows without an id and without words are no repetitions; the others are counted before tasks exchange them
    alone = F.col("doc_id").isNull() & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rest = rest.withColumn("own", F.when(alone, F.monotonically_increasing_id()))
    one = rest.groupBy("doc_id", "text", "own").agg(F.min(F.struct(*KEPT)).alias("kept"))
    return one.select("doc_id", "text", "kept.*").select(*COLUMNS)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand earlier; n_chars follows the text."""
    rest = substring_dedup.dedup(docs, keep=KEPT)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("kept.n_chars"))
    return rest.select("doc_id", "text", "kept.lang", "kept.source", n_chars.cast("bigint").alias("n_chars"))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), keep=KEPT)
    return found.where(F.size("hit_start") == 0).select("doc_id", "text", "kept.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of what they decode to."""
    coded = byte_bpe.round_trip(docs)
    return coded.select(
        "doc_id",
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("decontamination", remove_contaminated),
    ("byte_bpe", encode),
]

#: segment scores, an iterated join and a tokenizer can't be said in SQL; the tests have a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
