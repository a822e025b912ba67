"""Reading the corpus tables and cutting lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workdir import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``id`` and ``text``, whatever else the input has."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once below ``spark.checkpoint.dir`` and read from there."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n
