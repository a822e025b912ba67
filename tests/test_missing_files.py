"""File names are made from ranges: a few rows stand for very many names."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.operators.checks import missing_files
from changeloom.sources.changelog import expand_files
from changeloom.streaming.follow import open_batches


def ranges(spark, days, files):
    return spark.range(days).select(
        F.concat(F.lit("/w/d"), F.col("id").cast("string")).alias("data_dir"), F.lit(1).cast("bigint").alias("first_file_index"),
        F.lit(files).cast("bigint").alias("latest_file_index"), F.lit(6).alias("file_width"),
    )


def operators(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_absent_names_are_found_without_a_broadcast(spark):
    named = expand_files(ranges(spark, 3, 40))
    there = named.where("file_index % 8 <> 0").unionByName(named.where("file_index = 7"))
    absent = missing_files(named, there)
    assert "Broadcast" not in operators(absent)
    found = [r.path for r in absent.select("path").orderBy("path").collect()]
    assert found == [f"/w/d{d}/CDC{i:06d}.csv" for d in range(3) for i in (8, 16, 24, 32, 40)]
    assert "Broadcast" not in operators(absent)


def test_names_that_are_null_or_repeated(spark):
    text = "path string"
    named = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], text)
    there = spark.createDataFrame([("b",), ("b",), (None,)], text)
    assert [r.path for r in missing_files(named, there).orderBy("path").collect()] == [None, "a", "a"]


def test_open_batches_are_found_without_a_broadcast(spark):
    named = expand_files(ranges(spark, 3, 40))
    landed = named.select("path", F.floor(F.col("file_index") / 10).alias("batch_id"))
    landed = landed.unionByName(spark.createDataFrame([("/w/other/CDC000001.csv", 99)], "path string, batch_id bigint"))
    found = open_batches(landed, ranges(spark, 3, 25))
    assert "Broadcast" not in operators(found)
    assert sorted(r.batch_id for r in found.collect()) == [0, 1, 2]
