from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from changeloom.operators import facts


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_both_ways_give_the_same(spark, how, monkeypatch):
    many = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("row_seq"), F.lit("x").alias("t"))
    few = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    expected = rows(many.join(few, "k", how))
    near = facts.attach_facts(many, few, ["k"], how)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    assert rows(near) == expected
    monkeypatch.setattr(facts, "BROADCAST_ROWS", 3)
    assert rows(facts.attach_facts(many, few, ["k"], how)) == expected
    assert rows(facts.attach_facts(many.drop("row_seq"), few, ["k"], how)) == rows(many.drop("row_seq").join(few, "k", how))


def largest_part(df):
    """Most rows of one partition behind the join."""
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_a_key_with_nearly_all_rows_is_spread(spark, how):
    n = 20_000
    key = F.when(F.col("id") % 10 > 0, F.lit(0)).when(F.col("id") % 40 == 0, F.lit(None)).otherwise(F.col("id") % 997)
    many = spark.range(n).select(key.cast("bigint").alias("k"), F.col("id").alias("row_seq"))
    few = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    expected = rows(many.join(few, "k", how))
    assert rows(facts.spread_join(many, few, ["k"], how, 16)) == expected
    heavy = facts.heavy_keys(many, ["k"], 16).collect()
    assert [r.k for r in heavy] == [0] and 14 <= heavy[0]._shares <= 16


def test_tasks_of_a_heavy_key_are_bounded(spark):
    many = spark.range(40_000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("row_seq"))
    few = spark.range(40_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    settings = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert largest_part(many.join(few, "k", "left")) > 36_000
        # 36,000 rows in 64 shares, on 16 partitions: four times the even 2,500 at most
        assert largest_part(facts.spread_join(many, few, ["k"], "left", 64)) < 4 * 2_500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_rows_and_facts_are_spread(spark):
    many = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("row_seq"))
    few = spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    assert facts.spread_join(many.limit(0), few, ["k"], "left").count() == 0
    assert rows(facts.spread_join(many, few.limit(0), ["k"], "left_anti")) == rows(many)
