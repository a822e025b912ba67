from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from changeloom.operators import checks, prefix


def brute(data):
    out, high = [], {}
    for scope, place, value in sorted(data, key=lambda r: (r[0], r[1])):
        out.append((scope, place, value, high.get(scope)))
        if value is not None:
            high[scope] = value if high.get(scope) is None else max(high[scope], value)
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("limit", [0, 10_000])
def test_highest_before(spark, monkeypatch, hot, limit):
    draw = random.Random(7)
    data = [(0 if hot else draw.randrange(4), i, draw.choice([None, draw.randrange(1000)])) for i in range(3000)]
    draw.shuffle(data)
    df = spark.createDataFrame(data, "s int, p int, v bigint")
    monkeypatch.setattr(prefix, "ONE_STEP", limit)
    assert rows(prefix.max_before(df, ["s"], ["s", "p"], "v", "before")) == brute(data)


def test_one_scope_with_all_rows_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(prefix, "ONE_STEP", 0)
    df = spark.range(40_000).select(F.lit("t").alias("s"), F.col("id").alias("p"), F.col("id").alias("v"))
    paths = []
    made = prefix.work_dir
    monkeypatch.setattr(prefix, "work_dir", lambda s, purpose: paths.append(made(s, purpose)) or paths[-1])
    out = prefix.max_before(df, ["s"], ["p"], "v", "before")
    assert out.where("before = p - 1").count() == 39_999
    sizes = [r["count"] for r in spark.read.parquet(paths[0]).groupBy("_range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 20_000


def test_empty_rows(spark, monkeypatch):
    df = spark.createDataFrame([], "s int, p int, v bigint")
    assert prefix.max_before(df, ["s"], ["p"], "v", "before").count() == 0
    monkeypatch.setattr(prefix, "ONE_STEP", -1)
    assert prefix.max_before(df, ["s"], ["p"], "v", "before").count() == 0


@pytest.mark.parametrize("order", ["table", "stream"])
def test_commit_order_is_the_same_in_ranges(spark, monkeypatch, order):
    draw = random.Random(3)
    data = [
        ("d", draw.choice("ab"), draw.randrange(2), str(draw.randrange(2)), "2026-01-0" + draw.choice("12"), draw.randrange(5), 0, i,
         i + draw.choice([0, 0, 0, -40]))
        for i in range(1500)
    ]
    schema = (
        "source_schema string, source_table string, table_version int, partition_id string, date string, file_index int, "
        "block_start int, row_seq int, commit_ts int"
    )
    df = spark.createDataFrame(data, schema)
    expected = rows(checks.commit_order_violations(df, order, chunk_rows=16))
    monkeypatch.setattr(prefix, "ONE_STEP", 0)
    assert expected and rows(checks.commit_order_violations(df, order, chunk_rows=16)) == expected
