"""Running values along an order, without one task for a whole scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..local import local_frame
from ..workdir import work_dir

# rows of a frame that is scanned in one step, fetched as they are
ONE_STEP = 5_000


def max_before(rows: DataFrame, scope: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """``rows`` with the highest ``value`` of the rows before each in its scope (NULL for the first).

    ``scope`` and ``order`` together are unique. Up to ``ONE_STEP`` rows are scanned by one window. More are dealt to
    ranges of the order and written, since a range must mean the same rows in every pass; then each range is
    scanned by itself and the ranges of a scope through one row each. With n rows and p partitions the largest task holds
    about n / p rows or p, whether one scope has them all or not.
    """
    rest = [c for c in order if c not in scope]
    few = rows.limit(ONE_STEP + 1).collect()
    if len(few) <= ONE_STEP:
        before = W.partitionBy(*scope).orderBy(*rest).rowsBetween(W.unboundedPreceding, -1)
        return local_frame(rows.sparkSession, few, rows.schema).withColumn(out, F.max(value).over(before))
    return _by_ranges(rows, list(scope), rest, value, out)


def _by_ranges(rows: DataFrame, scope: list[str], order: list[str], value: str, out: str) -> DataFrame:
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_dir(spark, "ranges")
    dealt = rows.repartitionByRange(parts, *scope, *order).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path)

    inside = W.partitionBy(*scope, "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranges = W.partitionBy(*scope).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    highs = kept.groupBy(*scope, "_range").agg(F.max(value).alias("_range_high"))
    earlier = highs.withColumn("_earlier", F.max("_range_high").over(ranges)).drop("_range_high")
    scanned = kept.withColumn("_inside", F.max(value).over(inside))
    joined = scanned.join(earlier, [*scope, "_range"])
    return joined.withColumn(out, F.greatest("_inside", "_earlier")).drop("_range", "_inside", "_earlier")
