"""Which files a stream has landed, as runs of file numbers.

Every landed batch leaves one snapshot below ``landed_ranges``: for each stream and date the runs of file numbers
without a gap. It is made of the snapshot before it and of the batch's own files, so what a trigger reads follows the
new files and the number of runs, not the batches that were landed before. A batch that is repeated writes
its snapshot anew from the one before it; a snapshot that was not finished has no ``_SUCCESS`` and is passed over.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.apply import STREAM
from ..operators.facts import attach_facts
from ..plans.state import StateStore

DAY = (*STREAM, "date")
RANGES = (
    "source_schema string, source_table string, table_version bigint, partition_id bigint, date string, "
    "first_file_index bigint, last_file_index bigint"
)
# snapshots that stay: the newest, and the one that it is made of again when its batch is repeated
KEPT = 2


def merged(ranges: DataFrame) -> DataFrame:
    """Runs of file numbers that touch or overlap, put together."""
    before = W.partitionBy(*DAY).orderBy("first_file_index", "last_file_index")
    reach = F.max("last_file_index").over(before.rowsBetween(W.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("first_file_index") > reach + 1)).cast("long")
    numbered = ranges.withColumn("_opens", opens).withColumn(
        "_run", F.sum("_opens").over(before.rowsBetween(W.unboundedPreceding, 0))
    )
    return numbered.groupBy(*DAY, "_run").agg(
        F.min("first_file_index").alias("first_file_index"), F.max("last_file_index").alias("last_file_index")
    ).drop("_run")


def snapshots(spark: SparkSession, store: StateStore) -> list[int]:
    """Batches that left a finished snapshot, in order."""
    base = spark._jvm.org.apache.hadoop.fs.Path(_base(store))
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    found = (re.fullmatch(r"batch-(\d+)", s.getPath().getName()) for s in fs.listStatus(base))
    numbers = sorted(int(m[1]) for m in found if m)
    return [n for n in numbers if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{_at(store, n)}/_SUCCESS"))]


def read(spark: SparkSession, store: StateStore) -> DataFrame | None:
    """The newest snapshot; ``None`` where no batch has left one."""
    known = snapshots(spark, store)
    return spark.read.schema(RANGES).parquet(_at(store, known[-1])) if known else None


def add(spark: SparkSession, store: StateStore, files: DataFrame, batch_id: int) -> None:
    """Write the snapshot of a batch from the one before it and the batch's files (stream, date, file number).

    Days that their stream's progress has left behind are dropped, as no range names them again.
    """
    known = [n for n in snapshots(spark, store) if n < batch_id]
    number = F.col("file_index").cast("bigint")
    new = files.where("file_index IS NOT NULL").select(
        *STREAM, "date", number.alias("first_file_index"), number.alias("last_file_index")
    )
    if known:
        new = spark.read.schema(RANGES).parquet(_at(store, known[-1])).unionByName(new)
    progress = store.streams().select(*STREAM, "last_date")
    open_days = attach_facts(new, progress, STREAM).where(
        "coalesce(last_date, '') = '' OR date = '' OR date >= last_date"
    )
    merged(open_days.drop("last_date")).write.mode("overwrite").parquet(_at(store, batch_id))
    _remove(spark, store, known[: len(known) - KEPT + 1])


def not_landed(ranges: DataFrame, landed: DataFrame) -> DataFrame:
    """Index ranges that are not inside one landed run; one row per range, whatever the number of its files."""
    runs = landed.select(*DAY, F.col("first_file_index").alias("_first"), F.col("last_file_index").alias("_last"))
    same = [ranges[c].eqNullSafe(runs[c]) for c in DAY]
    inside = (runs["_first"] <= ranges["first_file_index"]) & (runs["_last"] >= ranges["latest_file_index"])
    wanted = ranges["first_file_index"] <= ranges["latest_file_index"]
    for c in same:
        inside = inside & c
    return ranges.where(wanted).join(runs, inside, "left_anti")


def _base(store: StateStore) -> str:
    return f"{store.out}/landed_ranges"


def _at(store: StateStore, batch_id: int) -> str:
    return f"{_base(store)}/batch-{batch_id}"


def _remove(spark: SparkSession, store: StateStore, batches: list[int]) -> None:
    for n in batches:
        where = spark._jvm.org.apache.hadoop.fs.Path(_at(store, n))
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
