"""Progress tables: what a run has finished, so that the next one starts after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .apply import STREAM
from .facts import TABLE, attach_facts

TABLE_PROGRESS = (
    "source_schema string, source_table string, snapshot_done boolean, snapshot_position bigint, "
    "last_commit_ts bigint, ddl_watermark bigint"
)
STREAM_PROGRESS = (
    "source_schema string, source_table string, table_version bigint, partition_id bigint, "
    "last_date string, last_file_index bigint, latest_date string, "
    "latest_index_file_index bigint, last_commit_ts bigint"
)


def file_summary(changes: DataFrame, lower: int | Column, upper: int | Column) -> DataFrame:
    """One row per change file: highest ``commit_ts``, highest applied one, and row counts.

    All that progress and statistics need, in one pass over four narrow columns.
    """
    ts, is_delete = F.col("commit_ts"), F.col("op") == "D"
    inside = (ts > lower) & (ts <= upper)
    return changes.groupBy(*STREAM, "date", "file_index").agg(
        F.max(ts).alias("high_ts"),
        F.max(F.when(inside, ts)).alias("applied_ts"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(inside & ~is_delete).alias("n_upserts"),
        F.count_if(inside & is_delete).alias("n_deletes"),
        F.count_if(ts > upper).alias("n_waiting"),
    )


def with_finished(files: DataFrame, upper: int | Column) -> DataFrame:
    """Mark files before the first one of their stream that still holds rows past the checkpoint."""
    place = F.struct("date", "file_index")
    waiting = files.where(F.col("high_ts") > upper).groupBy(*STREAM).agg(F.min(place).alias("_stop"))
    finished = F.col("_stop").isNull() | (place < F.col("_stop"))
    return attach_facts(files, waiting, STREAM).withColumn("finished", finished).drop("_stop")


def stream_progress(
    files: DataFrame, ranges: DataFrame, upper: int | Column, previous: DataFrame | None = None
) -> DataFrame:
    """Per stream: last finished file, newest file the index names, last applied ``commit_ts``.

    ``files`` as from :func:`file_summary`, ``ranges`` with ``date, latest_file_index``. All three
    are maxima, so the previous progress is merged as one more input row per stream.
    """
    kind = "struct<date:string,file_index:bigint>"

    def place(a: str, b: str) -> Column:
        return F.struct(F.col(a).alias("date"), F.col(b).cast("bigint").alias("file_index")).cast(kind)

    nothing, no_ts = F.lit(None).cast(kind), F.lit(None).cast("bigint")
    done = F.when(F.col("finished"), place("date", "file_index"))
    rows = with_finished(files, upper).select(
        *STREAM, done.alias("done"), nothing.alias("seen"), F.col("applied_ts").alias("ts")
    ).unionByName(
        ranges.select(*STREAM, nothing.alias("done"), place("date", "latest_file_index").alias("seen"), no_ts.alias("ts"))
    )
    if previous is not None:
        rows = rows.unionByName(
            previous.select(
                *STREAM,
                place("last_date", "last_file_index").alias("done"),
                place("latest_date", "latest_index_file_index").alias("seen"),
                F.col("last_commit_ts").alias("ts"),
            )
        )
    merged = rows.groupBy(*STREAM).agg(
        F.max("done").alias("done"), F.max("seen").alias("seen"), F.max("ts").alias("ts")
    )
    return merged.select(
        *STREAM,
        F.coalesce("done.date", F.lit("")).alias("last_date"),
        F.coalesce("done.file_index", F.lit(0)).cast("bigint").alias("last_file_index"),
        F.coalesce("seen.date", F.lit("")).alias("latest_date"),
        F.coalesce("seen.file_index", F.lit(0)).cast("bigint").alias("latest_index_file_index"),
        F.coalesce("ts", F.lit(0)).cast("bigint").alias("last_commit_ts"),
    )


def commit_ts_by_table(commits: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    rows = commits.select(*TABLE, F.col("commit_ts").alias("last_commit_ts"))
    if previous is not None:
        rows = rows.unionByName(previous.select(*TABLE, "last_commit_ts"))
    return rows.groupBy(*TABLE).agg(F.max("last_commit_ts").alias("last_commit_ts"))


def ddl_watermarks(registry: DataFrame, upper: int | Column, effective: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Saved watermark per table: raised to the newest visible version above the effective one."""
    seen = (
        registry.where(F.col("table_version") <= upper)
        .join(effective, list(TABLE), "left")
        .where(F.col("table_version") > F.coalesce(F.col("effective_version"), F.lit(0)))
        .select(*TABLE, F.col("table_version").alias("ddl_watermark"))
    )
    if previous is not None:
        seen = seen.unionByName(previous.select(*TABLE, "ddl_watermark"))
    return seen.groupBy(*TABLE).agg(F.max("ddl_watermark").cast("bigint").alias("ddl_watermark"))


def pending_work(streams: DataFrame) -> DataFrame:
    """One row: is any stream behind the newest file its index names?"""
    behind = (F.col("last_date") < F.col("latest_date")) | (
        (F.col("last_date") == F.col("latest_date"))
        & (F.col("last_file_index") < F.col("latest_index_file_index"))
    )
    return streams.agg(F.coalesce(F.bool_or(behind), F.lit(False)).alias("pending"))


def compact(streams: DataFrame, catalog: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Keep streams of managed tables that are not below their watermark or not finished."""
    unfinished = (F.col("last_date") != F.col("latest_date")) | (
        F.col("last_file_index") < F.col("latest_index_file_index")
    )
    managed = attach_facts(streams, catalog.select(*TABLE).distinct(), how="left_semi")
    marked = attach_facts(managed, watermarks.select(*TABLE, "ddl_watermark"))
    old = F.col("table_version") < F.coalesce(F.col("ddl_watermark"), F.lit(0))
    return marked.where(~old | unfinished).drop("ddl_watermark")


def with_defaults(catalog: DataFrame, progress: DataFrame | None) -> DataFrame:
    """One progress row per catalog table; tables without one start from nothing."""
    names = [c.split()[0] for c in TABLE_PROGRESS.split(", ")][2:]
    base = catalog.select(*TABLE)
    if progress is None:
        joined = base.select(*TABLE, *[F.lit(None).alias(n) for n in names])
    else:
        joined = base.join(progress.select(*TABLE, *names), list(TABLE), "left")
    return joined.select(
        *TABLE,
        F.coalesce(F.col("snapshot_done").cast("boolean"), F.lit(False)).alias("snapshot_done"),
        *[F.coalesce(F.col(n).cast("bigint"), F.lit(0)).cast("bigint").alias(n) for n in names[1:]],
    )


def snapshots_complete(progress: DataFrame) -> DataFrame:
    return progress.agg(F.coalesce(F.bool_and("snapshot_done"), F.lit(True)).alias("complete"))


def changed_snapshot_position(progress: DataFrame, position: int | Column) -> DataFrame:
    """Tables whose saved snapshot position is set and differs from the dump's."""
    saved = F.col("snapshot_position")
    return progress.where((saved > 0) & (saved != position))
