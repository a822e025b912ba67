"""Queries that follow the sample workspace with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import follow
from ..streaming.follow import landed_files
from ..workdir import work_dir
from . import sample_workspace as ws
from .queries_apply import SQL_CURRENT_STATE
from .queries_workspace import _state
from .sample_views import sql
from .state import StateStore

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _follow(spark: SparkSession, sf: str, max_files: int) -> StateStore:
    """The sample log followed in several micro-batches."""
    root, out = ws.write_workspace(spark, sf), work_dir(spark, "state")
    query = follow(
        spark, root, out, work_dir(spark, "stream"), buckets=4, max_files=max_files,
        diagnostics="_cdc_", parallel_tables=5,
    )
    query.awaitTermination()
    return StateStore(spark, out, 4)


def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Files and rows that several micro-batches landed, per table."""
    files = landed_files(spark, _follow(spark, sf, 400))
    return files.groupBy("target_table").agg(
        F.count_if(F.col("n_rows") > 0).alias("n_files"), F.sum("n_rows").alias("n_rows"), F.max("high_ts").alias("high_ts")
    )


def stream_apply_state(spark: SparkSession, sf: str) -> DataFrame:
    """State after following the log in several micro-batches: the same as a batch replay."""
    return _state(_follow(spark, sf, 400))


QUERIES = {"stream_landing": stream_landing, "stream_apply_state": stream_apply_state}
ORACLES = {
    "stream_landing": sql(
        """SELECT 'app_' || source_table AS target_table, CAST(count(DISTINCT (table_version, date, file_index)) AS BIGINT) AS n_files,
          CAST(count(*) AS BIGINT) AS n_rows, max(commit_ts) AS high_ts FROM chg GROUP BY ALL"""
    ),
    "stream_apply_state": SQL_CURRENT_STATE,
}
