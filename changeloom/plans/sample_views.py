"""The driver's tables seen as a snapshot and a change log, in Spark and in SQL.

``events`` is the change log of five tables (one per event type), ``customer`` their snapshot.
All cut points follow from the number of events, so the views mean the same at every scale.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("e_click", "e_error", "e_purchase", "e_signup", "e_view")
KEYS = ("source_schema", "source_table", "pk")


@dataclass(frozen=True)
class Bounds:
    n: int
    lower: int
    upper: int
    step: int
    slots: int  # change files per day; grows with the data so that files stay small


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


_bounds: dict[tuple[str, str], Bounds] = {}


def bounds(spark: SparkSession, sf: str) -> Bounds:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _bounds:
        n = table(spark, sf, "events").agg(F.max("event_id")).first()[0] + 1
        _bounds[key] = Bounds(n, n // 10, n * 9 // 10, max(n // 4, 1), max(4, n // 15_000_000))
    return _bounds[key]


def _int_div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("bigint")


def changes(spark: SparkSession, sf: str) -> DataFrame:
    b = bounds(spark, sf)
    e, ts = F.col("event_id"), F.col("ts")
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
    return table(spark, sf, "events").select(
        F.when(e % 10 == 0, "D").when(e % 10 <= 3, "I").otherwise("U").alias("op"),
        F.lit("app").alias("source_schema"),
        F.concat(F.lit("e_"), "event_type").alias("source_table"),
        F.col("user_id").alias("pk"),
        (e + 1).alias("commit_ts"),
        (_int_div(e, b.step) * b.step).alias("table_version"),
        F.lit(0).cast("bigint").alias("partition_id"),
        F.date_format(ts, "yyyy-MM-dd").alias("date"),
        (_int_div(second * b.slots, 86400) + 1).alias("file_index"),
        F.lit(0).cast("bigint").alias("block_start"),
        e.alias("row_seq"),
        "value",
        "props",
    )


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.lit("app").alias("source_schema"),
        F.explode(F.array(*[F.lit(t) for t in TABLES])).alias("source_table"),
        F.col("c_custkey").alias("pk"),
        F.col("c_acctbal").alias("value"),
        F.lit(None).cast("string").alias("props"),
        F.lit(0).cast("bigint").alias("commit_ts"),
    )


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Managed tables; one table of the change log is left out on purpose."""
    found = changes(spark, sf).select("source_schema", "source_table").distinct()
    return found.where("source_table <> 'e_error'")


def definitions(spark: SparkSession, sf: str) -> DataFrame:
    """One definition per table and version seen in the change log, some of them truncating."""
    b = bounds(spark, sf)
    name, version = F.col("source_table"), F.col("table_version")
    found = changes(spark, sf).select("source_schema", "source_table", "table_version").distinct()
    return found.select(
        "*",
        F.when((name == "e_view") & (version == 2 * b.step), 11)
        .when((name == "e_click") & (version == 0), 11)
        .otherwise(0)
        .alias("ddl_type"),
        F.when(
            (name == "e_purchase") & (version == b.step), " TRUNCATE TABLE `app`.`e_purchase`"
        ).otherwise("").alias("query"),
    )


# the same views for the SQL side
SQL_BOUNDS = """b AS (SELECT n, n // 10 AS lower, n * 9 // 10 AS upper, greatest(n // 4, 1) AS step,
  greatest(4, n // 15000000) AS slots FROM (SELECT max(event_id) + 1 AS n FROM events))"""
SQL_CHG = """chg AS (SELECT CASE WHEN event_id % 10 = 0 THEN 'D' WHEN event_id % 10 <= 3 THEN 'I' ELSE 'U' END AS op,
  'app' AS source_schema, 'e_' || event_type AS source_table, user_id AS pk, event_id + 1 AS commit_ts,
  (event_id // step) * step AS table_version, CAST(0 AS BIGINT) AS partition_id, strftime(ts, '%Y-%m-%d') AS date,
  1 + ((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * slots) // 86400 AS file_index,
  CAST(0 AS BIGINT) AS block_start, event_id AS row_seq, value, props FROM events, b)"""
SQL_SNAP = """snap AS (SELECT 'app' AS source_schema, t.source_table, c_custkey AS pk, c_acctbal AS value,
  CAST(NULL AS VARCHAR) AS props, CAST(0 AS BIGINT) AS commit_ts FROM customer,
  (VALUES ('e_click'), ('e_error'), ('e_purchase'), ('e_signup'), ('e_view')) t(source_table))"""
SQL_CAT = """cat AS (SELECT DISTINCT source_schema, source_table FROM chg WHERE source_table <> 'e_error')"""
SQL_DEFS = """defs AS (SELECT DISTINCT source_schema, source_table, table_version,
  CASE WHEN source_table = 'e_view' AND table_version = 2 * step THEN 11
       WHEN source_table = 'e_click' AND table_version = 0 THEN 11 ELSE 0 END AS ddl_type,
  CASE WHEN source_table = 'e_purchase' AND table_version = step THEN ' TRUNCATE TABLE `app`.`e_purchase`'
       ELSE '' END AS query FROM chg, b)"""


# CRC-32 by its table of 256 numbers, each worked out from the polynomial; a text's bytes are folded one by one
SQL_CRC = """crc_table AS MATERIALIZED (SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs FROM (SELECT unnest(range(256)) AS i))"""


def sql_crc(text: str) -> str:
    """CRC-32 of an ASCII text that isn't empty; needs ``crc_table``."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"
    return f"xor(4294967295, list_reduce([4294967295] || {codes}, lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)])))"


def sql(body: str, *views: str) -> str:
    """A statement with the bounds, the change view and the named other views in front."""
    return "WITH " + ",\n".join([SQL_BOUNDS, SQL_CHG, *views]) + "\n" + body
