"""Joining change rows with per-table facts (catalog, watermarks, truncate points, ranges)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..local import local_frame

TABLE = ("source_schema", "source_table")


# facts up to this many rows and bytes (as JSON text) are broadcast
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 8_000_000
# equal shares of the rows that a heavy key is counted in, where there are fewer shuffle partitions
MIN_PARTS = 32


def attach_facts(
    rows: DataFrame,
    facts: DataFrame,
    on: Sequence[str] = TABLE,
    how: str = "left",
    n_facts: int | None = None,
) -> DataFrame:
    """Join many rows with few facts; ``facts`` holds one row per key.

    The facts are counted and measured first, and fetched if they are within both limits, unless the
    caller made them on the driver and passes their number. Within the limits they are broadcast, so the many rows
    stay where they are; a plan made from estimates would often shuffle those first and find out
    later that it had no need to. Past the limit the join shuffles, with the rows of heavy keys spread
    (:func:`spread_join`), because one table may hold most of all rows.
    """
    if n_facts is None:
        size = facts.agg(
            F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")
        ).first()
        n_facts = size.n if size.bytes <= BROADCAST_BYTES else BROADCAST_ROWS + 1
        if n_facts <= BROADCAST_ROWS:
            facts = local_frame(rows.sparkSession, facts.collect(), facts.schema)
    if n_facts <= BROADCAST_ROWS:
        return rows.join(F.broadcast(facts), list(on), how)
    return spread_join(rows, facts, on, how)


def spread_join(rows: DataFrame, facts: DataFrame, on: Sequence[str], how: str, parts: int | None = None) -> DataFrame:
    """Join on ``on`` with the rows of heavy keys spread over several parts.

    A key is heavy with more than one of ``parts`` equal shares of the rows, so there are fewer than ``parts`` such
    keys; each is given as many parts as it has shares, and its fact that many copies. All other keys keep one.
    A key with a NULL joins with nothing, so its rows may go anywhere.
    """
    spark = rows.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), MIN_PARTS)
    heavy = heavy_keys(rows, on, parts)
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    mixed = ["row_seq"] if "row_seq" in plain else plain
    place = F.xxhash64(*[F.col(f"`{c}`") for c in mixed])
    keyless = F.lit(False)
    for c in on:
        keyless = keyless | F.col(f"`{c}`").isNull()
    known = rows.join(F.broadcast(heavy), list(on), "left")
    shares = F.when(keyless, F.lit(parts)).otherwise(F.coalesce("_shares", F.lit(1)))
    dealt = known.withColumn("_part", F.pmod(place, shares).cast("int")).drop("_shares")
    last = F.coalesce("_shares", F.lit(1)) - 1
    copies = facts.join(F.broadcast(heavy), list(on), "left").withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
    return dealt.join(copies.drop("_shares"), [*on, "_part"], how).drop("_part")


def heavy_keys(rows: DataFrame, on: Sequence[str], parts: int) -> DataFrame:
    """Keys with more than one of ``parts`` equal shares of the rows, with the number of their shares."""
    share = max(rows.count() / parts, 1)
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share)
    shares = counts.dropna(subset=list(on)).withColumn("_shares", F.ceil(F.col("_n") / share).cast("int")).drop("_n")
    # fewer than ``parts`` rows
    return local_frame(rows.sparkSession, shares.collect(), shares.schema)
