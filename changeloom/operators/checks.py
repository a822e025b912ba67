"""Structural checks. Each returns the offending rows, so a bad input is a result, not a loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .apply import POSITION, STREAM
from .facts import TABLE, attach_facts
from .prefix import max_before

# fixed values: operation codes of a change row
OPERATIONS = ("I", "U", "D")


class InputError(ValueError):
    """Raised in strict mode when a check has found violations."""


def bad_operation(op: Column) -> Column:
    return op.isNull() | ~op.isin(*OPERATIONS)


def bad_identity(schema: Column, table: Column, row_schema: Column, row_table: Column) -> Column:
    return ~(schema.eqNullSafe(row_schema) & table.eqNullSafe(row_table))


def bad_commit_ts(text: Column) -> Column:
    return text.isNull() | text.try_cast("bigint").isNull()


def violation_rule(rules: dict[str, Column]) -> Column:
    """Name of the first rule that a row breaks, NULL for a good row."""
    out = F.lit(None).cast("string")
    for name, broken in reversed(list(rules.items())):
        out = F.when(broken, F.lit(name)).otherwise(out)
    return out


def commit_order_violations(
    changes: DataFrame,
    commit_order: str = "table",
    carry: DataFrame | None = None,
    chunk_rows: int = 1 << 20,
) -> DataFrame:
    """Changes whose ``commit_ts`` is below one that came before them in the same table.

    ``commit_order='stream'`` compares inside one partition of one version only. ``carry``
    gives ``last_commit_ts`` per table from earlier runs.

    Rows are compared inside chunks of at most ``chunk_rows`` rows of one file block, and
    chunks through one summary row each, so no task ever sorts a whole table or a whole file;
    the summaries of a table are scanned in ranges of their order.
    """
    scope = list(STREAM if commit_order == "stream" else TABLE)
    chunk = [*TABLE, *POSITION[:-1], "chunk"]
    rows = changes.select(*TABLE, *POSITION, "commit_ts").withColumn(
        "chunk", F.floor(F.col("row_seq") / F.lit(chunk_rows)).cast("bigint")
    )
    inside = W.partitionBy(*chunk).orderBy("row_seq").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_seen", F.max("commit_ts").over(inside))

    summary = rows.groupBy(*chunk).agg(F.max("commit_ts").alias("_high"), F.min("commit_ts").alias("_low"))
    summary = max_before(summary, scope, chunk, "_high", "_carried")
    if carry is not None:
        facts = carry.select(*TABLE, F.col("last_commit_ts").alias("_saved"))
        summary = attach_facts(summary, facts).withColumn(
            "_carried", F.greatest("_carried", "_saved")
        )
    # only chunks that hold a row below the carried value need it
    late = summary.where(F.col("_low") < F.col("_carried")).select(*chunk, "_carried")
    joined = rows.join(late, chunk, "left")
    highest = F.greatest("_seen", "_carried")
    return joined.where(F.col("commit_ts") < highest).select(
        *TABLE, *POSITION, "commit_ts", highest.alias("highest_before")
    )


def missing_files(expected: DataFrame, files: DataFrame, on: Sequence[str] = ("path",)) -> DataFrame:
    """Files that an index names but the listing does not have.

    File names are made from ranges, so there may be far more than Spark's size estimate says: both sides are sorted
    by task, and none is sent through the driver as a broadcast.
    """
    return expected.join(files.select(*on).hint("merge"), list(on), "left_anti")


def missing_definitions(ranges: DataFrame, registry: DataFrame) -> DataFrame:
    """Index ranges whose version has no definition."""
    return ranges.join(
        registry.select(*TABLE, "table_version").distinct(), [*TABLE, "table_version"], "left_anti"
    )


def raise_if_any(violations: DataFrame, what: str, show: int = 5) -> None:
    """Strict mode: fail with the first few offending rows."""
    found = violations.limit(show).collect()
    if found:
        raise InputError(f"{what}: " + "; ".join(str(r.asDict()) for r in found))
