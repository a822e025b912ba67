"""Applying changes: window, order, truncates, latest change per key, current state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import target_table
from .facts import TABLE, attach_facts

# One total order of the changes of a table. Rows of a truncated version come after its
# marker because both carry that version, so the marker needs no place of its own here.
POSITION = ("table_version", "partition_id", "date", "file_index", "block_start", "row_seq")
STREAM = (*TABLE, "table_version", "partition_id")
# fixed values: ddl type codes of table and partition truncation
TRUNCATE_TYPES = (11, 23)


def in_window(changes: DataFrame, lower: int | Column, upper: int | Column) -> DataFrame:
    """Changes after the snapshot position and not after the checkpoint."""
    ts = F.col("commit_ts")
    return changes.where((ts > lower) & (ts <= upper))


def managed_only(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of tables that are in the catalog."""
    return attach_facts(rows, catalog.select(*TABLE).distinct(), how="left_semi")


def order_key(order: Sequence[str] = POSITION) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _last(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Last row per key. Partial aggregation runs before the shuffle, so a hot key is one row
    per map task by the time it moves."""
    names = [c for c in rows.columns if c not in keys]
    if all(isinstance(o, str) for o in order) and all(_sortable(rows.schema[c].dataType) for c in names):
        # the order columns lead the struct, so max() of it is the last row; one struct moves
        rest = [c for c in names if c not in order]
        agg = F.max(F.struct(*order, *rest))
    else:
        agg = F.max_by(F.struct(*names), F.struct(*order))
    return rows.groupBy(*keys).agg(agg.alias("_last")).select(*keys, *[f"_last.`{c}`" for c in names])


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], commit_order: str = "table"
) -> DataFrame:
    """Last change of every key (deletes included).

    ``commit_order='stream'`` is for tables whose partitions interleave in time: inside a
    partition the position decides, between partitions the commit time, and at one commit time
    an upsert beats a delete (the row moved to another partition).
    """
    if commit_order == "table":
        return _last(changes, keys, POSITION)
    if commit_order != "stream":
        raise ValueError(f"commit_order must be table or stream, not {commit_order!r}")
    inside = _last(changes, [*keys, "partition_id"], [c for c in POSITION if c != "partition_id"])
    upsert_last = F.when(F.col("op") == "D", 0).otherwise(1)
    between = [F.col("table_version"), F.col("commit_ts"), upsert_last, F.col("partition_id")]
    return _last(inside, keys, between)


def dedupe_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order`` (upsert semantics of a snapshot load)."""
    return _last(rows, keys, order)


def not_among(rows: DataFrame, changed: DataFrame, keys: Sequence[str], changed_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows whose key is not among the changed ones; keys that are NULL are equal."""
    other = [f"_same{i}" for i in range(len(keys))]
    gone = changed.select(*[F.col(f"`{k}`").alias(o) for k, o in zip(changed_keys or keys, other)])
    match = [F.col(f"`{k}`").eqNullSafe(F.col(o)) for k, o in zip(keys, other)]
    return rows.join(gone, reduce(lambda a, b: a & b, match), "left_anti")


def current_state(
    previous: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    commit_order: str = "table",
) -> DataFrame:
    """State after ``changes``, in the columns of ``previous`` (which has one row per key).

    Only the changes are aggregated. The previous state is neither sorted nor aggregated:
    keys that changed are anti-joined away, which is a broadcast when the changed keys are
    few and a key-partitioned join when they are not; keys are unique on both sides, so the
    join cannot skew.
    """
    latest = latest_per_key(changes, keys, commit_order)
    kept = not_among(previous, latest, keys)
    wanted = [
        (F.col(c) if c in latest.columns else F.lit(None).cast(previous.schema[c].dataType)).alias(c)
        for c in previous.columns
    ]
    return kept.select(*previous.columns).unionByName(latest.where("op <> 'D'").select(*wanted))


def is_truncate() -> Column:
    by_text = F.coalesce(F.col("query"), F.lit("")).rlike(r"(?i)^\s*truncate table")
    return F.col("ddl_type").isin(*TRUNCATE_TYPES) | by_text


def baseline_versions(registry: DataFrame, snapshot_position: int | Column) -> DataFrame:
    """Per table, the newest definition that the snapshot already contains."""
    return (
        registry.where(F.col("table_version") <= snapshot_position)
        .groupBy(*TABLE)
        .agg(F.max("table_version").alias("baseline_version"))
    )


def effective_watermarks(baselines: DataFrame, watermarks: DataFrame | None = None) -> DataFrame:
    """Per table ``effective_version = max(saved watermark, baseline)``."""
    rows = baselines.select(*TABLE, F.col("baseline_version").alias("v"))
    if watermarks is not None:
        rows = rows.unionByName(watermarks.select(*TABLE, F.col("ddl_watermark").alias("v")))
    return rows.groupBy(*TABLE).agg(F.max("v").alias("effective_version"))


def skip_late_versions(rows: DataFrame, effective: DataFrame) -> DataFrame:
    """Drop rows (or file ranges) of versions below their table's effective watermark."""
    kept = attach_facts(rows, effective)
    old = F.col("table_version") < F.coalesce(F.col("effective_version"), F.lit(0))
    return kept.where(~old).drop("effective_version")


def truncates(registry: DataFrame, effective: DataFrame, upper: int | Column) -> DataFrame:
    """All truncating versions that are visible and not applied yet."""
    visible = registry.where((F.col("table_version") <= upper) & is_truncate())
    newer = visible.join(effective, list(TABLE), "left").where(
        F.col("table_version") > F.coalesce(F.col("effective_version"), F.lit(0))
    )
    return newer.select(*TABLE, F.col("table_version").alias("truncate_version"))


def truncate_points(registry: DataFrame, effective: DataFrame, upper: int | Column) -> DataFrame:
    """Per table, the newest of its :func:`truncates`."""
    return truncates(registry, effective, upper).groupBy(*TABLE).agg(F.max("truncate_version").alias("truncate_version"))


def cut_changes(changes: DataFrame, points: DataFrame) -> DataFrame:
    """Changes that survive their table's last truncate."""
    cut = F.col("truncate_version")
    kept = attach_facts(changes, points).where(cut.isNull() | (F.col("table_version") >= cut))
    return kept.drop("truncate_version")


def cut_state(previous: DataFrame, points: DataFrame) -> DataFrame:
    """Previous rows of tables that were not truncated."""
    return attach_facts(previous, points.select(*TABLE), how="left_anti")


def operations(
    changes: DataFrame, keys: Sequence[str], data: Sequence[str], truncates: DataFrame | None = None
) -> DataFrame:
    """Change rows as output operations: upserts with all data, deletes with the key only."""
    absent = [k for k in keys if k not in changes.columns]
    if absent:
        raise ValueError(f"delete needs the primary key columns {absent}")
    is_delete = F.col("op") == "D"
    values = [
        F.when(~is_delete, F.col(c)).alias(c) for c in data if c not in keys
    ]
    order = [c for c in POSITION if c in changes.columns]
    out = changes.select(
        F.when(is_delete, "delete").otherwise("upsert").alias("operation"),
        target_table(F.col("source_schema"), F.col("source_table")).alias("target_table"),
        *[F.col(k) for k in keys],
        *values,
        "commit_ts",
        *order,
    )
    if truncates is None:
        return out
    marks = truncates.select(
        F.lit("truncate").alias("operation"),
        target_table(F.col("source_schema"), F.col("source_table")).alias("target_table"),
        F.col("truncate_version").alias("table_version"),
    )
    return out.unionByName(marks, allowMissingColumns=True)


def operation_stats(ops: DataFrame, by: Sequence[str] = ("target_table",)) -> DataFrame:
    return ops.groupBy(*by, "operation").agg(F.count(F.lit(1)).alias("n_operations"))


def window_counts(changes: DataFrame, lower: int | Column, upper: int | Column, by=TABLE) -> DataFrame:
    """Rows before, inside and after the window, per table or per file."""
    ts = F.col("commit_ts")
    return changes.groupBy(*by).agg(
        F.count_if(ts <= lower).alias("rows_skipped"),
        F.count_if((ts > lower) & (ts <= upper)).alias("rows_emitted"),
        F.count_if(ts > upper).alias("rows_waiting"),
    )
