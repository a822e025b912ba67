"""Replay of a workspace: snapshot, then the change log up to the checkpoint.

One run: load the snapshot of tables that do not have it yet, land the rows of new change files
as Parquet, check them, and write the next version of the state. CSV is parsed once; the checks,
the merge and the progress read narrow columns of the landed Parquet.
"""

from __future__ import annotations

import json
import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import bad_values, spark_type
from ..local import local_frame
from ..operators import apply as ap
from ..operators import checks, progress
from ..operators.facts import TABLE, attach_facts
from ..sources import catalog as cat
from ..sources import changelog as log
from ..sources import frontier
from ..sources import registry as reg
from ..sources import snapshot as snap
from ..sources.files import list_files, path_exists
from .state import StateStore, TableState, common_type, table_row
from .sweep import sweep

@dataclass
class Options:
    """How a workspace is read. The defaults are those of the dump and change-log writers."""

    tables: Sequence[str] = ()
    commit_order: str = "table"
    date_separator: str = "day"
    extra_field: bool = False
    multiline: bool = True
    strict: bool = True
    strict_unknown_files: bool = False
    diagnostics: str | None = None
    on_error: str = "raise"
    parallel_tables: int = 4
    keep_runs: int | None = 5
    type_keys: Sequence[str] = ()
    coercion: dict = field(default_factory=dict)


@dataclass
class Result:
    """What a run did.

    ``keyless`` names tables of the dump that are left out as they have no primary key, and ``duplicates`` the
    versions with several definition files (the last by path counts) and their number. ``held`` has the tables that
    wait (with ``strict=False``) for the definition of a version, and that version.
    """

    run: int
    checkpoint: int | None
    skipped: str | None = None
    stats: DataFrame | None = None
    seconds: dict[str, float] = field(default_factory=dict)
    keyless: list[tuple[str, str]] = field(default_factory=list)
    duplicates: list[tuple[str, str, int, int]] = field(default_factory=list)
    held: dict[tuple[str, str], int] = field(default_factory=dict)


class Clock:
    """Seconds per phase of a run."""

    def __init__(self):
        self.seconds, self._last = {}, time.perf_counter()

    def mark(self, phase: str) -> None:
        now = time.perf_counter()
        self.seconds[phase] = round(now - self._last, 3)
        self._last = now


def column_pairs(columns: Sequence[Row]) -> list[tuple[str, str]]:
    return [(c.name, c.source_type) for c in columns]


def _extra(options: Options) -> list[T.StructField]:
    if options.diagnostics is None:
        return []
    p = options.diagnostics
    return [
        T.StructField(f"{p}commit_ts", T.LongType()),
        T.StructField(f"{p}source_schema", T.StringType()),
        T.StructField(f"{p}source_table", T.StringType()),
    ]


def _typing(options: Options) -> dict:
    return {k: v for k, v in options.coercion.items() if k in ("json_as", "zero_dates")}


def table_schema(table: Row, layouts: Sequence[Sequence[tuple[str, str]]], options: Options, saved: T.StructType | None = None) -> T.StructType:
    """Columns of an output table: the snapshot's, then those that later versions added."""
    kinds: dict[str, list[T.DataType]] = defaultdict(list)
    for f in saved.fields if saved is not None else ():
        kinds[f.name].append(f.dataType)
    for layout in [column_pairs(table.columns), *layouts]:
        for name, declared in layout:
            kinds[name].append(spark_type(declared, **_typing(options)))
    extra = _extra(options)
    plain = [T.StructField(n, common_type(k)) for n, k in kinds.items() if n not in {e.name for e in extra}]
    return T.StructType(plain + extra)


def shaped(data: str, have: T.StructType, schema: T.StructType) -> list:
    """Fields of a struct column as the columns of an output table."""
    names = set(have.fieldNames())
    return [
        (F.col(f"{data}.`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


def key_aliases(keys: Sequence[str]) -> list[str]:
    return [f"_key{i}" for i in range(len(keys))]


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


# --- snapshot -------------------------------------------------------------------------------


def read_snapshot(spark: SparkSession, root: str, table: Row, options: Options | None = None) -> DataFrame:
    """Typed snapshot rows of one table, one per key (the last one read wins)."""
    options = options or Options()
    pairs = column_pairs(table.columns)
    named = snap.read_named(spark, root, table.file_stem, [n for n, _ in pairs], options.multiline)
    source = options.diagnostics and (options.diagnostics, table.source_schema, table.source_table)
    rows = snap.typed_rows(named, pairs, on_error=options.on_error, diagnostics=source, **options.coercion)
    aliases = key_aliases(table.primary_key)
    keyed = rows.withColumns({a: F.col(f"data.`{k}`") for a, k in zip(aliases, table.primary_key)})
    return ap.dedupe_rows(keyed, aliases, snap.FILE_ORDER).select("data.*")


def snapshot_quarantined(spark: SparkSession, root: str, table: Row, options: Options) -> DataFrame:
    """Rows of the wrong width and unreadable values of a snapshot, in the shape of :func:`quarantined`."""
    pairs = column_pairs(table.columns)
    named = snap.read_named(spark, root, table.file_stem, [n for n, _ in pairs], options.multiline)
    named = named.withColumns({
        "source_schema": F.lit(table.source_schema), "source_table": F.lit(table.source_table),
        "table_version": F.lit(0).cast("bigint"),
    })
    place = [*TABLE, "table_version", "path", "block_start", "row_seq"]
    width = snap.wrong_width(named, "c0").select(*place, F.lit("width").alias("rule"), F.col("record"))
    good = named.where(F.col(snap.BAD_RECORD).isNull() & (F.col("row_seq") >= 0))
    raw = {name: F.col(f"c{i}") for i, (name, _) in enumerate(pairs)}
    found = bad_values(good, raw, dict(pairs), place, **options.coercion)
    rule = F.concat(F.lit("value of "), "column_name", F.lit(" as "), "source_type")
    return width.unionByName(found.select(*place, rule.alias("rule"), F.col("raw_value").alias("record")))


def managed_tables(spark: SparkSession, root: str, options: Options) -> list[Row]:
    """Catalog rows of the chosen tables; two tables must not share an output name."""
    tables = cat.catalog(spark, root, options.tables, options.strict).collect()
    names = [t.target_table for t in tables]
    shared = sorted({n for n in names if names.count(n) > 1})
    if shared:
        raise checks.InputError(f"several source tables have the output name {shared}")
    return tables


def guard_snapshot(spark: SparkSession, root: str, saved: DataFrame) -> int:
    """Position of the snapshot; raises when the dump is gone or is not the one of earlier runs."""
    if not path_exists(spark, snap.snapshot_dir(root)):
        raise checks.InputError(f"there is no snapshot below {root}")
    position = cat.snapshot_position(spark, root)
    moved = progress.changed_snapshot_position(saved, position)
    checks.raise_if_any(moved.select(*TABLE, "snapshot_position"), f"the snapshot position is now {position}")
    return position


# --- change files ---------------------------------------------------------------------------


def find_ranges(
    spark: SparkSession, root: str, versions: Sequence[tuple[str, str, int]], streams: DataFrame | None, options: Options
) -> DataFrame:
    """File ranges of the given versions that hold something new."""
    indexes = log.read_indexes(spark, root, versions, options.date_separator)
    return log.new_ranges(log.file_ranges(indexes, options.strict), streams)


def layouts_of(definitions: Sequence[Row]) -> dict[tuple, list[int]]:
    """Versions by column list: all versions of one list are read in one scan."""
    groups: dict[tuple, list[int]] = defaultdict(list)
    for d in definitions:
        groups[tuple(column_pairs(d.columns))].append(d.table_version)
    return groups


# ranges, folders or files that the driver holds at a time (about: they are dealt by hash), and files of a folder that
# is read as a whole
WAVE = 5_000
FOLDER_FILES = 1_000


def bounded(spark: SparkSession, rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Rows as a local relation where they are few, else written to ``path``; and their number."""
    few = rows.limit(WAVE + 1).collect()
    if len(few) <= WAVE:
        return local_frame(spark, few, rows.schema), len(few)
    rows.write.mode("overwrite").parquet(path)
    kept = spark.read.schema(rows.schema).parquet(path)
    return kept, kept.count()


def waves(rows: DataFrame, n: int, key: str) -> Iterator[list[Row]]:
    """All rows, about ``WAVE`` at a time."""
    parts = -(-n // WAVE)
    for k in range(parts):
        mine = rows if parts == 1 else rows.where(F.pmod(F.xxhash64(key), F.lit(parts)) == k)
        yield mine.collect()


def read_units(ranges: DataFrame) -> DataFrame:
    """Paths to read: whole folders where nothing was read before, else the new files only."""
    whole = (F.col("first_file_index") == 1) & (F.col("latest_file_index") <= FOLDER_FILES)
    place = [*TABLE, "table_version"]
    folders = ranges.where(whole).select(*place, F.col("data_dir").alias("path"))
    return folders.unionByName(log.expand_files(ranges.where(~whole)).select(*place, "path"))


def listed_files(spark: SparkSession, ranges: DataFrame, path: str) -> DataFrame:
    """Change files that are there in the folders of the ranges, listed in waves."""
    folders, n = bounded(spark, ranges.select("data_dir").distinct(), f"{path}/folders")
    found = None
    for i, wave in enumerate(waves(folders, n, "data_dir")):
        found = list_files(spark, sorted(r.data_dir for r in wave), "CDC*.csv").select("path")
        if n > WAVE:
            found.write.mode("append" if i else "overwrite").parquet(f"{path}/listed")
    return spark.read.schema(found.schema).parquet(f"{path}/listed") if n > WAVE else found


def read_landing_rows(
    spark: SparkSession, root: str, definitions: Sequence[Row], paths_of: Callable[[set], list[str]], options: Options
) -> DataFrame | None:
    """Rows of change files in the landing shape: one scan per row width, for all tables at once.

    ``paths_of`` gives the paths to read for a set of ``(schema, table, version)``.
    """
    widths: dict[int, set] = defaultdict(set)
    for d in definitions:
        widths[len(d.columns)].add((d.source_schema, d.source_table, d.table_version))
    parts = []
    for n, versions in widths.items():
        paths = paths_of(versions)
        if paths:
            fields = log.read_fields(
                spark, root, paths, n, extra_field=options.extra_field,
                multiline=options.multiline, date_separator=options.date_separator,
            )
            parts.append(log.landed_rows(fields, n))
    return union_all(parts) if parts else None


def in_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of files that the index names and progress does not cover."""
    wanted = ranges.select(*ap.STREAM, "date", "first_file_index", "latest_file_index")
    inside = F.col("file_index").between(F.col("first_file_index"), F.col("latest_file_index"))
    joined = attach_facts(rows, wanted, [*ap.STREAM, "date"], "inner")
    return joined.where(inside).select(*rows.columns)


def typed_changes(
    landed: DataFrame, table: Row, definitions: Sequence[Row], schema: T.StructType, options: Options
) -> DataFrame:
    """Typed changes of one table, ``data`` in the columns of the output table."""
    parts = []
    for layout, versions in layouts_of(definitions).items():
        lost = [k for k in table.primary_key if k not in dict(layout)]
        if lost:
            raise checks.InputError(
                f"versions {versions} of {table.source_schema}.{table.source_table} lack key columns {lost}"
            )
        mine = log.fields_of_landed(landed.where(F.col("table_version").isin(versions)), len(layout))
        rows = log.typed_rows(
            mine, layout, on_error=options.on_error, diagnostics=options.diagnostics, **options.coercion
        )
        data = F.struct(*shaped("data", rows.schema["data"].dataType, schema))
        parts.append(rows.withColumn("data", data))
    return union_all(parts)


def quarantined(landed: DataFrame, definitions: Sequence[Row], options: Options) -> DataFrame:
    """Rows and values that could not be used, with the rule they broke."""
    names = [*TABLE, "table_version", "path", "block_start", "row_seq", "rule", "record"]
    parts = [landed.where("rule IS NOT NULL").select(*names)]
    for layout, versions in layouts_of(definitions).items():
        mine = log.fields_of_landed(landed.where(F.col("table_version").isin(versions)), len(layout))
        found = log.value_violations(mine, layout, **options.coercion)
        rule = F.concat(F.lit("value of "), "column_name", F.lit(" as "), "source_type")
        parts.append(found.withColumns({"rule": rule, "record": F.col("raw_value")}).select(*names))
    return union_all(parts)


# --- runs -----------------------------------------------------------------------------------


@dataclass
class Plan:
    """Metadata of one change-log run. Its size follows the number of tables and versions; the file ranges, of which
    there may be far more, stay a DataFrame. ``touched`` has the tables with files to read."""

    tables: list[Row]
    saved: dict[tuple[str, str], TableState]
    position: int
    upper: int
    registry: DataFrame
    definitions: dict[tuple[str, str], list[Row]]
    effective: DataFrame
    truncated: dict[tuple[str, str], int]
    ranges: DataFrame
    n_ranges: int
    touched: set[tuple[str, str]]
    streams: DataFrame | None = None
    duplicates: list[tuple[str, str, int, int]] = field(default_factory=list)
    held: dict[tuple[str, str], int] = field(default_factory=dict)

    def bounds(self, spark: SparkSession) -> DataFrame:
        rows = [(*k, self.lower(k), upper_of(k, self.saved, self.held, self.upper)) for k in by_table(self.tables)]
        return local_frame(spark, rows, "source_schema string, source_table string, lower_ts bigint, upper_ts bigint")

    def lower(self, key: tuple[str, str]) -> int:
        """Rows up to the last checkpoint are in the state, if their file was named by the index then."""
        row = self.saved.get(key)
        return max(self.position, row.checkpoint if row is not None else 0)

    def with_bounds(self, rows: DataFrame) -> DataFrame:
        """Add ``lower_ts``, the bound below which a row is in the state already, and ``upper_ts``, past which it waits.

        The lower one is the snapshot's position for files that no run has seen, and the checkpoint for others, which a
        run may have applied in part.
        """
        bounded = attach_facts(rows, self.bounds(rows.sparkSession), n_facts=len(self.tables))
        if self.streams is None:
            return bounded
        place = F.struct("date", "file_index")
        newest = F.struct(F.col("latest_date").alias("date"), F.col("latest_index_file_index").alias("file_index"))
        joined = attach_facts(bounded, self.streams.select(*ap.STREAM, newest.alias("_seen")), ap.STREAM)
        seen = F.coalesce(place <= F.col("_seen"), F.lit(False))
        return joined.withColumn("lower_ts", F.when(seen, F.col("lower_ts")).otherwise(self.position)).drop("_seen")

    def without_absent(self, absent: DataFrame, path: str) -> None:
        """Let every stream end before its first absent file."""
        kind = "struct<date:string,file_index:bigint>"
        first = absent.groupBy(*ap.STREAM).agg(F.min(F.struct("date", "file_index").cast(kind)).alias("_absent"))
        kept = attach_facts(self.ranges, first, ap.STREAM)
        whole = F.col("_absent").isNull() | (F.col("date") < F.col("_absent.date"))
        last = F.when(whole, F.col("latest_file_index")).when(
            F.col("date") == F.col("_absent.date"), F.col("_absent.file_index") - 1
        )
        kept = kept.withColumn("latest_file_index", last).drop("_absent")
        kept = kept.where("latest_file_index >= first_file_index")
        self.ranges, self.n_ranges = bounded(absent.sparkSession, kept, path)
        self.touched = tables_of(self.ranges)


def tables_of(ranges: DataFrame) -> set[tuple[str, str]]:
    return {(r.source_schema, r.source_table) for r in ranges.select(*TABLE).distinct().collect()}


def upper_of(key: tuple[str, str], saved: dict, held: dict, upper: int) -> int:
    """The checkpoint of one table: that of the log, or what lies before the version it waits for."""
    if key not in held:
        return upper
    return max(saved[key].checkpoint, min(upper, held[key] - 1))


def by_table(rows) -> dict[tuple[str, str], Row]:
    return {(r.source_schema, r.source_table): r for r in rows}


def load_snapshot(
    spark: SparkSession, root: str, store: StateStore, options: Options, tables: list[Row] | None = None
) -> int:
    """Load the snapshot of every table that does not have it yet; returns the current run."""
    current = store.latest_run()
    known = store.table_states(current)
    position = guard_snapshot(spark, root, store.tables(current))
    tables = tables or managed_tables(spark, root, options)
    loaded_before = {k for k, t in known.items() if t.snapshot_done}
    waiting = [t for t in tables if (t.source_schema, t.source_table) not in loaded_before]
    if not waiting:
        return current
    run = current + 1

    def load(table: Row):
        schema = table_schema(table, [], options)
        rows = read_snapshot(spark, root, table, options).select(*schema.fieldNames())
        if options.on_error != "raise":
            bad = snapshot_quarantined(spark, root, table, options)
            bad.write.mode("overwrite").parquet(f"{store.out}/quarantine/{run}/{table.target_table}")
        return table, schema, store.write_buckets(rows, table.target_table, run, table.primary_key)

    with ThreadPoolExecutor(options.parallel_tables) as pool:
        loaded = list(pool.map(load, waiting))
    lines = {k: saved_line(t) for k, t in known.items()}
    for table, schema, written in loaded:
        key = (table.source_schema, table.source_table)
        lines[key] = table_row(
            {b: run for b in written}, source_schema=key[0], source_table=key[1], snapshot_done=True,
            snapshot_position=position, last_commit_ts=0, ddl_watermark=0, target_table=table.target_table,
            schema_json=json.dumps(schema.jsonValue()), checkpoint=0, batch_id=None,
        )
    store.finish(run, list(lines.values()), store.streams(current) if current else None)
    return run


def saved_line(table: TableState) -> dict:
    return {k: v for k, v in vars(table).items() if k not in ("in_force", "n_buckets")}


def plan_log(
    spark: SparkSession, root: str, store: StateStore, current: int, options: Options,
    tables: list[Row] | None = None,
) -> Plan | Result:
    """Everything a change-log run must know, or why there is nothing to do."""
    saved_rows = store.tables(current)
    tables = tables or managed_tables(spark, root, options)
    saved = store.table_states(current)
    done = [saved.get((t.source_schema, t.source_table)) for t in tables]
    if not all(r is not None and r.snapshot_done for r in done):
        return Result(current, None, "a snapshot is not complete")
    position = done[0].snapshot_position
    if position <= 0:
        raise checks.InputError("the snapshot position must be above 0 before changes are applied")
    upper = log.checkpoint_bound(spark, root)
    if upper is None:
        return Result(current, None, "there is no change log yet")
    streams = store.streams(current)
    if options.strict and all(r.checkpoint == upper for r in done) and not progress.pending_work(streams).first().pending:
        return Result(current, upper, "nothing is new")
    scope = [(t.source_schema, t.source_table) for t in tables]
    if options.strict_unknown_files:
        checks.raise_if_any(log.unknown_files(spark, root, scope), "unknown files beside the definitions")
    managed = local_frame(spark, scope, "source_schema string, source_table string")
    found = reg.registry(spark, root, managed, upper, options.strict, scope, options.type_keys)
    catalog_rows = local_frame(spark, 
        [(*k, t.columns) for k, t in by_table(tables).items()],
        "source_schema string, source_table string, "
        "columns array<struct<name:string,source_type:string,nullable:boolean,pos:int>>",
    )
    definitions = reg.effective_columns(found, catalog_rows)
    # the definitions are read and checked once; what follows works on this copy of them
    rows = definitions.collect()
    registry = local_frame(spark, rows, definitions.schema)
    effective = ap.effective_watermarks(ap.baseline_versions(registry, position), saved_rows)
    oldest = by_table(effective.collect())
    past = {k: r.effective_version for k, r in oldest.items()}
    held = frontier.find(spark, root, scope, rows, past, upper, options.strict, options.date_separator)
    if held:
        rows = frontier.defined_until(rows, held)
        registry = local_frame(spark, rows, definitions.schema)
    cuts = by_table(ap.truncate_points(registry, effective, upper).collect())
    grouped = defaultdict(list)
    for r in rows:
        key = (r.source_schema, r.source_table)
        if key not in oldest or r.table_version >= oldest[key].effective_version:
            grouped[key].append(r)
    ranges = find_ranges(spark, root, [(*k, d.table_version) for k, ds in grouped.items() for d in ds], streams, options)
    ranges, n_ranges = bounded(spark, ranges.drop("path"), f"{store.out}/runs/{current + 1}/ranges")
    if not n_ranges and all(r.checkpoint == upper_of(r.key, saved, held, upper) for r in done):
        return Result(current, upper, "nothing is new", held=held)
    return Plan(
        tables, saved, position, upper, registry, grouped, effective,
        {k: r.truncate_version for k, r in cuts.items()},
        ranges, n_ranges, tables_of(ranges), streams,
        [(r.source_schema, r.source_table, r.table_version, r.n_files) for r in rows if r.n_files > 1],
        held,
    )


def apply_run(
    spark: SparkSession, store: StateStore, current: int, plan: Plan, landed: DataFrame,
    options: Options, batch_id: int | None = None,
) -> Result:
    """Write the next version of state and progress from landed rows."""
    run = current + 1
    ts = F.col("commit_ts")
    landed = plan.with_bounds(landed)
    if options.strict:
        saved = [(*k, r.last_commit_ts) for k, r in plan.saved.items()]
        carry = local_frame(spark, saved, "source_schema string, source_table string, last_commit_ts bigint")
        window = landed.where((ts > F.col("lower_ts")) & (ts <= F.col("upper_ts")))
        checks.raise_if_any(
            checks.commit_order_violations(window, options.commit_order, carry), "commit time goes backwards"
        )

    def apply_table(table: Row):
        key = (table.source_schema, table.source_table)
        definitions, saved = plan.definitions.get(key, []), plan.saved[key]
        before = saved.schema
        schema = table_schema(table, [column_pairs(d.columns) for d in definitions], options, before)
        cut = plan.truncated.get(key)
        buckets = {} if cut is not None else dict(saved.in_force)
        if key not in plan.touched:
            return table, before, buckets
        rows = landed.where(F.col("_target") == table.target_table)
        window = rows.where(ts.isNull() | ((ts > F.col("lower_ts")) & (ts <= F.col("upper_ts")))).drop("lower_ts", "upper_ts")
        if options.on_error != "raise":
            bad = quarantined(window, definitions, options)
            bad.write.mode("overwrite").parquet(f"{store.out}/quarantine/{run}/{table.target_table}")
        if cut is not None:
            window = window.where(F.col("table_version") >= cut)
        changes = typed_changes(window, table, definitions, schema, options)
        keys = list(table.primary_key)
        aliases = key_aliases(keys)
        keyed = changes.withColumns({a: F.col(f"data.`{k}`") for a, k in zip(aliases, keys)})
        latest = ap.latest_per_key(keyed, aliases, options.commit_order)
        # written once, in one file for each task: it tells which buckets change, and both sides of the merge read it
        path = f"{store.out}/delta/{table.target_table}/{run}"
        delta = latest.select(*aliases, "op", "data").withColumn("_bucket", store.bucket_of(aliases))
        delta.write.mode("overwrite").parquet(path)
        delta = spark.read.schema(delta.schema).parquet(path)
        touched = {r[0] for r in delta.select("_bucket").distinct().collect()}
        if any(f.dataType != schema[f.name].dataType for f in before.fields):
            touched |= set(buckets)  # a column was widened: all rows move to the new type
        if touched:
            stored = store.read_buckets(
                table.target_table, before, [(b, buckets[b]) for b in sorted(touched) if b in buckets]
            )
            previous = stored.select(F.struct("*").alias("row")).select(*shaped("row", before, schema))
            kept = ap.not_among(previous, delta, keys, aliases)
            upserts = delta.where("op <> 'D'").select("data.*")
            written = store.write_buckets(kept.unionByName(upserts), table.target_table, run, keys)
            buckets = {b: r for b, r in buckets.items() if b not in touched} | {b: run for b in written}
        return table, schema, buckets

    with ThreadPoolExecutor(options.parallel_tables) as pool:
        applied = list(pool.map(apply_table, plan.tables))
    return _finish_log(spark, store, current, run, plan, landed, applied, batch_id)


def _finish_log(spark, store, current, run, plan, landed, applied, batch_id) -> Result:
    """Progress and statistics of a change-log run, then its switch."""
    rows = landed.select(*ap.STREAM, "date", "file_index", "commit_ts", "op", "lower_ts", "upper_ts")
    place = [*ap.STREAM, "date", "file_index"]
    named = log.expand_files(plan.ranges).select(*place)
    summary = progress.file_summary(rows, F.col("lower_ts"), F.col("upper_ts"))
    path = f"{store.out}/runs/{run}/files"
    found = named.join(summary, place, "left")
    found.write.mode("overwrite").parquet(path)
    files = spark.read.schema(found.schema).parquet(path)
    uppers = plan.bounds(spark).select(*TABLE, "upper_ts")
    files_to = attach_facts(files, uppers, n_facts=len(plan.tables))
    streams = progress.stream_progress(files_to, plan.ranges, F.col("upper_ts"), store.streams(current))
    saved = store.tables(current)
    marks = progress.ddl_watermarks(plan.registry, plan.upper, plan.effective, saved)
    managed = local_frame(spark, list(by_table(plan.tables)), "source_schema string, source_table string")
    streams = progress.compact(streams, managed, marks)

    mark_of = by_table(marks.collect())
    applied_ts = files.where("applied_ts IS NOT NULL").select(*TABLE, F.col("applied_ts").alias("commit_ts"))
    ts_of = by_table(progress.commit_ts_by_table(applied_ts, saved).collect())
    lines = {k: saved_line(t) for k, t in plan.saved.items()}
    for table, schema, in_force in applied:
        key = (table.source_schema, table.source_table)
        lines[key] = table_row(
            in_force, source_schema=key[0], source_table=key[1], snapshot_done=True,
            snapshot_position=plan.position, last_commit_ts=ts_of[key].last_commit_ts,
            ddl_watermark=mark_of[key].ddl_watermark if key in mark_of else 0, target_table=table.target_table,
            schema_json=json.dumps(schema.jsonValue()), checkpoint=upper_of(key, plan.saved, plan.held, plan.upper),
            batch_id=batch_id,
        )
    store.finish(run, list(lines.values()), streams)
    cut = [(*k, "truncate", 1) for k in plan.truncated]
    counts = files.groupBy(*TABLE).agg(F.sum("n_upserts").alias("upsert"), F.sum("n_deletes").alias("delete"))
    stats = counts.unpivot(list(TABLE), ["upsert", "delete"], "operation", "n_operations").where("n_operations > 0")
    stats = stats.unionByName(
        local_frame(spark, cut, "source_schema string, source_table string, operation string, n_operations bigint")
    )
    return Result(run, plan.upper, None, stats, duplicates=plan.duplicates, held=plan.held)


def apply_log(
    spark: SparkSession, root: str, store: StateStore, options: Options, tables: list[Row] | None = None
) -> Result:
    """One batch run of the change log up to its checkpoint."""
    clock, current = Clock(), store.latest_run()
    plan = plan_log(spark, root, store, current, options, tables)
    clock.mark("plan")
    if isinstance(plan, Result):
        plan.seconds = clock.seconds
        return plan
    if plan.n_ranges:
        base = f"{store.out}/runs/{current + 1}"
        missing = checks.missing_files(log.expand_files(plan.ranges), listed_files(spark, plan.ranges, base))
        if options.strict:
            checks.raise_if_any(missing.select("path"), "change files named by an index are missing")
        else:
            plan.without_absent(missing, f"{base}/ranges_there")
    landed, skipped = land_run(spark, root, store, current + 1, plan, options)
    clock.mark("land")
    result = apply_run(spark, store, current, plan, landed, options)
    clock.mark("apply")
    result.seconds = clock.seconds
    if skipped is not None:
        result.stats = result.stats.unionByName(skipped)
    return result


def with_target(rows: DataFrame, tables: Sequence[Row]) -> DataFrame:
    """Add the output table's name, which landing is partitioned by; unmanaged rows go away."""
    targets = local_frame(rows.sparkSession, 
        [(t.source_schema, t.source_table, t.target_table) for t in tables],
        "source_schema string, source_table string, _target string",
    )
    return attach_facts(rows, targets, how="inner", n_facts=len(tables))


# the part of a landing that holds the rows which the lower bound skips; no output table has this name
SKIPPED = "_skipped"


def land_run(
    spark: SparkSession, root: str, store: StateStore, run: int, plan: Plan, options: Options
) -> tuple[DataFrame, DataFrame | None]:
    """Land the new rows of a batch run; also the number of rows per table that the lower bound skips.

    Skipped rows are landed too, without their values and in a part of their own, so the count needs no
    second pass over the change files.
    """
    definitions = [d for ds in plan.definitions.values() for d in ds]
    path = f"{store.out}/landing/run-{run}"
    units, n_units = bounded(spark, read_units(plan.ranges), f"{store.out}/runs/{run}/units")
    landed_any = False
    for wave in waves(units, n_units, "path"):
        by_version = defaultdict(list)
        for r in wave:
            by_version[r.source_schema, r.source_table, r.table_version].append(r.path)

        def paths_of(versions: set, found: dict = by_version) -> list[str]:
            return sorted(p for v in versions for p in found.get(v, ()))

        rows = read_landing_rows(spark, root, definitions, paths_of, options)
        if rows is None:
            continue
        rows = with_target(in_ranges(rows, plan.ranges), plan.tables)
        rows = plan.with_bounds(rows)
        skip = F.coalesce(F.col("commit_ts") <= F.col("lower_ts"), F.lit(False))
        rows = rows.withColumns({
            "_target": F.when(skip, F.lit(SKIPPED)).otherwise(F.col("_target")),
            **{c: F.when(~skip, F.col(c)) for c in ("row_values", "record")},
        }).drop("lower_ts", "upper_ts")
        rows.write.mode("append" if landed_any else "overwrite").partitionBy("_target").parquet(path)
        landed_any = True
    if not landed_any:
        return local_frame(spark, [], log.LANDED_SCHEMA), None
    landed = spark.read.schema(log.LANDED_SCHEMA).parquet(path)
    skipped = landed.where(F.col("_target") == SKIPPED).groupBy(*TABLE).agg(F.count("*").alias("n_operations"))
    skipped = skipped.withColumn("operation", F.lit("skipped"))
    return landed.where(F.col("_target") != SKIPPED), skipped


def replay(spark: SparkSession, root: str, out: str, *, buckets: int = 64, **options) -> Result:
    """Bring the state below ``out`` up to the checkpoint of the workspace at ``root``.

    Calling it again continues from the saved progress. Read results with
    ``StateStore(spark, out).read(target_table)``. Keyword arguments are those of
    :class:`Options`.
    """
    settings = Options(**options)
    store = StateStore(spark, out, buckets)
    clock = Clock()
    tables = managed_tables(spark, root, settings)
    load_snapshot(spark, root, store, settings, tables)
    clock.mark("snapshot")
    result = apply_log(spark, root, store, settings, tables)
    result.seconds = clock.seconds | result.seconds
    if settings.keep_runs is not None and result.skipped is None:
        sweep(spark, out, settings.keep_runs)
    left_out = cat.without_key(cat.discover(spark, root, settings.tables))
    result.keyless = [(r.source_schema, r.source_table) for r in left_out.collect()]
    return result


def read_changes(
    spark: SparkSession, root: str, tables: Row | Sequence[Row], lower: int, upper: int, options: Options | None = None
) -> DataFrame:
    """Typed changes with ``lower < commit_ts <= upper`` of one or more catalog tables.

    Needs no store. ``data`` has the columns of all given tables and versions by name, so give
    tables together only where a column name means the same in each. A version without a definition fails in
    strict mode and ends its table's changes otherwise.
    """
    options = options or Options()
    tables = [tables] if isinstance(tables, Row) else list(tables)
    keys = list(by_table(tables))
    columns = local_frame(spark, 
        [(t.source_schema, t.source_table, t.columns) for t in tables],
        "source_schema string, source_table string, "
        "columns array<struct<name:string,source_type:string,nullable:boolean,pos:int>>",
    )
    definitions = reg.effective_columns(reg.registry(spark, root, None, upper, options.strict, keys, options.type_keys), columns).collect()
    baseline = defaultdict(int)
    for d in definitions:
        key = (d.source_schema, d.source_table)
        if d.table_version <= lower:
            baseline[key] = max(baseline[key], d.table_version)
    definitions = [d for d in definitions if d.table_version >= baseline[(d.source_schema, d.source_table)]]
    held = frontier.find(spark, root, keys, definitions, baseline, upper, options.strict, options.date_separator)
    definitions = frontier.defined_until(definitions, held)
    versions = [(d.source_schema, d.source_table, d.table_version) for d in definitions]
    folders = set(frontier.version_folders(spark, root, keys))
    wanted = find_ranges(spark, root, [v for v in versions if v in folders], None, options)
    schema = table_schema(tables[0], [column_pairs(x.columns) for x in [*tables[1:], *definitions]], options)
    groups: dict[tuple, set] = defaultdict(set)
    for d in definitions:
        groups[tuple(column_pairs(d.columns))].add((d.source_schema, d.source_table, d.table_version))
    ts, parts = F.col("commit_ts"), []
    for layout, members in groups.items():
        # all folders of a version, also those without an index, whose rows go with in_ranges
        paths = sorted(f"{log.increment_dir(root)}/{s}/{t}/{v}" for s, t, v in members & folders)
        if not paths:
            continue
        fields = log.read_fields(
            spark, root, paths, len(layout), extra_field=options.extra_field,
            multiline=options.multiline, date_separator=options.date_separator, recursive=True,
        )
        window = fields.where(ts.isNull() | ((ts > lower) & (ts <= upper)))
        if held:
            ends = local_frame(spark, [(*k, v) for k, v in held.items()], "source_schema string, source_table string, _end bigint")
            window = attach_facts(window, ends, n_facts=len(held)).where("_end IS NULL OR commit_ts IS NULL OR commit_ts < _end").drop("_end")
        named = in_ranges(window, wanted)
        rows = log.typed_rows(named, layout, on_error=options.on_error, diagnostics=options.diagnostics, **options.coercion)
        parts.append(rows.withColumn("data", F.struct(*shaped("data", rows.schema["data"].dataType, schema))))
    if parts:
        return union_all(parts)
    meta = T._parse_datatype_string("op string, source_schema string, source_table string, commit_ts bigint, "
        "table_version bigint, partition_id bigint, date string, file_index bigint, block_start bigint, row_seq bigint")
    return local_frame(spark, [], T.StructType([*meta.fields, T.StructField("data", schema)]))


def read_operations(
    spark: SparkSession, root: str, table: Row, lower: int, upper: int, options: Options | None = None
) -> DataFrame:
    """What happens to one table with ``lower < commit_ts <= upper``: upserts, deletes and truncates.

    A truncate has its version as ``commit_ts`` and comes before the changes of that version; the order is
    ``commit_ts``, truncates first, then the place of the change.
    """
    options = options or Options()
    changes = read_changes(spark, root, table, lower, upper, options)
    columns = changes.schema["data"].dataType.fieldNames()
    clash = sorted(set(columns) & set(changes.columns))
    if clash:
        raise checks.InputError(f"columns {clash} of {table.source_table} are named like those of a change")
    flat = changes.select("*", "data.*").drop("data")
    scope = [(table.source_schema, table.source_table)]
    registry = reg.registry(spark, root, None, upper, options.strict, scope, options.type_keys)
    effective = ap.effective_watermarks(ap.baseline_versions(registry, lower))
    marks = ap.truncates(registry, effective, upper)
    feed = ap.operations(flat, list(table.primary_key), columns, marks)
    return feed.withColumn("commit_ts", F.coalesce("commit_ts", "table_version"))
