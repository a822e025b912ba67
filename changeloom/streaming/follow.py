"""Follow a change log: land new files as they appear, apply them when the log is complete.

The stream is over *files*: Spark's file source remembers which change files it has handed out
and how many a trigger may take. Each micro-batch lands the rows of its files in Parquet under
its batch id, so a repeated batch overwrites what it wrote before; a manifest of file numbers tells
what has been landed without the listings of all batches. Rows are applied up to a
checkpoint only when every file that the index files name for it has been landed; until then
state and watermarks stay as they are.

A file is read once, so the writer must publish change files whole (object stores do, and so
does writing elsewhere and renaming). Where it appends to files that are already visible, use
the batch replay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import names
from ..local import local_frame
from ..plans import replay as rp
from ..plans.state import StateStore
from ..plans.sweep import sweep
from ..sources import changelog as log
from ..sources import registry as reg
from ..sources.files import path_exists
from . import manifest

_FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"
_LANDED_FILES = "path string, target_table string, batch_id bigint, high_ts bigint, n_rows bigint"


def file_stream(spark: SparkSession, root: str, max_files: int) -> DataFrame:
    """New change files of all tables, however old; their contents are not read here.

    Every table's directory is a root of its own, since below a root the source passes over names that
    start with ``_`` or ``.``.
    """
    files = (
        spark.readStream.schema(_FILE_COLUMNS)
        .format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "CDC*.csv")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", "36500d")
        .load(names.literal_path(log.increment_dir(root)) + "/*/*")
    )
    return files.select("path", "length")


def _landing_dir(store: StateStore, batch_id: int) -> str:
    return f"{store.out}/landing/batch-{batch_id}"


@dataclass
class Known:
    """What the batches of one query hand on, so that a batch that can't be the last reads no metadata again.

    ``tables`` are read again when a file of another table comes, ``definitions`` when the files of the tables'
    definitions are others (``stamp``). ``awaited`` is a range of one file that an index names, that is there and
    that has not been landed: until it is, nothing can be applied, and a later batch will have it.
    """

    tables: list[Row] = field(default_factory=list)
    stamp: list[tuple] | None = None
    definitions: list[Row] = field(default_factory=list)
    awaited: DataFrame | None = None

    def tables_for(self, spark: SparkSession, root: str, options: rp.Options, seen: set[tuple[str, str]]) -> list[Row]:
        if not seen <= set(rp.by_table(self.tables)):
            self.tables, self.stamp = rp.managed_tables(spark, root, options), None
        return self.tables

    def definitions_for(self, spark: SparkSession, root: str, options: rp.Options, tables: list[Row], scope: list[tuple]) -> list[Row]:
        stamp = reg.definition_files(spark, root, scope)
        if stamp != self.stamp:
            self.definitions, self.stamp = _definitions(spark, root, tables, scope, options), stamp
        return self.definitions

    def waits(self, spark: SparkSession, store: StateStore) -> bool:
        """Whether the awaited file has still not been landed; it is forgotten once it has."""
        if self.awaited is None:
            return False
        landed = manifest.read(spark, store)
        if landed is None or manifest.not_landed(self.awaited, landed).isEmpty():
            self.awaited = None
        return self.awaited is not None

    def wait_for(self, spark: SparkSession, ranges: DataFrame, landed: DataFrame) -> None:
        """Choose the file to wait for: the newest of the last day that lacks its newest file."""
        last = F.greatest("first_file_index", "latest_file_index")
        newest = manifest.not_landed(ranges.withColumn("first_file_index", last), landed)
        day = newest.orderBy(F.desc("date"), F.desc("table_version"), F.desc("latest_file_index")).limit(1)
        found = log.expand_files(day).select("path").first()
        if found is not None and path_exists(spark, found.path):
            self.awaited = local_frame(spark, day.collect(), ranges.schema)


def land_files(
    spark: SparkSession, root: str, store: StateStore, files: DataFrame, batch_id: int, options: rp.Options, known: Known | None = None
) -> None:
    """Land the rows of a micro-batch's files, managed tables only."""
    known = known or Known()
    relative = names.below(names.plain_path(F.col("path")), log.increment_dir(root))
    placed = files.select("path", F.split(relative, "/").alias("p")).select(
        "path", F.col("p")[0].alias("source_schema"), F.col("p")[1].alias("source_table"),
        F.col("p")[2].try_cast("bigint").alias("table_version"),
    )
    # at most maxFilesPerTrigger names
    named = placed.collect()
    tables = known.tables_for(spark, root, options, {(r.source_schema, r.source_table) for r in named})
    managed = rp.by_table(tables)
    found = [r for r in named if (r.source_schema, r.source_table) in managed]
    path = _landing_dir(store, batch_id)
    listed = f"{store.out}/landed_files/batch-{batch_id}"
    touched = sorted({(r.source_schema, r.source_table) for r in found})
    if not touched:
        return
    definitions = known.definitions_for(spark, root, options, [managed[k] for k in touched], touched)
    defined = {(d.source_schema, d.source_table, d.table_version) for d in definitions}
    unknown = {(r.source_schema, r.source_table, r.table_version) for r in found} - defined
    if unknown:
        raise rp.checks.InputError(f"change files without a definition of their version: {sorted(unknown)[:5]}")

    def paths_of(versions: set) -> list[str]:
        return [r.path for r in found if (r.source_schema, r.source_table, r.table_version) in versions]

    rows = rp.with_target(rp.read_landing_rows(spark, root, definitions, paths_of, options), tables)
    rows.write.mode("overwrite").partitionBy("_target").parquet(path)
    counts = spark.read.schema(log.LANDED_SCHEMA).parquet(path).groupBy("path").agg(
        F.max("commit_ts").alias("high_ts"), F.count(F.lit(1)).alias("n_rows")
    )
    all_files = local_frame(spark, 
        [(names.plain_path_of(r.path), managed[(r.source_schema, r.source_table)].target_table) for r in found],
        "path string, target_table string",
    )
    all_files.join(counts, "path", "left").select(
        "path", "target_table", F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.coalesce("high_ts", F.lit(0)).cast("bigint").alias("high_ts"),
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
    ).write.mode("overwrite").parquet(listed)
    # a store without snapshots takes all its listings into the first one
    mine = all_files.select("path") if manifest.snapshots(spark, store) else landed_files(spark, store).select("path")
    manifest.add(spark, store, log.with_place(mine, root, options.date_separator), batch_id)


def _definitions(spark, root, tables, scope, options) -> list[Row]:
    found = reg.registry(spark, root, None, None, options.strict, scope, options.type_keys)
    rows = local_frame(spark, 
        [(t.source_schema, t.source_table, t.columns) for t in tables],
        "source_schema string, source_table string, "
        "columns array<struct<name:string,source_type:string,nullable:boolean,pos:int>>",
    )
    return reg.effective_columns(found, rows).collect()


def landed_files(spark: SparkSession, store: StateStore) -> DataFrame:
    base = f"{store.out}/landed_files"
    if not rp.path_exists(spark, base):
        return local_frame(spark, [], _LANDED_FILES)
    return spark.read.schema(_LANDED_FILES).option("recursiveFileLookup", True).parquet(base)


def open_batches(files: DataFrame, ranges: DataFrame) -> DataFrame:
    """Batches that landed a file of the ranges; the names of these files are not broadcast, as in ``missing_files``."""
    wanted = log.expand_files(ranges).select("path")
    return files.join(wanted.hint("merge"), "path").select("batch_id").distinct()


def apply_landed(
    spark: SparkSession, root: str, store: StateStore, options: rp.Options, batch_id: int | None = None, known: Known | None = None
) -> rp.Result:
    """Apply landed rows up to the checkpoint, if every file that counts has been landed.

    The checkpoint is read before the index files: files that appear in between only add rows
    past it. While a file that ``known`` waits for has not been landed, neither is read.
    """
    current = store.latest_run()
    applied = max((t.batch_id for t in store.table_states(current).values() if t.batch_id is not None), default=None)
    if batch_id is None:
        batch_id = applied
    elif applied is not None and applied >= batch_id:
        return rp.Result(current, None, f"batch {batch_id} was applied before")
    if known is not None and known.waits(spark, store):
        return rp.Result(current, None, "landing is behind the index")
    plan = rp.plan_log(spark, root, store, current, options)
    if isinstance(plan, rp.Result):
        return plan
    landed = manifest.read(spark, store)
    if landed is not None and not manifest.not_landed(plan.ranges, landed).isEmpty():
        if known is not None:
            known.wait_for(spark, plan.ranges, landed)
        return rp.Result(current, plan.upper, "landing is behind the index")
    # file by file, once all are there by their numbers
    files = landed_files(spark, store)
    behind = rp.checks.missing_files(log.expand_files(plan.ranges), files)
    if not behind.isEmpty():
        return rp.Result(current, plan.upper, "landing is behind the index")
    # batches with a file that is not finished; earlier ones are not opened again
    still_open = open_batches(files, plan.ranges).collect()
    if still_open:
        paths = [_landing_dir(store, r.batch_id) for r in sorted(still_open)]
        landed = rp.union_all([spark.read.schema(log.LANDED_SCHEMA).parquet(p) for p in paths])
        landed = rp.in_ranges(landed, plan.ranges)
    else:
        landed = local_frame(spark, [], log.LANDED_SCHEMA)
    return rp.apply_run(spark, store, current, plan, landed, options, batch_id)


def follow(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str,
    *,
    buckets: int = 64,
    max_files: int = 1000,
    available_now: bool = True,
    every: str = "1 minute",
    **settings,
) -> StreamingQuery:
    """Start following the change log at ``root``; the snapshot is loaded first.

    ``available_now`` takes what is there in bounded micro-batches and stops; otherwise a
    micro-batch runs ``every`` so often until the query is stopped, also without new files, as the
    checkpoint of the log may have moved; at the start landed rows are applied once in either case.
    A ``checkpoint`` folder belongs to one of these two modes.
    """
    options = rp.Options(**settings)
    store = StateStore(spark, out, buckets)
    rp.load_snapshot(spark, root, store, options)
    apply_landed(spark, root, store, options)

    known = Known()

    def each(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        own = StateStore(session, out, buckets)
        land_files(session, root, own, files, batch_id, options, known)
        done = apply_landed(session, root, own, options, batch_id, known)
        if options.keep_runs is not None and done.skipped is None:
            sweep(session, out, options.keep_runs, root, landed_files(session, own))

    files = file_stream(spark, root, max_files)
    if not available_now:
        clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load().where("value < 0")
        files = files.unionByName(clock.select(F.lit("").alias("path"), F.col("value").alias("length")))
    writer = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()
