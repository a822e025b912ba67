"""Queries on change windows, order, apply and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import apply as ap
from ..operators import checks, progress
from ..operators.facts import TABLE
from ..sources import changelog as log
from ..sources import registry as reg
from . import sample_views as views
from .sample_views import KEYS, SQL_CAT, SQL_DEFS, SQL_SNAP, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def _window(spark, sf) -> DataFrame:
    b = views.bounds(spark, sf)
    return ap.in_window(views.changes(spark, sf), b.lower, b.upper)


# pieces shared by several statements
SQL_WIN = "win AS (SELECT chg.* FROM chg, b WHERE commit_ts > lower AND commit_ts <= upper)"
SQL_EFF = """eff AS (SELECT source_schema, source_table, max(table_version) AS effective_version FROM defs, b
  WHERE table_version <= lower GROUP BY ALL)"""
SQL_CUT = """cut AS (SELECT source_schema, source_table, max(table_version) AS truncate_version
  FROM defs JOIN eff USING (source_schema, source_table), b
  WHERE (ddl_type IN (11, 23) OR trim(lower(query)) LIKE 'truncate table%')
  AND table_version > effective_version AND table_version <= upper GROUP BY ALL)"""


def sql_state(prev: str, changed: str) -> str:
    """Last row per key of previous rows and changes, deletes dropped."""
    return f"""SELECT source_table, pk, value, props, commit_ts FROM (
      SELECT *, row_number() OVER (PARTITION BY source_schema, source_table, pk ORDER BY table_version DESC,
        partition_id DESC, date DESC, file_index DESC, row_seq DESC) AS rn FROM (
        SELECT 'S' AS op, source_schema, source_table, pk, commit_ts, -1 AS table_version, 0 AS partition_id,
          '' AS date, 0 AS file_index, 0 AS row_seq, value, props FROM {prev}
        UNION ALL SELECT op, source_schema, source_table, pk, commit_ts, table_version, partition_id, date,
          file_index, row_seq, value, props FROM {changed})) WHERE rn = 1 AND op <> 'D'"""


SQL_CURRENT_STATE = sql(sql_state("snap", "win"), SQL_SNAP, SQL_WIN)


@query("current_state", SQL_CURRENT_STATE)
def current_state(spark: SparkSession, sf: str) -> DataFrame:
    state = ap.current_state(views.snapshot(spark, sf), _window(spark, sf), KEYS)
    return state.drop("source_schema")


@query(
    "latest_change_per_key",
    sql(
        """SELECT source_table, pk, op, commit_ts, row_seq, value FROM (SELECT *, row_number() OVER (
          PARTITION BY source_table, pk ORDER BY table_version DESC, date DESC, file_index DESC, row_seq DESC) AS rn
          FROM win) WHERE rn = 1""",
        SQL_WIN,
    ),
)
def latest_change_per_key(spark, sf):
    latest = ap.latest_per_key(_window(spark, sf), KEYS)
    return latest.select("source_table", "pk", "op", "commit_ts", "row_seq", "value")


@query(
    "latest_change_by_stream",
    sql(
        """, parts AS (SELECT *, pk % 3 AS part, commit_ts // 7 AS ts FROM win),
        inside AS (SELECT *, row_number() OVER (PARTITION BY source_table, pk // 3, part
          ORDER BY table_version DESC, date DESC, file_index DESC, row_seq DESC) AS rn FROM parts)
        SELECT source_table, k, part AS partition_id, op, ts AS commit_ts, row_seq FROM (SELECT *, pk // 3 AS k,
          row_number() OVER (PARTITION BY source_table, pk // 3 ORDER BY table_version DESC, ts DESC,
          CASE WHEN op = 'D' THEN 0 ELSE 1 END DESC, part DESC) AS rn2 FROM inside WHERE rn = 1) WHERE rn2 = 1""",
        SQL_WIN,
    ).replace("\n, parts", ",\nparts"),
)
def latest_change_by_stream(spark, sf):
    """Interleaving partitions: coarse commit times, so that partitions tie."""
    rows = _window(spark, sf).withColumns(
        {
            "partition_id": F.col("pk") % 3,
            "k": F.floor(F.col("pk") / 3).cast("bigint"),
            "commit_ts": F.floor(F.col("commit_ts") / 7).cast("bigint"),
        }
    )
    latest = ap.latest_per_key(rows.drop("pk"), [*TABLE, "k"], commit_order="stream")
    return latest.select("source_table", "k", "partition_id", "op", "commit_ts", "row_seq")


@query("change_window", sql("SELECT row_seq, op, source_table, pk, commit_ts FROM win", SQL_WIN))
def change_window(spark, sf):
    return _window(spark, sf).select("row_seq", "op", "source_table", "pk", "commit_ts")


@query(
    "change_total_order",
    sql(
        """SELECT row_seq, source_table, concat_ws('/', lpad(CAST(table_version AS VARCHAR), 20, '0'),
          lpad(CAST(partition_id AS VARCHAR), 20, '0'), date, lpad(CAST(file_index AS VARCHAR), 20, '0'),
          lpad(CAST(row_seq AS VARCHAR), 20, '0')) AS place FROM win""",
        SQL_WIN,
    ),
)
def change_total_order(spark, sf):
    """The order key as sortable text, read back from the struct that max() compares."""
    rows = _window(spark, sf).withColumn("o", ap.order_key())

    def pad(name):
        return F.lpad(F.col(f"o.{name}").cast("string"), 20, "0")

    place = F.concat_ws("/", pad("table_version"), pad("partition_id"), "o.date", pad("file_index"), pad("row_seq"))
    return rows.select("row_seq", "source_table", place.alias("place"))


@query(
    "commit_order_violations",
    sql(
        """SELECT source_table, row_seq, ts AS commit_ts, highest_before FROM (SELECT *, max(ts) OVER (
          PARTITION BY source_table ORDER BY table_version, date, file_index, row_seq
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before FROM (SELECT *,
          commit_ts - CASE WHEN row_seq % 97 = 0 THEN 40 ELSE 0 END AS ts FROM win))
          WHERE ts < highest_before""",
        SQL_WIN,
    ),
)
def commit_order_violations(spark, sf):
    late = F.when(F.col("row_seq") % 97 == 0, 40).otherwise(0)
    rows = _window(spark, sf).withColumn("commit_ts", F.col("commit_ts") - late)
    found = checks.commit_order_violations(rows)
    return found.select("source_table", "row_seq", "commit_ts", "highest_before")


@query(
    "managed_tables_only",
    sql("SELECT row_seq, source_table FROM chg JOIN cat USING (source_schema, source_table)", SQL_CAT),
)
def managed_tables_only(spark, sf):
    rows = ap.managed_only(views.changes(spark, sf), views.catalog(spark, sf))
    return rows.select("row_seq", "source_table")


def _operations(spark, sf):
    return ap.operations(_window(spark, sf), ["pk"], ["pk", "value", "props"])


@query(
    "ops_upserts",
    sql(
        """SELECT 'upsert' AS operation, 'app_' || source_table AS target_table, pk, value, props, row_seq
          FROM win WHERE op <> 'D'""",
        SQL_WIN,
    ),
)
def ops_upserts(spark, sf):
    ops = _operations(spark, sf).where("operation = 'upsert'")
    return ops.select("operation", "target_table", "pk", "value", "props", "row_seq")


@query(
    "ops_deletes",
    sql(
        """SELECT 'delete' AS operation, 'app_' || source_table AS target_table, pk, CAST(NULL AS DOUBLE) AS value,
          row_seq FROM win WHERE op = 'D'""",
        SQL_WIN,
    ),
)
def ops_deletes(spark, sf):
    ops = _operations(spark, sf).where("operation = 'delete'")
    return ops.select("operation", "target_table", "pk", "value", "row_seq")


def _effective(spark, sf):
    return ap.effective_watermarks(
        ap.baseline_versions(views.definitions(spark, sf), views.bounds(spark, sf).lower)
    )


def _cuts(spark, sf):
    upper = views.bounds(spark, sf).upper
    return ap.truncate_points(views.definitions(spark, sf), _effective(spark, sf), upper)


@query(
    "truncate_apply",
    sql(
        sql_state("kept_snap", "kept_win"),
        SQL_SNAP, SQL_WIN, SQL_DEFS, SQL_EFF, SQL_CUT,
        """kept_win AS (SELECT win.* FROM win LEFT JOIN cut USING (source_schema, source_table)
          WHERE truncate_version IS NULL OR table_version >= truncate_version)""",
        "kept_snap AS (SELECT * FROM snap WHERE source_table NOT IN (SELECT source_table FROM cut))",
    ),
)
def truncate_apply(spark, sf):
    cuts = _cuts(spark, sf)
    previous = ap.cut_state(views.snapshot(spark, sf), cuts)
    return ap.current_state(previous, ap.cut_changes(_window(spark, sf), cuts), KEYS).drop("source_schema")


@query(
    "ops_truncates",
    sql(
        """SELECT 'truncate' AS operation, 'app_' || source_table AS target_table, truncate_version AS table_version
          FROM cut""",
        SQL_DEFS, SQL_EFF, SQL_CUT,
    ),
)
def ops_truncates(spark, sf):
    ops = ap.operations(_window(spark, sf), ["pk"], ["pk", "value"], _cuts(spark, sf))
    return ops.where("operation = 'truncate'").select("operation", "target_table", "table_version")


@query(
    "snapshot_then_changes",
    sql(
        f"""SELECT true AS applied, source_table, CAST(count(*) AS BIGINT) AS n_rows,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
          FROM ({sql_state("snap", "win")}) GROUP BY ALL
          UNION ALL SELECT false, source_table, CAST(count(*) AS BIGINT), CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT)
          FROM snap GROUP BY ALL""",
        SQL_SNAP, SQL_WIN,
    ),
)
def snapshot_then_changes(spark, sf):
    """The change log is applied only where every table's snapshot is done: with all of them, and without one."""
    tables = views.changes(spark, sf).select(*TABLE).distinct()
    cents = F.round(F.col("value") * 100).cast("bigint")
    parts = []
    for open_ in ("", "e_view"):
        done = progress.with_defaults(tables, tables.select(
            *TABLE, (F.col("source_table") != open_).alias("snapshot_done"), F.lit(100).alias("snapshot_position"),
            F.lit(0).alias("last_commit_ts"), F.lit(0).alias("ddl_watermark")))
        gate = progress.snapshots_complete(done)
        window = _window(spark, sf).join(F.broadcast(gate.where("complete")), how="left_semi")
        state = ap.current_state(views.snapshot(spark, sf), window, KEYS)
        counted = state.groupBy("source_table").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(cents).alias("cents"))
        parts.append(counted.join(F.broadcast(gate.withColumnRenamed("complete", "applied"))))
    return parts[0].unionByName(parts[1])


@query(
    "operation_stats",
    sql(
        """SELECT 'app_' || source_table AS target_table, CASE op WHEN 'D' THEN 'delete' ELSE 'upsert' END AS operation,
          CAST(count(*) AS BIGINT) AS n_operations FROM win GROUP BY ALL""",
        SQL_WIN,
    ),
)
def operation_stats(spark, sf):
    return ap.operation_stats(_operations(spark, sf))


@query(
    "skipped_counts",
    sql(
        """SELECT source_schema, source_table, date, file_index, CAST(sum(CAST(commit_ts <= lower AS INT)) AS BIGINT) AS rows_skipped,
          CAST(sum(CAST(commit_ts > lower AND commit_ts <= upper AS INT)) AS BIGINT) AS rows_emitted,
          CAST(sum(CAST(commit_ts > upper AS INT)) AS BIGINT) AS rows_waiting FROM chg, b GROUP BY ALL"""
    ),
)
def skipped_counts(spark, sf):
    b = views.bounds(spark, sf)
    return ap.window_counts(views.changes(spark, sf), b.lower, b.upper, (*TABLE, "date", "file_index"))


# --- versions and watermarks ----------------------------------------------------------------


@query(
    "baseline_versions",
    sql(
        """SELECT source_schema, source_table, max(table_version) AS baseline_version FROM defs, b
          WHERE table_version <= n * 6 // 10 GROUP BY ALL""",
        SQL_DEFS,
    ),
)
def baseline_versions(spark, sf):
    return ap.baseline_versions(views.definitions(spark, sf), views.bounds(spark, sf).n * 6 // 10)


@query(
    "visible_versions",
    sql(
        """SELECT source_table, table_version, ddl_type FROM defs, b WHERE table_version <= n * 6 // 10""",
        SQL_DEFS,
    ),
)
def visible_versions(spark, sf):
    rows = log.visible_versions(views.definitions(spark, sf), views.bounds(spark, sf).n * 6 // 10)
    return rows.select("source_table", "table_version", "ddl_type")


@query(
    "late_version_skip",
    sql(
        """SELECT chg.row_seq, chg.source_table, chg.table_version FROM chg LEFT JOIN (VALUES ('e_view', 2),
          ('e_click', 1)) w(source_table, steps) USING (source_table), b
          WHERE table_version >= greatest(coalesce(w.steps, 0) * step, CASE WHEN n * 6 // 10 >= 2 * step
            THEN 2 * step ELSE step END)""",
    ),
)
def late_version_skip(spark, sf):
    b = views.bounds(spark, sf)
    defs = views.definitions(spark, sf)
    saved = defs.where("source_table IN ('e_view', 'e_click')").select(
        *TABLE, F.when(F.col("source_table") == "e_view", 2 * b.step).otherwise(b.step).alias("ddl_watermark")
    )
    effective = ap.effective_watermarks(ap.baseline_versions(defs, b.n * 6 // 10), saved)
    kept = ap.skip_late_versions(views.changes(spark, sf), effective)
    return kept.select("row_seq", "source_table", "table_version")


@query(
    "effective_columns",
    sql(
        """SELECT source_table, table_version, CASE WHEN table_version = 2 * step THEN 'pk BIGINT,value DOUBLE,extra DATE'
          ELSE 'pk BIGINT,' || source_table || ' TEXT' END AS column_list FROM defs, b""",
        SQL_DEFS,
    ),
)
def effective_columns(spark, sf):
    b = views.bounds(spark, sf)

    def columns(*pairs):
        return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("source_type")) for n, t in pairs])

    none = F.array().cast("array<struct<name:string,source_type:string>>")
    defs = views.definitions(spark, sf).withColumn(
        "columns",
        F.when(F.col("table_version") == 2 * b.step, columns(("pk", "BIGINT"), ("value", "DOUBLE"), ("extra", "DATE"))).otherwise(none),
    )
    tables = views.changes(spark, sf).select(*TABLE).distinct().withColumn(
        "columns",
        F.array(F.struct(F.lit("pk").alias("name"), F.lit("BIGINT").alias("source_type")),
                F.struct(F.col("source_table").alias("name"), F.lit("TEXT").alias("source_type"))),
    )
    found = reg.effective_columns(defs, tables)
    listed = F.array_join(F.transform("columns", lambda c: F.concat_ws(" ", c["name"], c["source_type"])), ",")
    return found.select("source_table", "table_version", listed.alias("column_list"))


@query(
    "file_statistics",
    sql(
        """SELECT source_table, table_version, date, file_index, max(commit_ts) AS high_ts, CAST(count(*) AS BIGINT) AS n_rows,
          CAST(count(*) FILTER (commit_ts > lower AND commit_ts <= upper AND op <> 'D') AS BIGINT) AS n_upserts,
          CAST(count(*) FILTER (commit_ts > lower AND commit_ts <= upper AND op = 'D') AS BIGINT) AS n_deletes,
          CAST(count(*) FILTER (commit_ts > upper) AS BIGINT) AS n_waiting FROM chg, b GROUP BY ALL"""
    ),
)
def file_statistics(spark, sf):
    b = views.bounds(spark, sf)
    found = progress.file_summary(views.changes(spark, sf), b.lower, b.upper)
    return found.drop("source_schema", "partition_id", "applied_ts")


# --- progress -------------------------------------------------------------------------------


def _ranges(spark, sf, until: int | None = None):
    rows = views.changes(spark, sf)
    if until is not None:
        rows = rows.where(F.col("row_seq") < until)
    return rows.groupBy(*ap.STREAM, "date").agg(F.max("file_index").alias("latest_file_index"))


def _streams(spark, sf, upper, previous=None, until=None):
    rows = views.changes(spark, sf)
    if until is not None:
        rows = rows.where(F.col("row_seq") < until)
    b = views.bounds(spark, sf)
    return progress.stream_progress(
        progress.file_summary(rows, b.lower, upper), _ranges(spark, sf, until), upper, previous
    )


SQL_PROGRESS = """files AS (SELECT source_schema, source_table, table_version, partition_id, date, file_index,
    max(commit_ts) AS high_ts FROM chg GROUP BY ALL),
  stops AS (SELECT source_schema, source_table, table_version, partition_id,
    min(date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0')) AS stop FROM files, b WHERE high_ts > upper GROUP BY ALL),
  done AS (SELECT source_schema, source_table, table_version, partition_id, max(date) AS last_date,
    arg_max(file_index, date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0')) AS last_file_index
    FROM files LEFT JOIN stops USING (source_schema, source_table, table_version, partition_id)
    WHERE stop IS NULL OR date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0') < stop GROUP BY ALL),
  seen AS (SELECT source_schema, source_table, table_version, partition_id, max(date) AS latest_date,
    arg_max(file_index, date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0')) AS latest_index_file_index
    FROM files GROUP BY ALL),
  applied AS (SELECT source_schema, source_table, table_version, partition_id, max(commit_ts) AS last_commit_ts
    FROM chg, b WHERE commit_ts > lower AND commit_ts <= upper GROUP BY ALL),
  streams AS (SELECT source_schema, source_table, table_version, partition_id, coalesce(last_date, '') AS last_date,
    coalesce(last_file_index, 0) AS last_file_index, latest_date, latest_index_file_index,
    coalesce(last_commit_ts, 0) AS last_commit_ts FROM seen LEFT JOIN done USING (source_schema, source_table, table_version, partition_id)
    LEFT JOIN applied USING (source_schema, source_table, table_version, partition_id))"""


@query("stream_progress", sql("SELECT * FROM streams", SQL_PROGRESS))
def stream_progress(spark, sf):
    """Two runs: half of the log first, then the rest merged into that progress."""
    b = views.bounds(spark, sf)
    first = _streams(spark, sf, b.n // 3, until=b.n // 2)
    return _streams(spark, sf, b.upper, previous=first)


@query(
    "incremental_file_pruning",
    sql(
        """, early AS (SELECT source_table, table_version, max(date) AS last_date,
            arg_max(file_index, date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0')) AS last_file_index
            FROM chg, b WHERE row_seq < n // 2 GROUP BY ALL),
          r AS (SELECT source_table, table_version, date, max(file_index) AS latest_file_index FROM chg GROUP BY ALL)
        SELECT r.source_table, r.table_version, r.date, latest_file_index,
          CASE WHEN r.date = last_date THEN last_file_index + 1 ELSE 1 END AS first_file_index
        FROM r LEFT JOIN early USING (source_table, table_version)
        WHERE (last_date IS NULL OR r.date >= last_date)
          AND CASE WHEN r.date = last_date THEN last_file_index + 1 ELSE 1 END <= latest_file_index"""
    ).replace("\n, early", ",\nearly"),
)
def incremental_file_pruning(spark, sf):
    b = views.bounds(spark, sf)
    early = _streams(spark, sf, b.n, until=b.n // 2)
    found = log.new_ranges(_ranges(spark, sf), early)
    return found.select("source_table", "table_version", "date", "latest_file_index", "first_file_index")


@query(
    "commit_ts_by_table",
    sql("SELECT source_schema, source_table, max(commit_ts) AS last_commit_ts FROM win GROUP BY ALL", SQL_WIN),
)
def commit_ts_by_table(spark, sf):
    b = views.bounds(spark, sf)
    first = progress.commit_ts_by_table(ap.in_window(views.changes(spark, sf), b.lower, b.n // 2))
    return progress.commit_ts_by_table(_window(spark, sf).where(F.col("commit_ts") > b.n // 2), first)


@query(
    "ddl_watermarks",
    sql(
        """SELECT source_schema, source_table, max(table_version) AS ddl_watermark FROM defs
          JOIN eff USING (source_schema, source_table), b
          WHERE table_version <= upper AND table_version > effective_version GROUP BY ALL""",
        SQL_DEFS, SQL_EFF,
    ),
)
def ddl_watermarks(spark, sf):
    b = views.bounds(spark, sf)
    defs = views.definitions(spark, sf)
    first = progress.ddl_watermarks(defs, b.n // 2, _effective(spark, sf))
    return progress.ddl_watermarks(defs, b.upper, _effective(spark, sf), first)


@query(
    "progress_compaction",
    sql(
        """SELECT streams.* FROM streams JOIN cat USING (source_schema, source_table), b
          WHERE table_version >= 2 * step OR last_date <> latest_date OR last_file_index < latest_index_file_index""",
        SQL_PROGRESS, SQL_CAT,
    ),
)
def progress_compaction(spark, sf):
    b = views.bounds(spark, sf)
    marks = views.catalog(spark, sf).withColumn("ddl_watermark", F.lit(2 * b.step))
    return progress.compact(_streams(spark, sf, b.upper), views.catalog(spark, sf), marks)


@query(
    "progress_defaults",
    sql(
        """, saved AS (SELECT source_schema, source_table, max(commit_ts) AS ts FROM win
          WHERE source_table <> 'e_view' GROUP BY ALL)
        SELECT source_schema, source_table, ts IS NOT NULL AS snapshot_done,
          CASE WHEN ts IS NULL THEN 0 ELSE 100 END::BIGINT AS snapshot_position, coalesce(ts, 0) AS last_commit_ts,
          0::BIGINT AS ddl_watermark FROM cat LEFT JOIN saved USING (source_schema, source_table)""",
        SQL_CAT, SQL_WIN,
    ).replace("\n, saved", ",\nsaved"),
)
def progress_defaults(spark, sf):
    saved = progress.commit_ts_by_table(_window(spark, sf).where("source_table <> 'e_view'")).select(
        "*", F.lit(True).alias("snapshot_done"), F.lit(100).alias("snapshot_position"), F.lit(None).alias("ddl_watermark")
    )
    return progress.with_defaults(views.catalog(spark, sf), saved)


@query(
    "pending_work",
    sql(
        """SELECT coalesce(bool_or(last_date < latest_date OR (last_date = latest_date AND
          last_file_index < latest_index_file_index)), false) AS pending FROM streams""",
        SQL_PROGRESS,
    ),
)
def pending_work(spark, sf):
    return progress.pending_work(_streams(spark, sf, views.bounds(spark, sf).upper))
