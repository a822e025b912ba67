"""Queries that read a workspace written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import progress
from ..sources import catalog as cat
from ..sources import changelog as log
from ..sources import files as fs
from ..sources import frontier
from ..sources import registry as reg
from ..sources import snapshot as snap
from ..workdir import work_dir
from . import sample_views as views
from . import sample_workspace as ws
from .queries_apply import SQL_CURRENT_STATE, SQL_EFF, SQL_WIN
from .replay import Options, StateStore, load_snapshot, read_changes, read_operations, read_snapshot, replay, union_all
from .sample_views import SQL_CRC, SQL_DEFS, sql, sql_crc

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


SQL_PATHS = """paths AS (SELECT DISTINCT source_table, table_version, date, file_index,
  'increment/app/' || source_table || '/' || table_version || '/' || date AS dir FROM chg)"""


def _managed(spark):
    return [("app", t) for t in views.TABLES if t != "e_error"]


# --- inventory ------------------------------------------------------------------------------


@query(
    "file_inventory",
    sql("SELECT dir || '/CDC' || lpad(CAST(file_index AS VARCHAR), 6, '0') || '.csv' AS path FROM paths", SQL_PATHS),
)
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Change files with rows, from the listing of the whole workspace."""
    root = ws.write_workspace(spark, sf)
    files = fs.list_files(spark, root)
    wanted = names.file_name(F.col("path")).rlike(names.DATA_FILE) & (F.col("length") > 1)
    return files.where(wanted).select(names.below(F.col("path"), root).alias("path"))


@query(
    "inventory_prefixes",
    sql("SELECT DISTINCT source_table, table_version || '/' AS prefix FROM chg UNION SELECT DISTINCT source_table, 'meta/' FROM chg"),
)
def inventory_prefixes(spark, sf):
    root = ws.write_workspace(spark, sf) + "/increment/app"
    return union_all([
        fs.child_prefixes(fs.list_files(spark, f"{root}/{t}"), f"{root}/{t}").withColumn("source_table", F.lit(t)) for t in views.TABLES
    ])


@query(
    "csv_roundtrip_events",
    sql("SELECT source_table, table_version, commit_ts, op, CAST(value AS VARCHAR) AS value_text, props FROM chg"),
)
def csv_roundtrip_events(spark, sf):
    root, step = ws.write_workspace(spark, sf), views.bounds(spark, sf).step
    base = f"{root}/increment/app"
    parts = []
    for wide in (False, True):
        n = 4 if wide else 3
        versions = [v for v in range(0, views.bounds(spark, sf).n, step) if (v == 2 * step) == wide]
        dirs = [f"{base}/{t}/{v}" for t in views.TABLES for v in versions]
        raw = fs.read_csv_rows(spark, dirs, [*log.META, *log.value_fields(n)], glob="CDC*.csv", recursive=True)
        rows = log.with_place(log.split_rows(raw, n), root)
        parts.append(
            rows.select("source_table", "table_version", F.col("ts_text").cast("bigint").alias("commit_ts"),
                        "op", F.col("v1").alias("value_text"), F.col("v2").alias("props"))
        )
    return parts[0].unionByName(parts[1])


@query(
    "csv_roundtrip_documents",
    "SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n, source FROM documents",
)
def csv_roundtrip_documents(spark, sf):
    """Long texts with line breaks and quotes come back unchanged."""
    root = ws.write_documents(spark, sf)
    rows = log.read_fields(spark, root, [f"{root}/increment/app/documents/1"], 3).where("rule IS NULL")
    return rows.select(
        F.col("v0").cast("bigint").alias("doc_id"), F.md5(F.encode("v1", "UTF-8")).alias("text_md5"),
        F.length("v1").cast("bigint").alias("n"), F.col("v2").alias("source"),
    )


@query(
    "row_position_order",
    sql(
        """SELECT source_table, table_version, date, file_index, CAST(count(*) AS BIGINT) AS n_rows, min(commit_ts) AS first_ts,
          max(commit_ts) AS last_ts FROM chg GROUP BY ALL"""
    ),
)
def row_position_order(spark, sf):
    """First and last row of every file by position; written in commit order."""
    root = ws.write_workspace(spark, sf)
    dirs = [f"{root}/increment/app/{t}" for t in views.TABLES]
    raw = fs.read_csv_rows(spark, dirs, ["op", "t", "s", "ts", "v0", "v1", "v2"], glob="CDC*.csv", recursive=True)
    # rows of the wider version do not fit here; their commit time is taken from the record
    record = F.split(F.col(fs.BAD_RECORD), ",")
    ts = F.coalesce(F.col("ts"), F.get(record, F.lit(3))).try_cast("bigint")
    rows = log.with_place(raw, root).withColumn("ts", ts).where("ts IS NOT NULL")
    place = F.struct("block_start", "row_seq")
    return rows.groupBy("source_table", "table_version", "date", "file_index").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min_by("ts", place).alias("first_ts"), F.max_by("ts", place).alias("last_ts")
    )


# --- catalog --------------------------------------------------------------------------------

SQL_TABLES = "(SELECT DISTINCT 'e_' || event_type AS t FROM events)"
# tables and columns of the dump that is made from part
SQL_DUMP = """sizes AS (SELECT DISTINCT lower(replace(p_brand, '#', '_')) AS t, p_size AS size FROM part),
  brands AS (SELECT DISTINCT t, CAST(split_part(t, '_', 2) AS INTEGER) % 3 <> 0 AS keyed FROM sizes),
  cols AS (SELECT t, 's' || size AS name, CAST(1 + row_number() OVER (PARTITION BY t ORDER BY size) AS INTEGER) AS pos, size % 5 <> 0 AS nullable,
    CASE size % 4 WHEN 0 THEN 'INT UNSIGNED' WHEN 1 THEN 'DECIMAL(38,' || size % 10 || ')' WHEN 2 THEN 'DATETIME(3)' ELSE 'VARCHAR(' || size || ')' END AS source_type,
    CASE size % 4 WHEN 0 THEN 'INT' WHEN 1 THEN 'DECIMAL' WHEN 2 THEN 'NAIVE_DATETIME' ELSE 'STRING' END AS logical_type,
    CASE size % 4 WHEN 0 THEN 'bigint' WHEN 1 THEN 'decimal(38,' || size % 10 || ')' WHEN 2 THEN 'timestamp_ntz' ELSE 'string' END AS spark_type
    FROM sizes UNION ALL SELECT t, 'k', 1, false, 'BIGINT', 'LONG', 'bigint' FROM brands)"""


@query(
    "catalog_discover",
    f"""WITH {SQL_DUMP} SELECT 'app' AS source_schema, t AS source_table, 'app_' || t AS target_table, 'k' AS primary_key, 'app.' || t AS file_stem
      FROM brands WHERE keyed AND t NOT LIKE '%_1'""",
)
def catalog_discover(spark, sf):
    tables = cat.catalog(spark, ws.write_dump(spark, sf), ["app.*", "!*1"])
    return tables.select("source_schema", "source_table", "target_table", F.array_join("primary_key", ",").alias("primary_key"), "file_stem")


@query(
    "catalog_columns",
    f"WITH {SQL_DUMP} SELECT t AS source_table, pos, name, source_type, nullable FROM cols JOIN brands USING (t) WHERE keyed",
)
def catalog_columns(spark, sf):
    tables = cat.catalog(spark, ws.write_dump(spark, sf))
    return tables.select("source_table", F.explode("columns").alias("c")).select(
        "source_table", "c.pos", "c.name", "c.source_type", "c.nullable"
    )


@query("catalog_no_pk", f"WITH {SQL_DUMP} SELECT 'app' AS source_schema, t AS source_table FROM brands WHERE NOT keyed")
def catalog_no_pk(spark, sf):
    found = cat.discover(spark, ws.write_dump(spark, sf))
    return cat.without_key(found).select("source_schema", "source_table")


def _part_ddl(spark, sf):
    """A DDL text per part, some of them broken."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("t_"), key.cast("string"))
    made = F.when(key % 10 == 1, "other").otherwise(name)
    column = F.when(key % 10 == 2, "").otherwise(
        F.concat(F.lit("  `id` decimal(12,2) unsigned NOT NULL,\n  `a``b` enum('x,(','it''s') COMMENT 'NOT NULL'"),
                 F.when(key % 10 == 4, " PRIMARY KEY,\n").otherwise(",\n"))
    )
    keys = F.when(key % 10 == 3, "  PRIMARY KEY (`id`,`gone`)\n").when(key % 10 == 4, "  KEY `k` (`id`)\n").otherwise(
        "  PRIMARY KEY (`id`,`a``b`(10))\n"
    )
    text = F.when(key % 10 == 5, "SELECT 1;").otherwise(
        F.concat(F.lit("/* x */;\nCREATE TABLE IF NOT EXISTS `"), made, F.lit("` (\n"), column, keys, F.lit(") ENGINE=x;"))
    )
    stem = F.when(key % 10 == 6, F.concat(F.lit("t_"), F.floor(key / 100).cast("string"))).otherwise(name)
    text = F.when(key % 10 == 6, F.concat(F.lit("CREATE TABLE `t_"), F.floor(key / 100).cast("string"), F.lit("` (\n `id` int,\n PRIMARY KEY (`id`));"))).otherwise(text)
    rows = views.table(spark, sf, "part").select(
        F.when(key % 10 == 6, "twice").otherwise("app").alias("source_schema"), stem.alias("source_table"),
        name.alias("path"), text.alias("text"), "p_partkey",
    )
    return cat.parse_ddl(rows)


@query(
    "catalog_ddl_texts",
    """SELECT p_partkey, CASE p_partkey % 10 WHEN 3 THEN 'id,gone' WHEN 4 THEN 'a`b' WHEN 5 THEN '' WHEN 6 THEN 'id' ELSE 'id,a`b' END AS primary_key,
      CASE p_partkey % 10 WHEN 2 THEN '' WHEN 5 THEN '' WHEN 6 THEN 'id INT true'
        ELSE 'id DECIMAL(12,2) UNSIGNED false;a`b ENUM(''x,('',''it''''s'') true' END AS column_list FROM part""",
)
def catalog_ddl_texts(spark, sf):
    listed = F.transform("columns", lambda c: F.concat_ws(" ", c["name"], c["source_type"], c["nullable"].cast("string")))
    return _part_ddl(spark, sf).select(
        "p_partkey", F.array_join("primary_key", ",").alias("primary_key"), F.array_join(listed, ";").alias("column_list")
    )


@query(
    "catalog_violations",
    """SELECT 'app' AS source_schema, 't_' || p_partkey AS source_table, r.rule FROM part JOIN (VALUES (1, 'name_mismatch'), (2, 'no_columns'),
        (2, 'key_not_in_columns'), (3, 'key_not_in_columns'), (5, 'no_create_table'), (5, 'no_columns')) r(m, rule) ON p_partkey % 10 = r.m
      UNION ALL SELECT 'twice', 't_' || (p_partkey // 100), 'duplicate' FROM part WHERE p_partkey % 10 = 6 GROUP BY ALL HAVING count(*) > 1""",
)
def catalog_violations(spark, sf):
    return cat.catalog_violations(_part_ddl(spark, sf)).select("source_schema", "source_table", "rule")


@query(
    "declared_schema",
    f"""WITH {SQL_DUMP} SELECT 'app_' || t AS target_table, c.* FROM brands JOIN (
        SELECT t, name AS column_name, logical_type, spark_type, name = 'k' AS is_key FROM cols UNION ALL
        SELECT t, c.* FROM brands, (VALUES ('_cdc_commit_ts', 'LONG', 'bigint', false), ('_cdc_source_schema', 'STRING', 'string', false),
          ('_cdc_source_table', 'STRING', 'string', false)) c(column_name, logical_type, spark_type, is_key)) c USING (t) WHERE keyed""".replace("c.* FROM brands JOIN", "column_name, logical_type, spark_type, is_key FROM brands JOIN"),
)
def declared_schema(spark, sf):
    tables = cat.catalog(spark, ws.write_dump(spark, sf))
    return cat.declared_schema(tables, "_cdc_").select("target_table", "column_name", "logical_type", "spark_type", "is_key")


# --- snapshot -------------------------------------------------------------------------------


def _table(spark, root, name):
    return cat.catalog(spark, root, [f"app.{name}"]).first()


@query(
    "snapshot_files",
    """SELECT DISTINCT 'snapshot/app.e_view.' || (k + CASE WHEN k < 2 THEN 1 ELSE 8 END) || '.csv' AS path
      FROM (SELECT c_custkey % (4 + n // 500000) AS k FROM customer, (SELECT max(event_id) + 1 AS n FROM events))""",
)
def snapshot_files(spark, sf):
    root = ws.write_workspace(spark, sf)
    return snap.snapshot_files(spark, root, "app.e_view").select(names.below(F.col("path"), root).alias("path"))


@query("snapshot_header_by_name", "SELECT c_custkey AS pk, CAST(c_acctbal AS VARCHAR) AS value, '\\N' AS props FROM customer")
def snapshot_header_by_name(spark, sf):
    """Chunks with their columns in different orders, mapped by each file's header."""
    root, columns = ws.write_workspace(spark, sf), ["pk", "value", "props"]
    fields = snap.read_fields(spark, root, "app.e_view", 3)
    rows = snap.named_fields(fields, snap.file_headers(fields, columns), columns)
    return rows.select(F.col("c0").cast("bigint").alias("pk"), F.col("c1").alias("value"), F.col("c2").alias("props"))


@query("snapshot_rows", "SELECT c_custkey AS pk, c_acctbal AS value, CAST(NULL AS VARCHAR) AS props FROM customer")
def snapshot_rows(spark, sf):
    """The table without headers."""
    root = ws.write_workspace(spark, sf)
    return read_snapshot(spark, root, _table(spark, root, ws.NO_HEADER_TABLE))


@query(
    "snapshot_diagnostics",
    """SELECT c_custkey AS pk, c_acctbal AS value, CAST(0 AS BIGINT) AS _cdc_commit_ts, 'app' AS _cdc_source_schema,
      'e_click' AS _cdc_source_table FROM customer""",
)
def snapshot_diagnostics(spark, sf):
    root = ws.write_workspace(spark, sf)
    return read_snapshot(spark, root, _table(spark, root, "e_click"), Options(diagnostics="_cdc_")).drop("props")


@query(
    "snapshot_width_violations",
    "SELECT CAST(c_custkey AS VARCHAR) || ',' || CAST(c_acctbal AS VARCHAR) || ',\\N' AS record FROM customer",
)
def snapshot_width_violations(spark, sf):
    """Three-column files read as a two-column table: every row is a violation."""
    root = ws.write_workspace(spark, sf)
    fields = snap.read_fields(spark, root, f"app.{ws.NO_HEADER_TABLE}", 2)
    return snap.width_violations(fields).select("record")


@query(
    "snapshot_load",
    """SELECT 'app_' || t.t AS target_table, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents,
      true AS snapshot_done, any_value(n // 10) AS snapshot_position FROM customer, """ + SQL_TABLES + """ t,
      (SELECT max(event_id) + 1 AS n FROM events) GROUP BY ALL""",
)
def snapshot_load(spark, sf):
    root = ws.write_workspace(spark, sf)
    store = StateStore(spark, work_dir(spark, "state"), 4)
    run = load_snapshot(spark, root, store, Options())
    states = [store.read(f"app_{t}", run).withColumn("target_table", F.lit(f"app_{t}")) for t in views.TABLES]
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    done = store.tables(run).select("target_table", "snapshot_done", "snapshot_position")
    return rows.groupBy("target_table").agg(F.count(F.lit(1)).alias("n_rows"), cents).join(done, "target_table")


@query(
    "snapshot_guard",
    "SELECT DISTINCT 'e_' || event_type AS source_table, n // 10 + 5 AS snapshot_position FROM events, (SELECT max(event_id) + 1 AS n FROM events) WHERE event_type < 'm'",
)
def snapshot_guard(spark, sf):
    """Tables that were loaded from another dump than the one that is there now."""
    root = ws.write_workspace(spark, sf)
    position = cat.snapshot_position(spark, root)
    moved = F.when(F.col("source_table") < "e_m", F.lit(position + 5)).otherwise(F.lit(position))
    saved = cat.catalog(spark, root).withColumn("snapshot_position", moved)
    return progress.changed_snapshot_position(saved, position).select("source_table", "snapshot_position")


# --- change log -----------------------------------------------------------------------------


@query(
    "scan_scope",
    sql("SELECT DISTINCT source_table, table_version, date FROM chg, b WHERE source_table <> 'e_error' AND table_version <= upper"),
)
def scan_scope(spark, sf):
    """Index files below the managed tables only; the other table's folders are not listed."""
    root, b = ws.write_workspace(spark, sf), views.bounds(spark, sf)
    found = reg.registry(spark, root, None, b.upper, scope=_managed(spark))
    versions = [tuple(r) for r in found.select("source_schema", "source_table", "table_version").toLocalIterator()]
    return log.file_ranges(log.read_indexes(spark, root, versions)).select("source_table", "table_version", "date")


@query(
    "index_ranges",
    sql("""SELECT source_table, table_version, partition_id, date, max(file_index) AS latest_file_index FROM chg, b
      WHERE table_version <= upper GROUP BY ALL"""),
)
def index_ranges(spark, sf):
    root, b = ws.write_workspace(spark, sf), views.bounds(spark, sf)
    versions = [("app", t, v) for t in views.TABLES for v in range(0, b.upper + 1, b.step)]
    ranges = log.file_ranges(log.read_indexes(spark, root, versions))
    return ranges.select("source_table", "table_version", "partition_id", "date", "latest_file_index")


@query(
    "change_events",
    sql("""SELECT op, source_table, commit_ts, table_version, date, file_index, pk, value, props,
      CASE WHEN table_version = 2 * step THEN date END AS seen FROM win, b""", SQL_WIN),
)
def change_events(spark, sf):
    """Typed rows of all tables and versions inside the window; one version has a column more."""
    root, b = ws.write_workspace(spark, sf), views.bounds(spark, sf)
    rows = read_changes(spark, root, cat.catalog(spark, root).collect(), b.lower, b.upper)
    seen = F.date_format("data.seen", "yyyy-MM-dd").alias("seen")
    return rows.select("op", "source_table", "commit_ts", "table_version", "date", "file_index",
                       "data.pk", "data.value", "data.props", seen)


@query(
    "change_diagnostics",
    sql("""SELECT pk, commit_ts AS _cdc_commit_ts, 'app' AS _cdc_source_schema, source_table AS _cdc_source_table
      FROM win""", SQL_WIN),
)
def change_diagnostics(spark, sf):
    root, b = ws.write_workspace(spark, sf), views.bounds(spark, sf)
    rows = read_changes(spark, root, cat.catalog(spark, root).collect(), b.lower, b.upper, Options(diagnostics="_cdc_"))
    return rows.select("data.*").select("pk", "_cdc_commit_ts", "_cdc_source_schema", "_cdc_source_table")


def _messy(spark, sf) -> DataFrame:
    root = ws.write_messy_workspace(spark, sf)
    b = views.bounds(spark, sf)
    dirs = [f"{root}/increment/app/{t}/{v}/7" for t in views.TABLES for v in range(0, b.n, b.step)]
    return log.read_fields(spark, root, fs.existing(spark, dirs), 3)


# A row with the fifth meta field and one field short has the plain width, with its fields
# shifted by one; what it breaks then is its first value, so it is no violation of the width.
D = ws.DEFECTS
SQL_RULE = f"""CASE WHEN row_seq % {D['width']} = 0 AND row_seq % {D['flag']} > 0 THEN 'width'
  WHEN row_seq % {D['operation']} = 0 THEN 'operation' WHEN row_seq % {D['identity']} = 0 THEN 'identity'
  WHEN row_seq % {D['commit_ts']} = 0 THEN 'commit_ts' END"""


def _rule_query(rule: str, name: str):
    @query(
        f"change_{name}_violations",
        sql(f"SELECT source_table, table_version, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT *, {SQL_RULE} AS rule FROM chg) WHERE rule = '{rule}' GROUP BY ALL"),
    )
    def run(spark, sf):
        found = log.structural_violations(_messy(spark, sf)).where(F.col("rule") == rule)
        return found.groupBy("source_table", "table_version").agg(F.count(F.lit(1)).alias("n_rows"))

    return run


for _rule, _name in (("width", "width"), ("operation", "op"), ("identity", "identity"), ("commit_ts", "commit_ts")):
    _rule_query(_rule, _name)


@query(
    "change_header_skip",
    sql("SELECT source_table, partition_id, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT source_table, CAST(7 AS BIGINT) AS partition_id FROM chg) GROUP BY ALL"),
)
def change_header_skip(spark, sf):
    """As many rows as were written: headers and blank lines are gone, broken rows are still there."""
    return _messy(spark, sf).groupBy("source_table", "partition_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "change_typed_rows",
    sql(f"""SELECT op, commit_ts, pk, value, props || chr(10) || 'next "line"' AS props FROM (SELECT *, {SQL_RULE} AS rule FROM chg)
      WHERE rule IS NULL AND row_seq % {D['value']} > 0 AND row_seq % {D['width']} > 0"""),
)
def change_typed_rows(spark, sf):
    """Good rows of files that also hold broken ones, with and without the fifth meta field."""
    rows = log.typed_rows(_messy(spark, sf), ws.SNAPSHOT_COLUMNS, on_error="quarantine")
    return rows.select("op", "commit_ts", "data.*")


@query(
    "change_value_violations",
    sql(f"""SELECT source_table, 'pk' AS column_name, CASE WHEN row_seq % {D['width']} = 0 THEN 'true' ELSE 'n/a' END AS raw_value
      FROM (SELECT *, {SQL_RULE} AS rule FROM chg) WHERE rule IS NULL
      AND (row_seq % {D['value']} = 0 OR (row_seq % {D['width']} = 0 AND row_seq % {D['flag']} = 0))
      UNION ALL SELECT source_table, 'value', 'n/a' FROM (SELECT *, {SQL_RULE} AS rule FROM chg) WHERE rule IS NULL AND row_seq % {D['width']} = 0 AND row_seq % {D['value']} = 0"""),
)
def change_value_violations(spark, sf):
    return log.value_violations(_messy(spark, sf), ws.SNAPSHOT_COLUMNS).select("source_table", "column_name", "raw_value")


def _sql_column(name: str, kind: str) -> str:
    return f"""
  {{
   "ColumnName": "{name}",
   "ColumnType": "{kind}"
  }}"""


def _sql_definition() -> str:
    """Canonical text of a definition file of the workspace; columns in the order of their names."""
    plain = sorted(ws.SNAPSHOT_COLUMNS)
    wide = sorted([*ws.SNAPSHOT_COLUMNS, ws.ADDED_COLUMN])
    listed = [",".join(_sql_column(*c) for c in columns) + "\n " for columns in (plain, wide)]
    return f"""'{{
 "Table": "' || source_table || '",
 "Schema": "app",
 "Version": 0,
 "TableColumns": [' || CASE table_version // step WHEN 3 THEN '' WHEN 2 THEN '{listed[1]}' ELSE '{listed[0]}' END || '],
 "TableColumnsTotal": ' || CASE table_version // step WHEN 3 THEN '0' WHEN 2 THEN '4' ELSE '3' END || '
}}'"""


@query(
    "workspace_checksums",
    sql(
        f"""SELECT source_table, table_version, {sql_crc("text")} AS checksum, {sql_crc("text")} AS computed_checksum FROM crc_table,
          (SELECT DISTINCT source_table, table_version, {_sql_definition()} AS text FROM chg, b)""",
        SQL_CRC,
    ),
)
def workspace_checksums(spark, sf):
    """Checksums of the definition files, from their names and from their contents."""
    root = ws.write_workspace(spark, sf)
    found = reg.read_definitions(spark, root, scope=[("app", t) for t in views.TABLES])
    return found.select("source_table", "table_version", "checksum", "computed_checksum")


@query(
    "unknown_files",
    """SELECT DISTINCT 'increment/app/' || p_brand || '/meta/schema_' || p_size || CASE p_size % 3 WHEN 0 THEN '.json' ELSE '_x.json' END
      AS path FROM part WHERE p_size % 3 < 2 AND p_brand <> 'Brand#13'""",
)
def unknown_files(spark, sf):
    """Files beside the definitions that are none, of all tables but one."""
    root = ws.write_strays(spark, sf)
    brands = views.table(spark, sf, "part").select("p_brand").distinct().toLocalIterator()
    scope = [("app", r.p_brand) for r in brands if r.p_brand != "Brand#13"]
    return log.unknown_files(spark, root, scope).select(names.below(F.col("path"), root).alias("path"))


@query(
    "missing_definitions",
    sql(
        f"""SELECT DISTINCT source_table, table_version, date FROM chg, b
          WHERE source_table = '{ws.NO_HEADER_TABLE}' AND table_version = step AND step <= upper""",
    ),
)
def missing_definitions(spark, sf):
    """Index files of a version that has no definition."""
    root, b = ws.write_workspace(spark, sf, undefined=True), views.bounds(spark, sf)
    scope = [("app", t) for t in views.TABLES]
    found = reg.registry(spark, root, None, b.upper, scope=scope).select("source_schema", "source_table", "table_version").collect()
    missing = frontier.undefined_versions(spark, root, scope, found, {}, b.upper)
    date = log.parse_index_path(names.below(F.col("path"), log.increment_dir(root)))["date"]
    return missing.select("source_table", "table_version", date.alias("date"))


@query(
    "held_changes",
    sql(
        f"""SELECT source_table, table_version, commit_ts, op, pk FROM win, b
          WHERE source_table <> '{ws.NO_HEADER_TABLE}' OR table_version < step AND commit_ts < step""",
        SQL_WIN,
    ),
)
def held_changes(spark, sf):
    """Changes of the window; of a table that lacks a definition only those before it."""
    root, b = ws.write_workspace(spark, sf, undefined=True), views.bounds(spark, sf)
    rows = read_changes(spark, root, cat.catalog(spark, root).collect(), b.lower, b.upper, Options(strict=False))
    return rows.select("source_table", "table_version", "commit_ts", "op", "data.pk")


# --- end to end -----------------------------------------------------------------------------


def _state(store: StateStore) -> DataFrame:
    parts = [
        store.read(f"app_{t}").select(F.lit(t).alias("source_table"), "pk", "value", "props", F.col("_cdc_commit_ts").alias("commit_ts"))
        for t in views.TABLES
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


@query(
    "workspace_operations",
    sql(
        """SELECT CASE WHEN op = 'D' THEN 'delete' ELSE 'upsert' END AS operation, 'app_' || source_table AS target_table, commit_ts, pk,
          CASE WHEN op <> 'D' THEN value END AS value, CASE WHEN op <> 'D' THEN props END AS props FROM win
          UNION ALL SELECT 'truncate', 'app_' || source_table, table_version, NULL, NULL, NULL
          FROM defs JOIN eff USING (source_schema, source_table), b
          WHERE (ddl_type IN (11, 23) OR trim(lower(query)) LIKE 'truncate table%') AND table_version > effective_version AND table_version <= upper""",
        SQL_DEFS, SQL_EFF, SQL_WIN,
    ),
)
def workspace_operations(spark, sf):
    """Upserts, deletes and truncates of all five tables from their files."""
    root, b = ws.write_workspace(spark, sf, truncating=True), views.bounds(spark, sf)
    feeds = [read_operations(spark, root, t, b.lower, b.upper) for t in cat.catalog(spark, root).collect()]
    return union_all([f.select("operation", "target_table", "commit_ts", "pk", "value", "props") for f in feeds])


@query("replay_state", SQL_CURRENT_STATE)
def replay_state(spark, sf):
    """The whole way: dump and change files in, state of all tables out."""
    root, out = ws.write_workspace(spark, sf), work_dir(spark, "state")
    replay(spark, root, out, buckets=4, diagnostics="_cdc_", parallel_tables=5)
    return _state(StateStore(spark, out))
