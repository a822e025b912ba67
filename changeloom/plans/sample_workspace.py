"""The sample views written as a workspace, so that the readers can be checked against them."""

from __future__ import annotations

import json
import zlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.registry import canonical_text
from ..workdir import work_dir
from . import sample_views as views
from .state import put_text

SNAPSHOT_COLUMNS = [("pk", "BIGINT"), ("value", "DOUBLE"), ("props", "TEXT")]
ADDED_COLUMN = ("seen", "DATETIME")
NO_HEADER_TABLE = "e_signup"


def csv_field(value: Column) -> Column:
    """CSV text of a value: NULL marker, and quotes where they are needed."""
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.isNull(), "\\N").when(value.rlike('[",\\r\\n]'), quoted).otherwise(value)


def write_files(lines: DataFrame, root: str) -> None:
    """Write rows ``file, place, line`` as text files, in the order of ``place``.

    Spark names its own files, so each comes out in a directory of its own and is renamed.
    """
    spark = lines.sparkSession
    tmp = work_dir(spark, "files")
    # several of these folders share a task, but one file's lines stay together and in order
    placed = lines.repartition("file").sortWithinPartitions("file", "place").select("file", "line")
    placed.write.partitionBy("file").text(tmp)
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(tmp)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    decode = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName

    def move(folder) -> None:
        name = folder.getPath().getName()
        if not name.startswith("file="):
            return
        parts = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-")]
        target = hadoop.Path(f"{root}/{decode(name[5:])}")
        fs.mkdirs(target.getParent())
        fs.rename(parts[0], target)

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, fs.listStatus(base)))


def definition(table: str, version: int, columns, ddl_type: int = 0, query: str = "") -> tuple[str, str]:
    """File name and text of a definition file."""
    doc = {
        "Table": table, "Schema": "app", "Version": 1, "TableVersion": version, "Query": query, "Type": ddl_type,
        "TableColumns": [{"ColumnName": n, "ColumnType": t} for n, t in columns],
        "TableColumnsTotal": len(columns),
    }
    text = json.dumps(doc)
    crc = zlib.crc32(canonical_text(text).encode()) & 0xFFFFFFFF
    return f"increment/app/{table}/meta/schema_{version}_{crc}.json", text


def ddl(table: str) -> str:
    return f"""/*!40101 SET NAMES binary*/;
CREATE TABLE `{table}` (
  `pk` bigint NOT NULL,
  `value` double DEFAULT NULL,
  `props` text DEFAULT NULL COMMENT 'NOT NULL, no PRIMARY KEY (here)',
  PRIMARY KEY (`pk`) /*T![clustered_index] CLUSTERED */
) ENGINE=InnoDB DEFAULT CHARSET=utf8mb4;
"""


def snapshot_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks 1, 2, 10, 11 and so on of each table; the even ones have another column order."""
    rows = views.snapshot(spark, sf)
    at = F.col("pk") % (4 + views.bounds(spark, sf).n // 500_000)
    number = at + F.when(at < 2, 1).otherwise(8)
    file = F.concat(F.lit("snapshot/app."), "source_table", F.lit("."), number.cast("string"), F.lit(".csv"))
    pk, value, props = (csv_field(F.col(c).cast("string")) for c in ("pk", "value", "props"))
    turned = (number % 2 == 0) & (F.col("source_table") != NO_HEADER_TABLE)
    data = rows.select(
        file.alias("file"), (F.col("pk") + 1).alias("place"),
        F.when(turned, F.concat_ws(",", props, pk, value)).otherwise(F.concat_ws(",", pk, value, props)).alias("line"),
    )
    heads = rows.where(F.col("source_table") != NO_HEADER_TABLE).select(
        file.alias("file"), F.lit(0).cast("bigint").alias("place"),
        F.when(turned, "props,pk,value").otherwise("pk,value,props").alias("line"),
    ).distinct()
    return data.unionByName(heads)


def change_line(rows: DataFrame, step: int) -> Column:
    """A change row as CSV; one version has a column more."""
    meta = [F.col(c).cast("string") for c in ("op", "source_table", "source_schema", "commit_ts")]
    values = [csv_field(F.col(c).cast("string")) for c in ("pk", "value", "props")]
    short = F.concat_ws(",", *meta, *values)
    seen = F.concat(F.col("date"), F.lit(" 00:00:00"))
    return F.when(F.col("table_version") == 2 * step, F.concat_ws(",", short, seen)).otherwise(short)


def change_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.changes(spark, sf)
    file = F.concat_ws(
        "/", F.lit("increment/app"), "source_table", F.col("table_version").cast("string"), "date",
        F.concat(F.lit("CDC"), F.lpad(F.col("file_index").cast("string"), 6, "0"), F.lit(".csv")),
    )
    return rows.select(file.alias("file"), F.col("row_seq").alias("place"), change_line(rows, views.bounds(spark, sf).step).alias("line"))


def index_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Index files. Their newest file may not be the newest of another version of that day."""
    rows = views.changes(spark, sf)
    newest = rows.groupBy("source_table", "table_version", "date").agg(F.max("file_index").alias("i"))
    file = F.concat_ws("/", F.lit("increment/app"), "source_table", F.col("table_version").cast("string"), "date", F.lit("meta/CDC.index"))
    return newest.select(
        file.alias("file"), F.lit(0).cast("bigint").alias("place"),
        F.concat(F.lit("CDC"), F.lpad(F.col("i").cast("string"), 6, "0"), F.lit(".csv")).alias("line"),
    )


def gap_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Empty change files where a day has none for a number that its index covers."""
    rows = views.changes(spark, sf)
    newest = rows.groupBy("source_table", "table_version", "date").agg(
        F.max("file_index").alias("i"), F.collect_set("file_index").alias("have")
    )
    gaps = newest.select("*", F.explode(F.array_except(F.sequence(F.lit(1).cast("bigint"), "i"), "have")).alias("file_index"))
    file = F.concat_ws(
        "/", F.lit("increment/app"), "source_table", F.col("table_version").cast("string"), "date",
        F.concat(F.lit("CDC"), F.lpad(F.col("file_index").cast("string"), 6, "0"), F.lit(".csv")),
    )
    return gaps.select(file.alias("file"), F.lit(0).cast("bigint").alias("place"), F.lit("").alias("line"))


_written: dict[tuple[str, str, str], str] = {}


def write_workspace(spark: SparkSession, sf: str, truncating: bool = False, undefined: bool = False) -> str:
    """Folder of the workspace for these tables; written once per session.

    With ``undefined`` one version of ``NO_HEADER_TABLE``, the second, has change files and no definition. With
    ``truncating`` some versions start with a truncate, as in :func:`.sample_views.definitions`.
    """
    key = (spark.sparkContext.applicationId, sf, f"truncating {truncating} undefined {undefined}")
    if key in _written:
        return _written[key]
    b = views.bounds(spark, sf)
    root = work_dir(spark, "workspace")
    put_text(spark, f"{root}/snapshot/metadata", f"SHOW MASTER STATUS:\n    Log: x\n    Pos: {b.lower}\n    GTID:\n")
    put_text(spark, f"{root}/snapshot/app-schema-create.sql", "CREATE DATABASE `app`;\n")
    put_text(spark, f"{root}/snapshot/app.keyless-schema.sql", "CREATE TABLE `keyless` (\n  `a` int NOT NULL\n);\n")
    put_text(spark, f"{root}/increment/metadata", json.dumps({"checkpoint-ts": b.upper}))
    marks = {}
    if truncating:
        marks = {(d.source_table, d.table_version): (d.ddl_type, d.query) for d in views.definitions(spark, sf).collect()}
    for table in views.TABLES:
        put_text(spark, f"{root}/snapshot/app.{table}-schema.sql", ddl(table))
        for version in range(0, b.n, b.step):
            if undefined and (table, version) == (NO_HEADER_TABLE, b.step):
                continue
            columns = [] if version == 3 * b.step else [*SNAPSHOT_COLUMNS, *([ADDED_COLUMN] if version == 2 * b.step else [])]
            name, text = definition(table, version, columns, *marks.get((table, version), (0, "")))
            put_text(spark, f"{root}/{name}", text)
    lines = snapshot_lines(spark, sf)
    for more in (change_lines, index_lines, gap_lines):
        lines = lines.unionByName(more(spark, sf))
    write_files(lines, root)
    _written[key] = root
    return root


# what is wrong with a row of the messy workspace, by its number
DEFECTS = {
    "header": 31,  # a header in front of the row
    "blank": 37,  # a blank line in front of the row
    "flag": 5,  # a fifth meta field
    "width": 41,  # one field short
    "operation": 43,
    "identity": 47,
    "commit_ts": 53,
    "value": 59,
}


def write_messy_workspace(spark: SparkSession, sf: str) -> str:
    """Change files with defects, in the layout without dates."""
    key = (spark.sparkContext.applicationId, sf, "messy")
    if key in _written:
        return _written[key]
    root = work_dir(spark, "messy")
    e = F.col("row_seq")

    def hit(name: str) -> Column:
        return e % DEFECTS[name] == 0

    op = F.when(hit("operation"), F.lit("X")).otherwise(F.col("op"))
    table = F.when(hit("identity"), F.lit("elsewhere")).otherwise(F.col("source_table"))
    ts = F.when(hit("commit_ts"), F.lit("soon")).otherwise(F.col("commit_ts").cast("string"))
    flag = F.when(hit("flag"), F.lit("true"))
    pk = F.when(hit("value"), F.lit("n/a")).otherwise(F.col("pk").cast("string"))
    tail = F.when(~hit("width"), csv_field(F.concat("props", F.lit("\nnext \"line\""))))
    line = F.concat_ws(",", op, table, "source_schema", ts, flag, pk, F.col("value").cast("string"), tail)
    line = F.concat(line, F.when(e % 2 == 0, F.lit("\r")).otherwise(""))
    line = F.when(hit("blank"), F.concat(F.lit("\n"), line)).otherwise(line)
    header = "Operation,table,schema,ts,pk,value,props\n"
    line = F.when(hit("header"), F.concat(F.lit(header), line)).otherwise(line)
    slot = F.floor(e / 20000).cast("bigint") + 1
    file = F.concat(
        F.lit("increment/app/"), "source_table", F.lit("/"), F.col("table_version").cast("string"), F.lit("/7/CDC"),
        F.lpad(slot.cast("string"), 8, "0"), F.lit(".csv"),
    )
    write_files(views.changes(spark, sf).select(file.alias("file"), e.alias("place"), line.alias("line")), root)
    _written[key] = root
    return root


def dump_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Definition files of a dump with a table for each brand of ``part`` and a column for each size it comes in.

    Brands with a number divisible by three have no primary key.
    """
    size = F.col("p_size")
    rows = views.table(spark, sf, "part").select(F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("t"), size).distinct()
    kind = (
        F.when(size % 4 == 0, F.lit("int unsigned"))
        .when(size % 4 == 1, F.concat(F.lit("decimal(38,"), (size % 10).cast("string"), F.lit(")")))
        .when(size % 4 == 2, F.lit("datetime(3)"))
        .otherwise(F.concat(F.lit("varchar("), size.cast("string"), F.lit(")")))
    )
    null = F.when(size % 5 == 0, " NOT NULL").otherwise(" DEFAULT NULL COMMENT 'is NOT NULL, says (x)'")
    line = F.concat(F.lit("  `s"), size.cast("string"), F.lit("` "), kind, null, F.lit(","))
    file = F.concat(F.lit("snapshot/app."), F.col("t"), F.lit("-schema.sql"))
    columns = rows.select(file.alias("file"), size.cast("bigint").alias("place"), line.alias("line"))
    tables = rows.select("t").distinct()
    keyless = F.substring_index("t", "_", -1).cast("int") % 3 == 0
    around = (
        (-1, F.concat(F.lit("/* dump */;\nCREATE TABLE `"), F.col("t"), F.lit("` (\n  `k` bigint NOT NULL,"))),
        (1000, F.when(keyless, "  KEY `x` (`k`)\n);").otherwise("  PRIMARY KEY (`k`)\n);")),
    )
    for place, text in around:
        columns = columns.unionByName(
            tables.select(file.alias("file"), F.lit(place).cast("bigint").alias("place"), text.alias("line"))
        )
    return columns


def write_dump(spark: SparkSession, sf: str) -> str:
    """Folder of a dump that has the definition files of :func:`dump_lines` and no data."""
    key = (spark.sparkContext.applicationId, sf, "dump")
    if key not in _written:
        root = work_dir(spark, "dump")
        write_files(dump_lines(spark, sf), root)
        _written[key] = root
    return _written[key]


def write_strays(spark: SparkSession, sf: str) -> str:
    """Folder of a change log that has, beside each brand's definitions, files for its sizes that are none."""
    key = (spark.sparkContext.applicationId, sf, "strays")
    if key not in _written:
        root = work_dir(spark, "strays")
        size = F.col("p_size")
        tail = F.when(size % 3 == 0, ".json").when(size % 3 == 1, "_x.json").otherwise(F.concat(F.lit("_"), size.cast("string"), F.lit(".json")))
        file = F.concat(F.lit("increment/app/"), "p_brand", F.lit("/meta/schema_"), size.cast("string"), tail)
        parts = views.table(spark, sf, "part").select(file.alias("file"), F.col("p_partkey").alias("place"), F.col("p_name").alias("line"))
        write_files(parts, root)
        _written[key] = root
    return _written[key]


def write_documents(spark: SparkSession, sf: str) -> str:
    """Whole texts of ``documents`` as a CSV change file set."""
    key = (spark.sparkContext.applicationId, sf, "documents")
    if key in _written:
        return _written[key]
    root = work_dir(spark, "documents")
    rows = views.table(spark, sf, "documents")
    line = F.concat_ws(",", F.lit("I"), F.lit("documents"), F.lit("app"), (F.col("doc_id") + 1).cast("string"),
                       F.col("doc_id").cast("string"), csv_field(F.col("text")), csv_field(F.col("source")))
    file = F.concat(F.lit("increment/app/documents/1/CDC"), F.lpad((F.floor(F.col("doc_id") / 500) + 1).cast("string"), 6, "0"), F.lit(".csv"))
    write_files(rows.select(file.alias("file"), F.col("doc_id").alias("place"), line.alias("line")), root)
    _written[key] = root
    return root
