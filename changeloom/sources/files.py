"""File inventory, whole-file text and CSV rows with their position."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import below, literal_path, percent_decode, plain_path
from ..local import local_frame
from . import csv_ranges

# A text that no writer produces: switches off the CSV reader's own NULL rule.
_NEVER = "\u0001"
BAD_RECORD = "_bad_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where))


def existing(spark: SparkSession, roots: str | Sequence[str]) -> list[str]:
    """The given roots that exist; a root per table or version, so their number stays small."""
    roots = [roots] if isinstance(roots, str) else list(roots)
    with ThreadPoolExecutor(max_workers=16) as pool:
        found = list(pool.map(lambda r: path_exists(spark, r), roots))
    return [r for r, there in zip(roots, found) if there]


def list_files(spark: SparkSession, roots: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Inventory ``path, length, modified`` of all files below the roots; contents stay unread.

    Roots that do not exist yet count as empty. A root is listed even when its own name starts
    with ``_`` or ``.``, which Spark would skip if it met it further down.
    """
    roots = existing(spark, roots)
    if not roots:
        return local_frame(spark, [], "path string, length bigint, modified timestamp")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load([literal_path(r) for r in roots]).select(
        plain_path(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified")
    )


def child_prefixes(files: DataFrame, root: str) -> DataFrame:
    """Distinct first-level directories below ``root``."""
    parts = F.split(below(F.col("path"), root), "/")
    return (
        files.where(F.size(parts) > 1).select(F.concat(parts[0], F.lit("/")).alias("prefix")).distinct()
    )


def source_path() -> Column:
    """Plain path of the file a row comes from.

    It is worked out for every row, hence no patterns: the part of the URI after scheme and
    authority, decoded only where something is encoded.
    """
    uri = F.col("_metadata.file_path")
    start = F.expr("locate('/', _metadata.file_path, locate('//', _metadata.file_path) + 2)")
    path = F.substr(uri, start)
    return F.when(path.contains("%"), percent_decode(path)).otherwise(path)


def read_whole_text(spark: SparkSession, roots: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """One row ``path, text`` per file."""
    roots = existing(spark, roots)
    if not roots:
        return local_frame(spark, [], "path string, text string")
    reader = spark.read.option("wholetext", True).option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format("text").load([literal_path(r) for r in roots]).select(source_path().alias("path"), F.col("value").alias("text"))


def csv_schema(columns: Sequence[str]) -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType([*fields, T.StructField(BAD_RECORD, T.StringType())])


def csv_options(n_columns: int, multiline: bool = True) -> dict[str, object]:
    return {
        "header": False,
        "quote": '"',
        "escape": '"',
        "lineSep": "\n",
        "multiLine": multiline,
        "nullValue": _NEVER,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_RECORD,
        # with pruning on, a projection hides rows of the wrong width
        "columnPruning": False,
        "maxColumns": max(20480, n_columns + 64),
    }


def read_csv_rows(
    spark: SparkSession,
    roots: Sequence[str],
    columns: Sequence[str],
    *,
    multiline: bool = True,
    glob: str | None = None,
    recursive: bool = False,
    numbered: bool = True,
) -> DataFrame:
    """Rows of CSV files as text, with their place.

    Adds ``path``, ``block_start`` and ``row_seq`` (see :func:`number_rows`) and ``_bad_record``,
    the text of a row with the wrong number of fields. Fields of good rows are never NULL:
    an empty field is ``''``, as it is when quoted. A CR left over from a CRLF record end is
    dropped from the last field. With ``multiline`` values may hold line breaks; files beyond
    ``spark.sql.files.maxPartitionBytes`` are then read by byte ranges (see :mod:`.csv_ranges`).
    """
    reader = spark.read.schema(csv_schema(columns)).options(**csv_options(len(columns), multiline))
    reader = reader.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    place = [source_path().alias("path"), F.col("_metadata.file_block_start").alias("block_start")]
    rows = reader.csv([literal_path(r) for r in roots])
    most = csv_ranges.range_bytes(spark)
    split = multiline and plan_bytes(rows) > most
    if split:
        rows = rows.where(F.col("_metadata.file_size") <= most)
    rows = rows.select("*", *place)
    if split:
        rows = rows.unionByName(split_csv_rows(spark, roots, columns, most, glob=glob, recursive=recursive))
    rows = rows.withColumns(clean_fields(columns))
    return number_rows(rows) if numbered else rows


def plan_bytes(rows: DataFrame) -> int:
    """Bytes of the files behind an untouched scan, as its plan has them."""
    return int(str(rows._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def split_csv_rows(
    spark: SparkSession, roots: Sequence[str], columns: Sequence[str], larger_than: int, *, glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """Rows of the files that are larger, by byte ranges: the same that ``multiLine`` gives with a task for each file."""
    lines = csv_ranges.lines_of(spark, roots, source_path(), glob, recursive, larger_than)
    known = csv_ranges.range_states(lines)
    options = {k: str(v) for k, v in csv_options(len(columns), False).items() if k not in ("header", "multiLine")}
    ddl = csv_schema(columns).simpleString()[7:-1].replace(":", " ")
    found = csv_ranges.records(lines, known)
    return found.select(F.from_csv("record", ddl, options).alias("_r"), "path", "block_start").select("_r.*", "path", "block_start")


def number_rows(rows: DataFrame) -> DataFrame:
    """Add ``row_seq``, which rises with the rows of a file block.

    It has to be taken in the stage that scans. As it is not deterministic, it also keeps
    later filters from being pushed into the expressions below, where each of them would
    repeat the whole parsing of a row.
    """
    return rows.withColumn("row_seq", F.monotonically_increasing_id())


def clean_fields(columns: Sequence[str]) -> dict[str, Column]:
    good = F.col(BAD_RECORD).isNull()
    fixed = {c: F.when(good, F.coalesce(F.col(c), F.lit(""))) for c in columns}
    last = columns[-1]
    fixed[last] = F.regexp_replace(fixed[last], r"\r\z", "")
    return fixed
