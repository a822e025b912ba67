"""Rows of the snapshot dump."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names
from ..functions.types import coerce, is_bad_value
from ..operators.facts import attach_facts
from .files import BAD_RECORD, list_files, read_csv_rows

FILE_ORDER = ("file_order", "block_start", "row_seq")


def snapshot_dir(root: str) -> str:
    return f"{root.rstrip('/')}/snapshot"


def is_data_file(relative: Column, stem: Column | str) -> Column:
    """Data files of a table: ``<stem>.`` in front and ``.csv`` at the end."""
    stem = F.lit(stem) if isinstance(stem, str) else stem
    return relative.startswith(F.concat(stem, F.lit("."))) & relative.endswith(".csv")


def snapshot_files(spark: SparkSession, root: str, stem: str) -> DataFrame:
    base = snapshot_dir(root)
    relative = names.below(F.col("path"), base)
    files = list_files(spark, base, "*.csv").where(is_data_file(relative, stem))
    return files.withColumn("file_order", names.natural_order(F.col("path")))


def _glob_escape(text: str) -> str:
    return "".join("\\" + c if c in "*?[]{}\\^" else c for c in text)


def read_fields(spark: SparkSession, root: str, stem: str, n: int, multiline: bool = True) -> DataFrame:
    """Rows of a table's files as text ``f0..``, in the width of the table."""
    rows = read_csv_rows(
        spark, [snapshot_dir(root)], [f"f{i}" for i in range(n)],
        glob=f"{_glob_escape(stem)}.*csv", multiline=multiline, recursive=True,
    )
    relative = names.below(F.col("path"), snapshot_dir(root))
    # the stem is the same for all files of the table, so only the rest is worth comparing
    chunk = F.substr(relative, F.lit(len(stem) + 2))
    return rows.where(is_data_file(relative, stem)).withColumn("file_order", names.natural_order(chunk))


def wrong_width(rows: DataFrame, field: str) -> DataFrame:
    """Rows with another number of fields than the table, their text in ``record``."""
    # the CSV source refuses plans that read its bad-record column alone
    with_field = F.length(F.coalesce(F.col(field), F.lit(""))) >= 0
    return rows.where(F.col(BAD_RECORD).isNotNull() & with_field).withColumn("record", F.col(BAD_RECORD))


def width_violations(fields: DataFrame) -> DataFrame:
    return wrong_width(fields, "f0").select("path", "block_start", "row_seq", "record")


def _fields(n: int) -> Column:
    return F.array(*[F.col(f"f{i}") for i in range(n)])


def looks_like_header(fields: Column, columns: Sequence[str]) -> Column:
    return F.array_sort(fields) == F.array(*[F.lit(c) for c in sorted(columns)])


def file_headers(fields: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file: its header (NULL when the first row is data) and how many rows look like one."""
    values = _fields(len(columns))
    alike = F.col(BAD_RECORD).isNull() & looks_like_header(values, columns)
    place = F.struct("block_start", "row_seq")
    first = fields.select("path", place.alias("_place"), F.when(alike, values).alias("_header"), alike.alias("_alike"))
    return first.groupBy("path").agg(
        F.min_by("_header", "_place").alias("header"), F.count_if("_alike").alias("n_alike")
    )


def named_fields(fields: DataFrame, headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Data rows with their text by column name, whatever order each file's header has."""
    n = len(columns)
    joined = attach_facts(fields, headers.select("path", "header"), ["path"])
    values = _fields(n)
    alike = F.col("header").isNotNull() & looks_like_header(values, columns) & F.col(BAD_RECORD).isNull()
    data = joined.where(~F.coalesce(alike, F.lit(False)))
    # rows equal to a header but not the first of their file are data; there are hardly any
    order = W.partitionBy("path").orderBy("block_start", "row_seq")
    repeated = joined.where(alike).withColumn("_n", F.row_number().over(order)).where("_n > 1").drop("_n")
    rows = data.unionByName(repeated)
    named = {}
    for i, c in enumerate(columns):
        at = F.array_position("header", F.lit(c)).cast("int")
        named[f"c{i}"] = F.when(F.col("header").isNull(), F.col(f"f{i}")).otherwise(F.element_at(values, at))
    return rows.withColumns(named).drop("header", *[f"f{i}" for i in range(n)])


def read_named(
    spark: SparkSession, root: str, stem: str, columns: Sequence[str], multiline: bool = True
) -> DataFrame:
    """Text by column name (``c0..`` in the order of ``columns``).

    A first, narrow pass finds the header of every file. When all files agree, as they do in
    a dump from one writer, the mapping is fixed and the rows are read without any join.
    """
    n = len(columns)
    fields = read_fields(spark, root, stem, n, multiline)
    headers = file_headers(fields, columns)
    kinds = headers.groupBy("header").agg(F.max("n_alike").alias("n")).limit(2).collect()
    if len(kinds) > 1 or (kinds and kinds[0].header is not None and kinds[0].n > 1):
        return named_fields(fields, headers, columns)
    header = kinds[0].header if kinds else None
    source = {c: f"f{(header or list(columns)).index(c)}" for c in columns}
    if header is not None:
        alike = F.col(BAD_RECORD).isNull() & looks_like_header(_fields(n), columns)
        fields = fields.where(~alike)
    return fields.withColumns({f"c{i}": F.col(source[c]) for i, c in enumerate(columns)}).drop(
        *[f"f{i}" for i in range(n)]
    )


def typed_rows(
    named: DataFrame,
    columns: Sequence[tuple[str, str]],
    *,
    on_error: str = "raise",
    diagnostics: tuple[str, str, str] | None = None,
    **coercion,
) -> DataFrame:
    """Snapshot rows with their place (``file_order, block_start, row_seq``) and typed ``data``.

    ``diagnostics`` is the prefix of the source columns and the names of schema and table.
    """
    if on_error == "raise":
        message = F.concat(F.lit("snapshot row has the wrong width in "), F.col("path"), F.lit(": "), F.col(BAD_RECORD))
        order = F.when(F.col(BAD_RECORD).isNull(), F.col("file_order")).otherwise(F.raise_error(message).cast("string"))
        rows = named.withColumn("file_order", order).where(F.col("file_order").isNotNull())
    else:
        rows = named.where(F.col(BAD_RECORD).isNull())
        for i, (_, kind) in enumerate(columns):
            rows = rows.where(~is_bad_value(F.col(f"c{i}"), kind, **coercion))
    mode = "raise" if on_error == "raise" else "null"
    values = [
        coerce(F.col(f"c{i}"), kind, on_error=mode, **coercion).alias(name)
        for i, (name, kind) in enumerate(columns)
    ]
    if diagnostics is not None:
        prefix, schema, table = diagnostics
        values += [
            F.lit(0).cast("bigint").alias(f"{prefix}commit_ts"),
            F.lit(schema).alias(f"{prefix}source_schema"),
            F.lit(table).alias(f"{prefix}source_table"),
        ]
    return rows.select(*FILE_ORDER, F.struct(*values).alias("data"))
