"""Tables of the snapshot dump: names, columns and keys from its DDL files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..functions.types import logical_type, spark_type_name
from ..operators.checks import InputError, raise_if_any
from .files import read_whole_text

_QUOTED = r"`((?:[^`]|``)+)`"
_TEXT = r"'(?:[^'\\]|''|\\.)*'"
# one column per line: name, type with its bracketed arguments and sign, the rest
_COLUMN = (
    rf"(?m)^[ \t]*{_QUOTED}[ \t]+"
    rf"([A-Za-z]+(?:[ \t]+[Pp][Rr][Ee][Cc][Ii][Ss][Ii][Oo][Nn])?)"
    rf"(?:[ \t]*(\((?:[^()']|{_TEXT})*\)))?"
    rf"((?:[ \t]+(?:[Uu][Nn][Ss][Ii][Gg][Nn][Ee][Dd]|[Zz][Ee][Rr][Oo][Ff][Ii][Ll][Ll])\b)*)"
    rf"(.*)$"
)
_PRIMARY = (
    r"(?im)^[ \t]*(?:CONSTRAINT[ \t]+`[^`]*`[ \t]+)?PRIMARY[ \t]+KEY[ \t]*"
    r"\(((?:[ \t]*`(?:[^`]|``)+`[ \t]*(?:\(\d+\))?[ \t]*(?:ASC|DESC)?[ \t]*,?)+)\)"
)
_CREATE = r"(?i)CREATE[ \t]+TABLE[ \t]+(?:IF[ \t]+NOT[ \t]+EXISTS[ \t]+)?(?:`(?:[^`]|``)+`\.)?`((?:[^`]|``)+)`"


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _unquote(name: Column) -> Column:
    return F.replace(name, F.lit("``"), F.lit("`"))


def parse_ddl(files: DataFrame) -> DataFrame:
    """Add ``ddl_table``, ``columns`` and ``primary_key`` to rows with a DDL ``text``."""
    text = F.col("text")
    rest = _all(text, _COLUMN, 5)
    plain_rest = F.transform(rest, lambda r: F.regexp_replace(r, _TEXT, ""))
    parts = F.arrays_zip(
        _all(text, _COLUMN, 1).alias("n"),
        _all(text, _COLUMN, 2).alias("base"),
        _all(text, _COLUMN, 3).alias("args"),
        _all(text, _COLUMN, 4).alias("sign"),
        plain_rest.alias("rest"),
    )
    zipped = F.transform(
        parts,
        lambda p, i: F.struct(
            _unquote(p["n"]).alias("name"),
            F.concat(F.upper(p["base"]), p["args"], F.upper(p["sign"])).alias("source_type"),
            (~p["rest"].rlike(r"(?i)\bNOT\s+NULL\b")).alias("nullable"),
            p["rest"].rlike(r"(?i)\bPRIMARY\s+KEY\b").alias("inline_key"),
            (i + 1).cast("int").alias("pos"),
        ),
    )
    key_text = F.regexp_extract(text, _PRIMARY, 1)
    return (
        files.withColumn("ddl_table", _unquote(F.regexp_extract(text, _CREATE, 1)))
        .withColumn("_columns", zipped)
        .withColumn(
            "primary_key",
            F.when(key_text != "", F.transform(_all(key_text, _QUOTED, 1), _unquote)).otherwise(
                F.transform(F.filter("_columns", lambda c: c["inline_key"]), lambda c: c["name"])
            ),
        )
        .withColumn(
            "columns",
            F.transform(
                "_columns",
                lambda c: F.struct(c["name"].alias("name"), c["source_type"].alias("source_type"),
                                   c["nullable"].alias("nullable"), c["pos"].alias("pos")),
            ),
        )
        .drop("_columns")
    )


def table_files(spark: SparkSession, root: str) -> DataFrame:
    """DDL files at the top level of the snapshot, with their stem and decoded names."""
    snapshot = f"{root.rstrip('/')}/snapshot"
    files = read_whole_text(spark, snapshot, f"*{names.SCHEMA_SUFFIX}")
    name = names.below(F.col("path"), snapshot)
    stem = F.substr(name, F.lit(1), F.length(name) - len(names.SCHEMA_SUFFIX))
    return (
        files.where(~name.contains("/") & ~name.endswith(names.SCHEMA_CREATE_SUFFIX))
        .withColumn("file_stem", stem)
        .withColumn("source_schema", names.stem_schema(F.col("file_stem")))
        .withColumn("source_table", names.stem_table(F.col("file_stem")))
        .where(F.col("source_schema").isNotNull())
    )


def discover(spark: SparkSession, root: str, tables: Sequence[str] = ()) -> DataFrame:
    """All selected tables of the dump, good or not, one row per DDL file."""
    schema, table = F.col("source_schema"), F.col("source_table")
    chosen = table_files(spark, root).where(names.table_selected(schema, table, tables))
    return parse_ddl(chosen).select(
        "source_schema",
        "source_table",
        names.target_table(schema, table).alias("target_table"),
        "primary_key",
        "columns",
        "file_stem",
        "path",
        "ddl_table",
    )


def without_key(found: DataFrame) -> DataFrame:
    """Report of tables that are left out because they have no primary key."""
    return found.where((F.size("primary_key") == 0) & (F.size("columns") > 0)).select(
        "source_schema", "source_table", "path"
    )


def catalog_violations(found: DataFrame) -> DataFrame:
    """Rows ``source_schema, source_table, rule, detail`` for every broken definition."""
    columns = F.transform("columns", lambda c: c["name"])
    lost = F.array_except("primary_key", columns)
    rules = F.array_compact(
        F.array(
            F.when(F.col("ddl_table") == "", F.struct(F.lit("no_create_table").alias("rule"), F.col("path").alias("detail"))),
            F.when(
                (F.col("ddl_table") != "") & (F.col("ddl_table") != F.col("source_table")),
                F.struct(F.lit("name_mismatch").alias("rule"), F.col("ddl_table").alias("detail")),
            ),
            F.when(F.size("columns") == 0, F.struct(F.lit("no_columns").alias("rule"), F.col("path").alias("detail"))),
            F.when(
                F.size(lost) > 0,
                F.struct(F.lit("key_not_in_columns").alias("rule"), F.array_join(lost, ",").alias("detail")),
            ),
        )
    )
    broken = found.select("source_schema", "source_table", F.explode(rules).alias("v")).select(
        "source_schema", "source_table", "v.rule", "v.detail"
    )
    twice = (
        found.where(F.size("primary_key") > 0)
        .groupBy("source_schema", "source_table")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("source_schema", "source_table", F.lit("duplicate").alias("rule"), F.col("n").cast("string").alias("detail"))
    )
    return broken.unionByName(twice)


def catalog(spark: SparkSession, root: str, tables: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """Catalog of the tables that can be replayed: those with a primary key.

    Strict mode raises on any broken definition and on an empty result.
    """
    found = discover(spark, root, tables)
    if strict:
        raise_if_any(catalog_violations(found), "broken snapshot definitions")
    usable = found.where(F.size("primary_key") > 0).drop("path", "ddl_table")
    if strict and usable.isEmpty():
        raise InputError("no table with a primary key was selected from the snapshot")
    return usable


def declared_schema(tables: DataFrame, diagnostics: str | None = None) -> DataFrame:
    """One row per output column: name, declared, logical and Spark type, key flag.

    ``diagnostics`` is the prefix of the three optional source columns.
    """
    rows = tables.select(
        "target_table", "primary_key", F.explode("columns").alias("c")
    ).select(
        "target_table",
        F.col("c.pos").alias("pos"),
        F.col("c.name").alias("column_name"),
        F.col("c.source_type").alias("source_type"),
        logical_type(F.col("c.source_type")).alias("logical_type"),
        spark_type_name(F.col("c.source_type")).alias("spark_type"),
        F.array_contains("primary_key", F.col("c.name")).alias("is_key"),
    )
    if diagnostics is None:
        return rows
    extra = F.array(
        *[
            F.struct(F.lit(10000 + i).alias("pos"), F.lit(diagnostics + n).alias("column_name"),
                     F.lit(t).alias("logical_type"), F.lit(s).alias("spark_type"))
            for i, (n, t, s) in enumerate(
                (("commit_ts", "LONG", "bigint"), ("source_schema", "STRING", "string"), ("source_table", "STRING", "string"))
            )
        ]
    )
    return rows.unionByName(
        tables.select("target_table", F.explode(extra).alias("e")).select(
            "target_table", "e.*", F.lit(None).cast("string").alias("source_type"), F.lit(False).alias("is_key")
        )
    )


def position_of(text: Column) -> Column:
    """Snapshot position in the metadata text, NULL when there is none."""
    found = F.regexp_extract(text, r"(?m)^\s*Pos:\s*(\d+)\s*$", 1)
    return F.when(found != "", found.cast("bigint"))


def snapshot_position(spark: SparkSession, root: str) -> int:
    path = f"{root.rstrip('/')}/snapshot/metadata"
    rows = read_whole_text(spark, path).select(position_of(F.col("text")).alias("pos")).collect()
    if not rows or rows[0].pos is None:
        raise InputError(f"no snapshot position in {path}")
    return rows[0].pos
