"""Change files: which are ready to read, and their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..functions.types import coerce, is_bad_value
from ..operators import checks
from ..operators.apply import POSITION, STREAM
from ..operators.facts import TABLE, attach_facts
from .files import BAD_RECORD, csv_options, csv_schema, list_files, number_rows, path_exists, read_csv_rows, read_whole_text

META = ("op", "row_table", "row_schema", "ts_text")
# fixed values: texts of the optional fifth field of a change row
FLAG_WORDS = ("true", "false", "0", "1")
_HEADER_RECORD = r'(?i)^"?operation"?(,|\r?\z)'


def increment_dir(root: str) -> str:
    return f"{root.rstrip('/')}/increment"


# --- bounds and index files ---------------------------------------------------------------


def checkpoint_text(text: Column) -> Column:
    """``checkpoint-ts`` of the metadata text, NULL when it is missing or no integer."""
    raw = F.from_json(text, "`checkpoint-ts` string").getField("checkpoint-ts")
    return raw.try_cast("bigint")


def checkpoint_bound(spark: SparkSession, root: str) -> int | None:
    """Upper bound of the change log; None when there is no metadata file yet."""
    path = f"{increment_dir(root)}/metadata"
    if not path_exists(spark, path):
        return None
    rows = read_whole_text(spark, path).select(checkpoint_text(F.col("text")).alias("ts")).collect()
    if not rows or rows[0].ts is None:
        raise checks.InputError(f"no integer checkpoint-ts in {path}")
    return rows[0].ts


def unknown_files(spark: SparkSession, root: str, scope: Sequence[tuple[str, str]]) -> DataFrame:
    """Files beside the definitions of managed tables that are no definitions."""
    base = increment_dir(root)
    files = list_files(spark, [f"{base}/{s}/{t}/meta" for s, t in scope])
    return files.where(~names.below(F.col("path"), base).rlike(names.SCHEMA_FILE)).select("path")


def _place(parts: Column, n_tail: int, date_separator: str) -> dict[str, Column]:
    """Place columns of a path below the change-log directory, split at ``/``.

    The layout is ``schema/table/version/[partition/][date/]`` and ``n_tail`` more names; deeper paths have
    no partition and are passed over.
    """
    end = F.size(parts) - n_tail
    last = F.get(parts, end - 1)
    # a bare four-digit name is a year only where dates may be that short
    dated = (end > 3) & last.rlike(names.DATE_DIR)
    if date_separator in ("day", "month"):
        dated = dated & last.contains("-")
    is_date = F.coalesce(dated, F.lit(False))
    end = end - F.when(is_date, 1).otherwise(0)
    number = F.get(parts, F.lit(3))
    part = F.when((end == 4) & number.rlike("^[0-9]+$"), number.try_cast("bigint")).when(end == 3, F.lit(0))
    return {
        "source_schema": F.get(parts, F.lit(0)),
        "source_table": F.get(parts, F.lit(1)),
        "table_version": F.get(parts, F.lit(2)).try_cast("bigint"),
        "partition_id": part.cast("bigint"),
        "date": F.when(is_date, last).otherwise(F.lit("")),
    }


def parse_index_path(relative: Column, date_separator: str = "day") -> dict[str, Column]:
    """Columns of an index file's path below the change-log directory."""
    writer = F.regexp_extract(relative, names.INDEX_FILE, 1)
    return {**_place(F.split(relative, "/"), 2, date_separator), "path_writer": writer}


def parse_index_text(text: Column) -> dict[str, Column]:
    """Newest file number, its number of digits, and the writer id that must not be there."""
    first = F.trim(F.regexp_replace(F.element_at(F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), "\n"), 1), r"\r", ""))
    digits = F.regexp_extract(first, names.DATA_FILE, 1)
    return {
        "latest_file_index": F.when(digits != "", digits.cast("bigint")),
        "file_width": F.when(digits != "", F.length(digits)),
        "text_writer": F.regexp_extract(first, names.WRITER_DATA_FILE, 1),
    }


def read_indexes(
    spark: SparkSession, root: str, versions: Sequence[tuple[str, str, int]], date_separator: str = "day"
) -> DataFrame:
    """Index files of the given versions with their parsed path and content."""
    base = increment_dir(root)
    roots = [f"{base}/{s}/{t}/{v}" for s, t, v in versions]
    files = read_whole_text(spark, roots, "CDC*.index")
    relative = names.below(F.col("path"), base)
    return (
        files.where(relative.rlike(names.INDEX_FILE))
        .withColumns(parse_index_path(relative, date_separator))
        .withColumns(parse_index_text(F.col("text")))
        .withColumn("data_dir", names.parent_dir(names.parent_dir(F.col("path"))))
        .drop("text")
    )


def index_rule() -> Column:
    return checks.violation_rule(
        {
            "multi_writer": (F.col("path_writer") != "") | (F.col("text_writer") != ""),
            "bad_content": F.col("latest_file_index").isNull(),
            "bad_version": F.col("table_version").isNull(),
        }
    )


def index_violations(indexes: DataFrame) -> DataFrame:
    return indexes.withColumn("rule", index_rule()).where("rule IS NOT NULL").select("path", "rule")


def file_ranges(indexes: DataFrame, strict: bool = False) -> DataFrame:
    """One row per readable index; directories that are neither partition nor date are passed over.

    Strict mode fails on an unusable index in the pass that reads it.
    """
    rows = indexes.where(F.col("partition_id").isNotNull() | (F.col("path_writer") != ""))
    if strict:
        message = F.concat(F.lit("unusable index file ("), index_rule(), F.lit("): "), F.col("path"))
        latest = F.when(index_rule().isNull(), F.col("latest_file_index")).otherwise(F.raise_error(message).cast("bigint"))
        rows = rows.withColumn("latest_file_index", latest)
    else:
        rows = rows.where(index_rule().isNull())
    return rows.select(*STREAM, "date", "latest_file_index", "file_width", "data_dir", "path")


def visible_versions(rows: DataFrame, upper: int | Column) -> DataFrame:
    return rows.where(F.col("table_version") <= upper)


def new_ranges(ranges: DataFrame, streams: DataFrame | None) -> DataFrame:
    """Ranges with files that progress does not cover yet, and the first such file number."""
    if streams is None:
        return ranges.withColumn("first_file_index", F.lit(1).cast("bigint"))
    done = streams.select(*STREAM, "last_date", "last_file_index")
    last = F.coalesce(F.col("last_date"), F.lit(""))
    first = F.when(F.col("date") == last, F.coalesce(F.col("last_file_index"), F.lit(0)) + 1).otherwise(1)
    return (
        attach_facts(ranges, done, STREAM)
        .where((last == "") | (F.col("date") == "") | (F.col("date") >= last))
        .withColumn("first_file_index", first.cast("bigint"))
        .where(F.col("first_file_index") <= F.col("latest_file_index"))
        .drop("last_date", "last_file_index")
    )


def expand_files(ranges: DataFrame) -> DataFrame:
    """One row per file that the ranges name."""
    index = F.explode(F.sequence(F.col("first_file_index"), F.col("latest_file_index"))).alias("file_index")
    listed = ranges.where(F.col("first_file_index") <= F.col("latest_file_index"))
    keep = [c for c in ranges.columns if c not in ("path", "first_file_index", "latest_file_index")]
    numbered = listed.select(*keep, index)
    digits = F.col("file_index").cast("string")
    padded = F.when(
        F.length(digits) >= F.col("file_width"), digits
    ).otherwise(F.expr("lpad(cast(file_index AS string), file_width, '0')"))
    return numbered.withColumn("path", F.concat("data_dir", F.lit("/CDC"), padded, F.lit(".csv")))


# --- rows -----------------------------------------------------------------------------------


def value_fields(n: int) -> list[str]:
    return [f"v{i}" for i in range(n)]


def split_rows(raw: DataFrame, n_values: int, extra_field: bool = False) -> DataFrame:
    """Rows with their meta fields, values ``v0..`` and the width check in ``width_ok``.

    Header and blank records are dropped. A row with one field too many is read again with a
    fifth meta field, and taken when that field is a flag. With ``extra_field`` the fifth
    field is always there (``raw`` then was read with it).
    """
    bad = F.col(BAD_RECORD)
    rows = raw.where(
        F.when(bad.isNull(), F.lower(F.coalesce("op", F.lit(""))) != "operation").otherwise(
            ~bad.rlike(_HEADER_RECORD) & ~bad.rlike(r"^\r?\z")
        )
    )
    if extra_field:
        return rows.withColumn("width_ok", bad.isNull())
    wide = [*META, "flag", *value_fields(n_values)]
    options = {k: str(v) for k, v in csv_options(len(wide), False).items() if k not in ("header", "multiLine")}
    again = F.when(bad.isNotNull(), F.from_csv(bad, csv_schema(wide).simpleString()[7:-1].replace(":", " "), options))
    rows = rows.withColumn("_again", again)
    fits = F.col(f"_again.{BAD_RECORD}").isNull() & F.lower(F.col("_again.flag")).isin(*FLAG_WORDS)
    rows = rows.withColumn("_fits", F.coalesce(bad.isNotNull() & fits, F.lit(False)))
    last = value_fields(n_values)[-1] if n_values else META[-1]
    fixed = {}
    for c in [*META, *value_fields(n_values)]:
        text = F.coalesce(F.col(f"_again.{c}"), F.lit(""))
        if c == last:
            text = F.regexp_replace(text, r"\r\z", "")
        fixed[c] = F.when(F.col("_fits"), text).otherwise(F.col(c))
    return rows.withColumns(fixed).withColumn("width_ok", bad.isNull() | F.col("_fits")).drop("_again", "_fits")


def row_rule() -> Column:
    """Name of the first structural rule that a change row breaks, or NULL."""
    return checks.violation_rule(
        {
            "width": ~F.col("width_ok"),
            "operation": checks.bad_operation(F.col("op")),
            "identity": checks.bad_identity(
                F.col("source_schema"), F.col("source_table"), F.col("row_schema"), F.col("row_table")
            ),
            "commit_ts": checks.bad_commit_ts(F.col("ts_text")),
        }
    )


def with_place(rows: DataFrame, root: str, date_separator: str = "day") -> DataFrame:
    """Add version, partition, date and file number of the data file that a row came from.

    This runs for every row, so the path is split once and no long pattern is matched.
    """
    split = rows.withColumn("_parts", F.split(names.below(F.col("path"), increment_dir(root)), "/"))
    parts = F.col("_parts")
    number = F.regexp_extract(F.element_at(parts, -1), names.DATA_FILE, 1).try_cast("bigint")
    return split.withColumns({**_place(parts, 1, date_separator), "file_index": number}).drop("_parts")


def read_fields(
    spark: SparkSession,
    root: str,
    paths: Sequence[str],
    n_values: int,
    *,
    extra_field: bool = False,
    multiline: bool = True,
    date_separator: str = "day",
    recursive: bool = False,
) -> DataFrame:
    """Rows of change files as text, with place columns and the rule they break, if any."""
    meta = [*META, "flag"] if extra_field else list(META)
    columns = [*meta, *value_fields(n_values)]
    raw = read_csv_rows(spark, paths, columns, glob="CDC*.csv", multiline=multiline, recursive=recursive, numbered=False)
    rows = with_place(split_rows(raw, n_values, extra_field), root, date_separator)
    checked = rows.withColumn("rule", row_rule()).withColumn("commit_ts", F.col("ts_text").try_cast("bigint"))
    return number_rows(checked)


def structural_violations(fields: DataFrame) -> DataFrame:
    return fields.where("rule IS NOT NULL").select(
        *TABLE, "table_version", "path", "block_start", "row_seq", "rule",
        F.coalesce(F.col(BAD_RECORD), F.concat_ws(",", *META)).alias("record"),
    )


def typed_rows(
    fields: DataFrame,
    columns: Sequence[tuple[str, str]],
    *,
    on_error: str = "raise",
    diagnostics: str | None = None,
    **coercion,
) -> DataFrame:
    """Change rows with the typed columns in the struct ``data``, apart from the meta columns,
    so that a table may have columns named ``op`` or ``date``. Values come from ``v0..``.

    ``raise`` fails the job at the first broken row, in the same pass that reads it;
    ``quarantine`` drops broken rows here, and :func:`structural_violations` and
    :func:`value_violations` return them.
    """
    if on_error == "raise":
        record = F.col("record") if "record" in fields.columns else F.coalesce(F.col(BAD_RECORD), F.concat_ws(",", *META))
        message = F.concat(
            F.lit("change row breaks rule "), F.col("rule"), F.lit(" in "), F.col("path"),
            F.lit(" at "), F.col("row_seq").cast("string"), F.lit(": "), record,
        )
        op = F.when(F.col("rule").isNull(), F.col("op")).otherwise(F.raise_error(message).cast("string"))
        rows = fields.withColumn("op", op).where(F.col("op").isNotNull())
    else:
        # naming row_seq keeps these filters above the parsing, see number_rows
        rows = fields.where(F.col("rule").isNull() & (F.col("row_seq") >= 0))
        for i, (_, kind) in enumerate(columns):
            rows = rows.where(~is_bad_value(F.col(f"v{i}"), kind, **coercion))
    mode = "raise" if on_error == "raise" else "null"
    values = [
        coerce(F.col(f"v{i}"), kind, on_error=mode, **coercion).alias(name)
        for i, (name, kind) in enumerate(columns)
    ]
    if diagnostics is not None:
        values += source_columns(diagnostics)
    return rows.select("op", *TABLE, "commit_ts", *POSITION, F.struct(*values).alias("data"))


def source_columns(prefix: str) -> list[Column]:
    """The optional columns that say where a change came from."""
    names_ = ("commit_ts", *TABLE)
    return [F.col(n).alias(prefix + n) for n in names_]


LANDED = (*TABLE, *POSITION, "op", "commit_ts", "rule", "record", "path")
LANDED_SCHEMA = (
    "source_schema string, source_table string, table_version bigint, partition_id bigint, date string, "
    "file_index bigint, block_start bigint, row_seq bigint, op string, commit_ts bigint, rule string, "
    "record string, path string, row_values array<string>, _target string"
)


def landed_rows(fields: DataFrame, n_values: int) -> DataFrame:
    """Change rows in the one shape of the landing table: values are an array of text."""
    record = F.when(F.col("rule").isNotNull(), F.coalesce(F.col(BAD_RECORD), F.concat_ws(",", *META)))
    values = F.array(*[F.col(v) for v in value_fields(n_values)])
    return fields.withColumn("record", record).select(*LANDED, values.alias("row_values"))


def fields_of_landed(landed: DataFrame, n_values: int) -> DataFrame:
    """Back from the landing shape to one text column per value."""
    return landed.withColumns({v: F.get("row_values", F.lit(i)) for i, v in enumerate(value_fields(n_values))})


def value_violations(fields: DataFrame, columns: Sequence[tuple[str, str]], **coercion) -> DataFrame:
    """One row per unreadable value of structurally good rows."""
    found = [
        F.when(
            is_bad_value(F.col(f"v{i}"), kind, **coercion),
            F.struct(F.lit(name).alias("column_name"), F.col(f"v{i}").alias("raw_value"), F.lit(kind).alias("source_type")),
        )
        for i, (name, kind) in enumerate(columns)
    ]
    good = fields.where("rule IS NULL")
    place = [*TABLE, "table_version", "path", "block_start", "row_seq"]
    return good.select(*place, F.explode(F.array_compact(F.array(*found))).alias("b")).select(*place, "b.*")
