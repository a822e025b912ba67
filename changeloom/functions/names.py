"""Names and paths as ``Column`` expressions: table filters, output names, file order, layouts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: layout of the change-log workspace -----------------------------------
SCHEMA_FILE = r"^([^/]+)/([^/]+)/meta/schema_(\d+)_(\d+)\.json$"
INDEX_FILE = r"^[^/]+/[^/]+/[^/]+/(?:[^/]+/)*meta/CDC(?:_([^./]+))?\.index$"
DATA_FILE = r"^CDC(\d+)\.csv$"
WRITER_DATA_FILE = r"^CDC_(.+)_(\d+)\.csv$"
DATE_DIR = r"^\d{4}(-\d{2}){0,2}$"
SCHEMA_SUFFIX = "-schema.sql"
SCHEMA_CREATE_SUFFIX = "-schema-create.sql"


def percent_decode(text: Column) -> Column:
    """Decode ``%xx``; ``+`` stays a plus, and text that is no valid encoding stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def plain_path(path: Column) -> Column:
    """Path without scheme and authority, for comparing paths from different sources."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?(?=/)", "")


def plain_path_of(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?(?=/)", "", path).rstrip("/")


def below(path: Column, root: str) -> Column:
    """Part of a plain path below ``root`` (NULL when the path is elsewhere)."""
    prefix = plain_path_of(root) + "/"
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1)))


def stem_schema(stem: Column) -> Column:
    return F.when(stem.contains("."), percent_decode(F.substring_index(stem, ".", 1)))


def stem_table(stem: Column) -> Column:
    return F.when(stem.contains("."), percent_decode(F.regexp_extract(stem, r"(?s)^[^.]*\.(.*)$", 1)))


def target_table(schema: Column, table: Column) -> Column:
    """Output table name: letters, digits and underscores only, no underscore at either end."""
    joined = F.concat_ws("_", schema, table)
    return F.btrim(F.regexp_replace(joined, r"[^0-9A-Za-z_]+", "_"), F.lit("_"))


def glob_regex(pattern: str) -> str:
    """Regular expression of a case-sensitive shell pattern (``*``, ``?``, ``[ab]``, ``[!ab]``)."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        end = pattern.find("]", i + 3 if pattern[i + 1 : i + 2] == "!" else i + 2)
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[" and end > 0:
            body = pattern[i + 1 : end]
            negated = body.startswith("!")
            body = re.sub(r"([\\\[\]^&])", r"\\\1", body[1:] if negated else body)
            out.append("[" + ("^" if negated else "") + body + "]")
            i = end
        else:
            out.append(re.sub(r"([^0-9A-Za-z_])", r"\\\1", ch))
        i += 1
    return "(?s)^" + "".join(out) + r"\z"


def table_selected(schema: Column, table: Column, rules: Sequence[str]) -> Column:
    """Include/exclude rules on ``schema.table``.

    A matching ``!rule`` always rejects. Otherwise one plain rule must match; when there are
    only ``!`` rules, everything they do not reject is taken.
    """
    rules = [r.strip() for r in rules if r.strip()]
    if not rules:
        return F.lit(True)
    key = F.concat_ws(".", schema, table)
    plus = [key.rlike(glob_regex(r)) for r in rules if not r.startswith("!")]
    minus = [key.rlike(glob_regex(r[1:])) for r in rules if r.startswith("!")]
    keep = F.lit(not plus)
    for hit in plus:
        keep = keep | hit
    for hit in minus:
        keep = keep & ~hit
    return keep


def natural_order(name: Column) -> Column:
    """Sort text in which runs of digits, however long, compare as numbers (``x.2`` before ``x.10``).

    A run is written without leading zeros behind its number of digits.
    """
    parts = F.regexp_extract_all(name, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))

    def numbered(run: Column) -> Column:
        digits = F.regexp_replace(run, "^0+(?=[0-9])", "")
        return F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), F.lit(":"), digits)

    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]+$"), numbered(p)).otherwise(p)), "")


def literal_path(path: str) -> str:
    """A path for Spark's readers, which take some characters for patterns."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)
