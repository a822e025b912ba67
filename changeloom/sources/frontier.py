"""How far each table's change log can be followed: below its first version that has files but no definition.

Definitions and change files are published apart, so an index file may be there before the definition of its
version, or be there for good when a definition is broken. Rows of later versions must not be applied before those of
this one, and a checkpoint must not pass it, else its rows would count as applied when the definition comes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..local import local_frame
from ..operators import checks
from ..operators.facts import TABLE
from . import changelog as log

Key = tuple[str, str]
VERSION = "source_schema string, source_table string, table_version bigint"


def version_folders(spark: SparkSession, root: str, scope: Sequence[Key]) -> list[tuple[str, str, int]]:
    """Versions that have a folder, one listing for each table (of its folder alone, not of what is below)."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    base = log.increment_dir(root)

    def listed(key: Key) -> list[tuple[str, str, int]]:
        where = hadoop.Path(f"{base}/{key[0]}/{key[1]}")
        fs = where.getFileSystem(conf)
        if not fs.exists(where):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
        return [(*key, int(n)) for n in found if n.isascii() and n.isdigit()]

    with ThreadPoolExecutor(max_workers=16) as pool:
        return [v for found in pool.map(listed, scope) for v in found]


def undefined_versions(
    spark: SparkSession,
    root: str,
    scope: Sequence[Key],
    definitions: Sequence[Row],
    oldest: Mapping[Key, int],
    upper: int,
    date_separator: str = "day",
) -> DataFrame:
    """Index files of visible versions that no definition in force describes; versions below ``oldest`` are past."""
    defined = {(d.source_schema, d.source_table, d.table_version) for d in definitions}
    folders = version_folders(spark, root, scope)
    asked = [v for v in folders if oldest.get(v[:2], 0) <= v[2] <= upper and v not in defined]
    if not asked:
        return local_frame(spark, [], VERSION + ", path string")
    indexes = log.read_indexes(spark, root, asked, date_separator).where("partition_id IS NOT NULL")
    known = local_frame(spark, sorted(defined), VERSION)
    return checks.missing_definitions(indexes, known).select(*TABLE, "table_version", "path")


def frontiers(undefined: DataFrame) -> dict[Key, int]:
    """Per table the first undefined version; a row for each table at most comes to the driver."""
    first = undefined.groupBy(*TABLE).agg(F.min("table_version").alias("version"))
    return {(r.source_schema, r.source_table): r.version for r in first.collect()}


def defined_until(definitions: Sequence[Row], held: Mapping[Key, int]) -> list[Row]:
    """Definitions below their table's frontier."""
    return [d for d in definitions if (v := held.get((d.source_schema, d.source_table))) is None or d.table_version < v]


def find(
    spark: SparkSession,
    root: str,
    scope: Sequence[Key],
    definitions: Sequence[Row],
    oldest: Mapping[Key, int],
    upper: int,
    strict: bool = True,
    date_separator: str = "day",
) -> dict[Key, int]:
    """The frontiers of held tables; in strict mode there must be none."""
    undefined = undefined_versions(spark, root, scope, definitions, oldest, upper, date_separator)
    if strict:
        checks.raise_if_any(undefined, "change files without a definition of their version")
        return {}
    return frontiers(undefined)
