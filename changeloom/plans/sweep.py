"""Removal of what no run in force needs any more.

Marked are the last ``keep`` finished runs, the bucket folders that their tables point to, and of a stream the landed
batches that hold a file which is not applied as a whole. Everything else below ``state``, ``delta``, ``landing``,
``landed_files`` and ``runs`` up to the newest finished run goes; a run in progress has a higher number and is left
alone, and so is ``quarantine``.

An old run loses its ``_DONE`` first, so that it can't be taken for a finished one while its folders go; a sweep
that is interrupted is finished by the next. A reader that took its paths from a run has ``keep - 1`` further runs to finish in.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.apply import STREAM
from ..operators.facts import TABLE, attach_facts
from ..sources import changelog as log
from ..sources.files import path_exists
from .state import StateStore


class _Folder:
    """Folders of a store: their names, and their removal."""

    def __init__(self, spark: SparkSession, base: str):
        self.path, self.conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        self.base = base
        self.removed: list[str] = []

    def _at(self, name: str):
        where = self.path(f"{self.base}/{name}")
        return where, where.getFileSystem(self.conf)

    def names(self, name: str) -> list[str]:
        where, fs = self._at(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def has(self, name: str) -> bool:
        where, fs = self._at(name)
        return bool(fs.exists(where))

    def remove(self, name: str) -> None:
        where, fs = self._at(name)
        fs.delete(where, True)
        self.removed.append(name)


def _numbers(names: list[str], prefix: str = "") -> dict[int, str]:
    found = ((re.fullmatch(re.escape(prefix) + r"(\d+)", n), n) for n in names)
    return {int(m[1]): n for m, n in found if m}


def applied_batches(spark: SparkSession, store: StateStore, landed: DataFrame, root: str) -> set[int]:
    """Landed batches whose files are all behind their stream's progress, or in versions that are past."""
    streams = store.streams().select(*STREAM, "last_date", "last_file_index")
    marks = store.tables().select(*TABLE, "ddl_watermark")
    files = attach_facts(log.with_place(landed, root), streams, STREAM)
    files = attach_facts(files, marks, TABLE)
    behind = (F.col("date") < F.col("last_date")) | (
        (F.col("date") == F.col("last_date")) & (F.col("file_index") <= F.col("last_file_index"))
    )
    past = F.col("last_date").isNull() & (F.col("table_version") < F.col("ddl_watermark"))
    done = F.coalesce(behind, past, F.lit(False))
    return {r.batch_id for r in files.groupBy("batch_id").agg(F.bool_and(done).alias("done")).where("done").collect()}


def sweep(spark: SparkSession, out: str, keep: int = 2, root: str | None = None, landed: DataFrame | None = None) -> list[str]:
    """Remove what the last ``keep`` finished runs don't need; returns the names of removed folders.

    With ``landed`` (the files that a stream has landed from the workspace at ``root``) applied batches go too, but for
    the newest, which says what was applied.
    """
    if keep < 1:
        raise ValueError("at least the newest run must be kept")
    store, folder = StateStore(spark, out), _Folder(spark, out.rstrip("/"))
    runs = _numbers(folder.names("runs"))
    finished = sorted((n for n in runs if folder.has(f"runs/{runs[n]}/_DONE")), reverse=True)
    if not finished:
        return []
    newest, kept = finished[0], set(finished[:keep])
    needed: dict[str, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
    for run in kept:
        for table in store.table_states(run).values():
            for bucket, written_by in table.in_force.items():
                needed[table.target_table][written_by].add(bucket)

    old = [n for n in sorted(runs) if n <= newest and n not in kept]
    for n in old:
        if n in finished:
            folder.remove(f"runs/{runs[n]}/_DONE")
    for target in folder.names("state"):
        for n, name in _numbers(folder.names(f"state/{target}")).items():
            if n > newest:
                continue
            buckets = needed[target][n]
            if not buckets:
                folder.remove(f"state/{target}/{name}")
                continue
            for b, part in _numbers(folder.names(f"state/{target}/{name}"), "_bucket=").items():
                if b not in buckets:
                    folder.remove(f"state/{target}/{name}/{part}")
    for target in folder.names("delta"):
        for n, name in _numbers(folder.names(f"delta/{target}")).items():
            if n <= newest and n not in kept:
                folder.remove(f"delta/{target}/{name}")
    for n, name in _numbers(folder.names("landing"), "run-").items():
        if n <= newest and n not in kept:
            folder.remove(f"landing/{name}")
    if landed is not None and root is not None and path_exists(spark, f"{folder.base}/landed_files"):
        applied = applied_batches(spark, store, landed, root)
        last = max(_numbers(folder.names("landed_files"), "batch-"), default=-1)
        for batch in sorted(applied - {last}):
            folder.remove(f"landing/batch-{batch}")
            folder.remove(f"landed_files/batch-{batch}")
    for n in old:
        folder.remove(f"runs/{runs[n]}")
    return folder.removed
