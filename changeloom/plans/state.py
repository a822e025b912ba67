"""State and progress tables, versioned by run.

``<out>/runs/<run>/`` holds what one run left behind: ``tables.json`` (one line per table: its
progress, its columns, and which run's directory holds each of its buckets) and ``streams``
(progress per stream, Parquet). A run is in force once its ``_DONE`` file exists, which is
written last; the newest such run is the current one. A run that died half-way left no
``_DONE``, so the next run takes its number and overwrites its files.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..local import local_frame
from ..operators.progress import STREAM_PROGRESS, TABLE_PROGRESS
from ..sources.files import path_exists

TABLES_SCHEMA = (
    TABLE_PROGRESS + ", target_table string, schema_json string, checkpoint bigint, batch_id bigint, "
    "n_buckets int, buckets array<struct<run:bigint,ids:array<int>>>"
)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    where = _path(spark, path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def get_text(spark: SparkSession, path: str) -> str:
    where = _path(spark, path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


class TableState:
    """Progress of one table and where its rows are."""

    def __init__(self, row: dict):
        self.__dict__.update(row)
        self.in_force = {b: part["run"] for part in row["buckets"] for b in part["ids"]}

    @property
    def key(self) -> tuple[str, str]:
        return self.source_schema, self.source_table

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_json))


def table_row(in_force: dict[int, int], **fields) -> dict:
    """A line of ``tables.json``; buckets are grouped by the run that wrote them."""
    by_run = defaultdict(list)
    for bucket, run in in_force.items():
        by_run[run].append(bucket)
    return {**fields, "buckets": [{"run": r, "ids": sorted(ids)} for r, ids in sorted(by_run.items())]}


# version of what tables.json and the stream progress look like
FORMAT = 1


class StateStore:
    """Where a replay keeps its results. ``buckets`` only counts when the store is new."""

    def __init__(self, spark: SparkSession, out: str, buckets: int = 64):
        self.spark, self.out, self.n_buckets = spark, out.rstrip("/"), buckets

    def latest_run(self) -> int:
        """Number of the newest finished run, 0 when there is none."""
        root = _path(self.spark, f"{self.out}/runs")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return 0
        numbers = sorted((int(s.getPath().getName()) for s in fs.listStatus(root)), reverse=True)
        return next((n for n in numbers if fs.exists(_path(self.spark, f"{self.out}/runs/{n}/_DONE"))), 0)

    def table_states(self, run: int | None = None) -> dict[tuple[str, str], TableState]:
        run = self.latest_run() if run is None else run
        if run == 0:
            return {}
        lines = get_text(self.spark, f"{self.out}/runs/{run}/tables.json").splitlines()
        saved = [json.loads(line) for line in lines]
        other = {line.pop("format", 1) for line in saved} - {FORMAT}
        if other:
            raise ValueError(f"the progress of run {run} in {self.out} has format {sorted(other)}, this library reads {FORMAT}")
        found = [TableState(line) for line in saved]
        if found:
            self.n_buckets = found[0].n_buckets
        return {t.key: t for t in found}

    def tables(self, run: int | None = None) -> DataFrame:
        """Progress per table as a DataFrame."""
        names = T._parse_datatype_string(TABLES_SCHEMA).fieldNames()
        rows = [tuple(getattr(t, n) for n in names) for t in self.table_states(run).values()]
        return local_frame(self.spark, rows, TABLES_SCHEMA)

    def streams(self, run: int | None = None) -> DataFrame:
        run = self.latest_run() if run is None else run
        path = f"{self.out}/runs/{run}/streams"
        if run == 0 or not path_exists(self.spark, path):
            return local_frame(self.spark, [], STREAM_PROGRESS)
        return self.spark.read.schema(STREAM_PROGRESS).parquet(path)

    def data_dir(self, target: str, run: int) -> str:
        return f"{self.out}/state/{target}/{run}"

    def bucket_of(self, keys: Sequence[str]):
        # hashed as text: the bucket of a key must not move when its column is widened
        texts = [F.col(f"`{k}`").cast("string") for k in keys]
        return F.pmod(F.xxhash64(*texts), F.lit(self.n_buckets)).cast("int")

    def read_buckets(self, target: str, schema: T.StructType, in_force: Sequence[tuple[int, int]]) -> DataFrame:
        """Rows of the given ``(bucket, run)`` directories; columns that are newer than a
        directory come back as NULL."""
        paths = [f"{self.data_dir(target, run)}/_bucket={bucket}" for bucket, run in in_force]
        if not paths:
            return local_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def write_buckets(self, rows: DataFrame, target: str, run: int, keys: Sequence[str]) -> set[int]:
        """Write state rows by bucket; returns the buckets that now have a directory.

        The rebalance keeps one bucket's rows together but lets AQE split a bucket that is too
        large for one task and merge small ones.
        """
        path = self.data_dir(target, run)
        shaped = rows.withColumn("_bucket", self.bucket_of(keys)).hint("rebalance", "_bucket")
        shaped.write.mode("overwrite").partitionBy("_bucket").parquet(path)
        return self.bucket_dirs(path)

    def bucket_dirs(self, path: str) -> set[int]:
        root = _path(self.spark, path)
        listed = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(root)
        found = [s.getPath().getName() for s in listed]
        return {int(n.split("=")[1]) for n in found if n.startswith("_bucket=")}

    def finish(self, run: int, tables: Sequence[dict], streams: DataFrame | None) -> None:
        """Write what the run left and put it in force; without ``streams`` those stay empty."""
        base = f"{self.out}/runs/{run}"
        lines = [json.dumps({**t, "n_buckets": self.n_buckets, "format": FORMAT}) for t in tables]
        put_text(self.spark, f"{base}/tables.json", "\n".join(lines))
        if streams is not None:
            streams.write.mode("overwrite").parquet(f"{base}/streams")
        put_text(self.spark, f"{base}/_DONE", "")

    def read(self, target: str, run: int | None = None) -> DataFrame:
        """Current rows of one output table."""
        found = [t for t in self.table_states(run).values() if t.target_table == target]
        if not found:
            raise KeyError(f"no state for {target!r} in {self.out}")
        return self.read_buckets(target, found[0].schema, sorted(found[0].in_force.items()))


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """One type for a column whose declared type changed between versions."""
    kinds = list(dict.fromkeys(kinds))
    if len(kinds) == 1:
        return kinds[0]
    whole = [T.ShortType(), T.IntegerType(), T.LongType()]
    if all(k in whole for k in kinds):
        return max(kinds, key=whole.index)
    digits = {T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
    sized = [
        (k.precision - k.scale, k.scale) if isinstance(k, T.DecimalType) else (digits[k], 0)
        for k in kinds
        if isinstance(k, T.DecimalType) or k in digits
    ]
    if len(sized) == len(kinds):
        before, after = max(s[0] for s in sized), max(s[1] for s in sized)
        return T.DecimalType(before + after, after) if before + after <= 38 else T.StringType()
    if all(k in (T.FloatType(), T.DoubleType(), *digits) for k in kinds):
        return T.DoubleType()
    return T.StringType()
