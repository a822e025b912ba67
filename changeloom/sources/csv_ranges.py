"""Records of large CSV files, read by byte ranges although values may hold line breaks.

Spark's text source splits a file into ranges and gives whole lines, but a line may begin inside a quoted value. What
a line does to that is a function on two states (outside, inside): lines without quotes change nothing, others are
matched by patterns that go through their fields, so that a quote in the middle of an unquoted value counts for
nothing. The functions of a range's lines are composed in one narrow pass; a prefix over the ranges of a file
(one row for each) gives the state each range begins in. A second pass then knows where records begin, joins the
lines of each, and hands the parts of a record that lies across ranges to a grouping of their own: two parts for
each range at most, and one row for the record, as large as it is.

Ranges must be the same in both passes, which they are while the files and the number of cores stay the same; a range
that the first pass hasn't seen fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import literal_path

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+'
#: lines that begin outside of a value and end inside of one
OPENS = rf'\A{_FIELDS}"{_INSIDE}\z'
#: lines that begin inside of a value and end inside of that or another one
STAYS = rf'\A{_INSIDE}(?:"[^,]*+,{_FIELDS}"{_INSIDE})?+\z'

RANGE = ("file", "block_start")
_COMPOSED = "file bigint, block_start bigint, from_outside boolean, from_inside boolean"
_PARTS = "file bigint, block_start bigint, path string, record string, head boolean, open boolean"


def range_bytes(spark: SparkSession) -> int:
    """Files larger than this are split."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def lines_of(
    spark: SparkSession, roots: Sequence[str], path: Column, glob: str | None, recursive: bool, larger_than: int
) -> DataFrame:
    """Lines of files of more than so many bytes, with their range and what they do to the two states."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text([literal_path(r) for r in roots]).where(F.col("_metadata.file_size") > larger_than)
    quoted = F.contains("value", F.lit('"'))
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        path.alias("path"),
        "value",
        F.when(quoted, F.col("value").rlike(OPENS)).otherwise(False).alias("opens"),
        F.when(quoted, F.col("value").rlike(STAYS)).otherwise(True).alias("stays"),
    )


def states(opens: np.ndarray, stays: np.ndarray, inside: bool) -> np.ndarray:
    """State before each line and after the last one: the lines' functions composed from the given state."""
    n = len(opens)
    fixed, swaps = opens == stays, opens & ~stays
    # the last line before that fixes the state, and how often it was swapped since
    last = np.maximum.accumulate(np.concatenate(([-1], np.where(fixed, np.arange(n), -1))))
    swapped = np.concatenate(([0], np.cumsum(swaps)))
    began = np.where(last < 0, inside, opens[np.maximum(last, 0)] if n else inside)
    since = swapped - np.where(last < 0, 0, swapped[np.maximum(last, 0) + 1] if n else 0)
    return began ^ (since % 2 == 1)


def _cuts(file: np.ndarray, start: np.ndarray) -> list[tuple[int, int]]:
    """Where the rows of one range lie in a batch."""
    change = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    edges = [0, *change.tolist(), len(file)]
    return list(zip(edges, edges[1:]))


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: the function of each range."""
    names = ["file", "block_start", "from_outside", "from_inside"]
    now, function = None, (False, True)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, *map(bool, function))], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, opens, stays = (_column(batch, c) for c in ("file", "block_start", "opens", "stays"))
        for a, b in _cuts(file, start):
            key = (int(file[a]), int(start[a]))
            if key != now:
                if now is not None:
                    yield row()
                now, function = key, (False, True)
            function = tuple(states(opens[a:b], stays[a:b], bool(x))[-1] for x in function)
    if now is not None:
        yield row()


def range_states(lines: DataFrame) -> DataFrame:
    """The state in which each range begins: a prefix over the ranges' functions, file by file."""
    ranges = lines.select(*RANGE, "opens", "stays").mapInArrow(_compose, _COMPOSED)
    # the last earlier range whose end doesn't depend on its beginning, and the swaps since
    before = W.partitionBy("file").orderBy("block_start").rowsBetween(W.unboundedPreceding, -1)
    fixed = F.col("from_outside") == F.col("from_inside")
    swap = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    upto = W.partitionBy("file").orderBy("block_start").rowsBetween(W.unboundedPreceding, 0)
    ranges = ranges.withColumn("swaps", F.sum(swap).over(upto))
    last = F.max(F.when(fixed, F.struct("block_start", "from_outside", "swaps"))).over(before)
    ranges = ranges.withColumn("last", last).withColumn("earlier", F.coalesce(F.sum(swap).over(before), F.lit(0)))
    since = F.col("earlier") - F.coalesce("last.swaps", F.lit(0))
    began = F.coalesce("last.from_outside", F.lit(False))
    return ranges.select(*RANGE, (began != (since % 2 == 1)).alias("inside"))


class _Known:
    """The ranges' states, found by file and start."""

    def __init__(self, rows: Sequence):
        self.of = {(r["file"], r["block_start"]): r["inside"] for r in rows}

    def __call__(self, key: tuple[int, int]) -> bool:
        if key not in self.of:
            raise RuntimeError("a file was split otherwise than when its quotes were read; run again")
        return self.of[key]


def _assemble(known):
    """Task code: records, and the parts of those that lie across ranges (``head``: it began before; ``open``: goes on)."""
    schema = pa.schema(
        [("file", pa.int64()), ("block_start", pa.int64()), ("path", pa.string()), ("record", pa.string())]
        + [("head", pa.bool_()), ("open", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, path, inside, held, head = None, None, False, [], False

        def rows(records, heads, opens) -> pa.RecordBatch:
            n = len(records)
            columns = [pa.repeat(pa.scalar(now[0], pa.int64()), n), pa.repeat(pa.scalar(now[1], pa.int64()), n)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.repeat(pa.scalar(path, pa.string()), n), pa.array(records, pa.string()), heads, opens], schema=schema
            )

        def last() -> pa.RecordBatch:
            return rows(["\n".join(held)], pa.array([head]), pa.array([bool(inside)]))

        for batch in batches:
            if not batch.num_rows:
                continue
            file, start, opens, stays = (_column(batch, c) for c in ("file", "block_start", "opens", "stays"))
            for a, b in _cuts(file, start):
                key = (int(file[a]), int(start[a]))
                if key != now:
                    if held:
                        yield last()
                    now, path, inside, held = key, batch.column("path")[a].as_py(), known.value(key), []
                    head = inside
                state = states(opens[a:b], stays[a:b], inside)
                value = batch.column("value").slice(a, b - a)
                begins = np.flatnonzero(~state[:-1])
                if not len(begins):
                    held += value.to_pylist()
                    inside = bool(state[-1])
                    continue
                held += value.slice(0, begins[0]).to_pylist()
                if held:
                    inside = False
                    yield last()
                # the last record of the batch may go on in the next one
                whole, ends = begins[:-1], begins[1:]
                single = ends - whole == 1
                records = value.take(pa.array(whole))
                if not single.all():
                    joined = ["\n".join(value.slice(x, y - x).to_pylist()) for x, y in zip(whole[~single].tolist(), ends[~single].tolist())]
                    records = pc.replace_with_mask(records, pa.array(~single), pa.array(joined, records.type))
                if len(whole):
                    none = pa.repeat(pa.scalar(False), len(whole))
                    yield rows(records, none, none)
                held, head, inside = value.slice(begins[-1]).to_pylist(), False, bool(state[-1])
        if held:
            yield last()

    return run


def records(lines: DataFrame, known: DataFrame) -> DataFrame:
    """``path, block_start, record`` of all records; those across ranges come after the others of their first range."""
    spark = lines.sparkSession
    # one small row for each range
    found = spark.sparkContext.broadcast(_Known(known.collect()))
    parts = lines.mapInArrow(_assemble(found), _PARTS)
    alone = ~F.col("head") & ~F.col("open")
    whole = parts.where(alone).select("path", "block_start", "record")
    across = parts.where(~alone)
    upto = W.partitionBy("file").orderBy("block_start", F.desc("head")).rowsBetween(W.unboundedPreceding, 0)
    across = across.withColumn("nth", F.sum((~F.col("head")).cast("int")).over(upto))
    listed = F.array_sort(F.collect_list(F.struct("block_start", "record")))
    joined = across.groupBy("file", "nth").agg(F.first("path").alias("path"), listed.alias("parts"))
    joined = joined.select("path", F.col("parts")[0]["block_start"].alias("block_start"), F.array_join("parts.record", "\n").alias("record"))
    return whole.unionByName(joined).where("record <> ''")
