"""CSV files read by byte ranges against the reader that takes a file as one task."""

from __future__ import annotations

import csv
import io
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeloom.sources import csv_ranges, files

PIECE = st.sampled_from(['"', '""', "a", ",", "\n", "\r\n", "é", " ", '"x', 'y"', '","', '"\n"', "bc"])


def automaton(line: str, inside: bool) -> bool:
    """Whether a line that begins inside (or outside) of a quoted value ends inside of one, character by character."""
    state = "quoted" if inside else "start"
    for c in line:
        if state == "start":
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
        elif state == "plain":
            state = "start" if c == "," else "plain"
        elif state == "quoted":
            state = "closed" if c == '"' else "quoted"
        else:
            state = "quoted" if c == '"' else "start" if c == "," else "plain"
    return state == "quoted"


def test_lines_change_states_as_an_automaton_does(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(['"', '"', "a", ",", " ", "\r"]) for _ in range(rng.randrange(0, 9))) for _ in range(3000)]
    texts += ['"' + 'a""' * 50_000, 'x,"' * 50_000, '"a",' * 50_000]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    for r in df.select("value", F.col("value").rlike(csv_ranges.OPENS).alias("o"), F.col("value").rlike(csv_ranges.STAYS).alias("s")).collect():
        assert (r.o, r.s) == (automaton(r.value, False), automaton(r.value, True)), r.value[:40]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=20), st.booleans())
def test_states(functions, inside):
    opens, stays = (np.array([f[k] for f in functions], bool) for k in (0, 1))
    expected = [inside]
    for o, s in functions:
        expected.append(s if expected[-1] else o)
    assert csv_ranges.states(opens, stays, inside).tolist() == expected


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "37")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read_both(spark, path, columns):
    whole = spark.read.schema(files.csv_schema(columns)).options(**files.csv_options(len(columns), True)).csv(path)
    whole = whole.withColumns(files.clean_fields(columns)).select(*columns, files.BAD_RECORD)
    split = files.read_csv_rows(spark, [path], columns)
    return rows(whole), split


def written(records, end, ended):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(records)
    return out.getvalue() if ended else out.getvalue().removesuffix(end)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_in_the_same_order(spark, tmp_path, small_ranges, end):
    rng = random.Random(11)
    parts = ["a", "bc", '"', ",", "\n", "\r\n", "é", " ", "1"]
    for n in range(4):
        records = [[str(i), *("".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 9, 60 if n else 3]))) for _ in "xy")] for i in range(40)]
        (tmp_path / f"f{n}.csv").write_text(written(records, end, n % 2), newline="")
    (tmp_path / "small.csv").write_text("7,a,b\n", newline="")
    columns = ["n", "x", "y"]
    whole, split = read_both(spark, str(tmp_path), columns)
    assert rows(split.select(*columns, files.BAD_RECORD)) == whole and len(whole) == 161
    found = split.collect()
    assert len({(r.path, r.block_start) for r in found}) > 40
    for path in {r.path for r in found}:
        mine = sorted((r for r in found if r.path == path), key=lambda r: (r.block_start, r.row_seq))
        assert [int(r.n) for r in mine] == sorted(int(r.n) for r in mine)


@settings(max_examples=12, deadline=None)
@given(st.lists(PIECE, min_size=30, max_size=90))
def test_any_text(spark, tmp_path_factory, pieces):
    """Also texts that no CSV writer makes; what follows the first quote that isn't closed is one record in both."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "23")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        text = "".join(pieces)
        if sum(map(len, pieces)) > 40:
            line, inside = "", False
            for line in text.split("\n"):
                inside = automaton(line, inside)
            text += '"\n' if inside else ""
        path = tmp_path_factory.mktemp("any") / "f.csv"
        path.write_text(text, newline="")
        whole, split = read_both(spark, str(path), ["x", "y"])
        assert rows(split.select("x", "y", files.BAD_RECORD)) == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_large_file_has_many_tasks(spark, tmp_path):
    record = 'I,"line one\nline ""two"", end",' + "x" * 200 + "\n"
    (tmp_path / "big.csv").write_text(record * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        split = files.read_csv_rows(spark, [str(tmp_path / "big.csv")], ["a", "b", "c"])
        assert split.count() == 20_000
        per_task = split.where("length(b) = 24").groupBy(F.shiftright("row_seq", 33).alias("task")).count().collect()
        assert sum(r["count"] for r in per_task) == 20_000 and len(per_task) >= 9 and max(r["count"] for r in per_task) < 4_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_range_that_was_not_seen_fails():
    with pytest.raises(RuntimeError, match="run again"):
        csv_ranges._Known([])((1, 2))
