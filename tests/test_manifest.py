"""What a stream has landed, kept as runs of file numbers."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import rows

import changeloom as cl
from changeloom.plans.replay import load_snapshot
from changeloom.streaming import apply_landed, follow, manifest

PLACE = ("depot", "parcel", 90, 0, "2031-03-11")
FILES = "source_schema string, source_table string, table_version bigint, partition_id bigint, date string, file_index bigint"
INDEX = FILES.replace("file_index", "first_file_index") + ", latest_file_index bigint"


def files(spark, numbers, place=PLACE):
    return spark.createDataFrame([(*place, n) for n in numbers], FILES)


def runs(spark, store):
    return [(r.date, r.first_file_index, r.last_file_index) for r in manifest.read(spark, store).orderBy("date", "first_file_index").collect()]


def test_runs_grow_together(spark, out):
    store = cl.StateStore(spark, out)
    assert manifest.read(spark, store) is None
    manifest.add(spark, store, files(spark, [1, 2, 5]), 0)
    assert [r[1:] for r in runs(spark, store)] == [(1, 2), (5, 5)]
    manifest.add(spark, store, files(spark, [3, 4, 4, 9]), 1)
    assert [r[1:] for r in runs(spark, store)] == [(1, 5), (9, 9)]
    # a repeated batch is made of the snapshot before it
    manifest.add(spark, store, files(spark, [3]), 1)
    assert [r[1:] for r in runs(spark, store)] == [(1, 3), (5, 5)]
    manifest.add(spark, store, files(spark, []), 2)
    assert [r[1:] for r in runs(spark, store)] == [(1, 3), (5, 5)]


def test_what_a_trigger_reads_does_not_grow_with_the_batches(spark, out):
    store = cl.StateStore(spark, out)
    for n in range(12):
        manifest.add(spark, store, files(spark, range(100 * n + 1, 100 * n + 101)), n)
        assert [r[1:] for r in runs(spark, store)] == [(1, 100 * n + 100)]
    assert len(list(Path(out, "landed_ranges").iterdir())) == manifest.KEPT


def test_a_snapshot_that_was_not_finished_is_passed_over(spark, out):
    store = cl.StateStore(spark, out)
    manifest.add(spark, store, files(spark, [1]), 0)
    manifest.add(spark, store, files(spark, [2]), 1)
    Path(out, "landed_ranges", "batch-1", "_SUCCESS").unlink()
    assert [r[1:] for r in runs(spark, store)] == [(1, 1)]
    manifest.add(spark, store, files(spark, [2]), 1)
    assert [r[1:] for r in runs(spark, store)] == [(1, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_ranges_against_plain_sets(spark, seed):
    draw = random.Random(seed)
    days = [(*PLACE[:3], p, d) for p in (0, 7) for d in ("", "2031-03-11")]
    landed = {day: {draw.randrange(1, 40) for _ in range(30)} for day in days[:3]}
    data = [(*day, n, n) for day, ns in landed.items() for n in ns]
    found = manifest.merged(spark.createDataFrame(data, manifest.RANGES))
    for day, ns in landed.items():
        mine = [r for r in found.collect() if (*PLACE[:3], r.partition_id, r.date) == day]
        assert {n for r in mine for n in range(r.first_file_index, r.last_file_index + 1)} == ns
        assert len(mine) == sum(n - 1 not in ns for n in ns)
    wanted = [(*day, a, a + draw.randrange(-1, 4)) for day in days for a in range(1, 38, 3)]
    behind = {r for r in wanted if any(n not in landed.get(r[:5], ()) for n in range(r[5], r[6] + 1))}
    index = spark.createDataFrame(wanted, INDEX)
    assert {tuple(r) for r in manifest.not_landed(index, found).collect()} == behind


def change(n):
    return f"U,parcel,depot,{1000 + n},1,v{n}\n"


def test_a_stream_waits_for_a_gap_and_then_applies(spark, workspace, out, tmp_path):
    base = "increment/depot/parcel/90/2031-03-11"
    workspace.snapshot("parcel", 100, _1="place,label\n1,s\n").definition(90).checkpoint(1004)
    for n in (1, 2, 4):
        workspace.put(f"{base}/CDC{n:06d}.csv", change(n))
    workspace.put(f"{base}/meta/CDC.index", "CDC000004.csv\n")

    def run():
        follow(spark, str(workspace), out, str(tmp_path / "check"), buckets=2, max_files=1).awaitTermination()

    store = cl.StateStore(spark, out)
    load_snapshot(spark, str(workspace), store, cl.Options())
    run()
    assert [r[1:] for r in runs(spark, store)] == [(1, 2), (4, 4)]
    assert rows(store.read("depot_parcel")) == [(1, "s")]
    assert apply_landed(spark, str(workspace), store, cl.Options()).skipped == "landing is behind the index"
    workspace.put(f"{base}/CDC000003.csv", change(3))
    run()
    assert [r[1:] for r in runs(spark, store)] == [(1, 4)]
    assert rows(store.read("depot_parcel")) == [(1, "v4")]


def test_days_that_are_past_leave_the_manifest(spark, workspace, out, tmp_path):
    workspace.snapshot("parcel", 100, _1="place,label\n1,s\n").definition(90)
    for n, day in enumerate(("2031-03-11", "2031-03-12", "2031-03-13"), 1):
        base = f"increment/depot/parcel/90/{day}"
        workspace.put(f"{base}/CDC000001.csv", change(n)).put(f"{base}/meta/CDC.index", "CDC000001.csv\n").checkpoint(1000 + n)
        follow(spark, str(workspace), out, str(tmp_path / "check"), buckets=2).awaitTermination()
    store = cl.StateStore(spark, out)
    assert rows(store.read("depot_parcel")) == [(1, "v3")]
    assert [d for d, *_ in runs(spark, store)] == ["2031-03-12", "2031-03-13"]
