"""File ranges beyond what the driver holds at a time."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

import changeloom as cl
from changeloom.plans import replay as rp

RANGE = (
    "source_schema string, source_table string, table_version bigint, partition_id bigint, date string, "
    "latest_file_index bigint, file_width int, data_dir string, first_file_index bigint"
)


def many_ranges(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        F.lit("depot").alias("source_schema"), F.lit("parcel").alias("source_table"), (i % 7).alias("table_version"),
        (i % 50).alias("partition_id"), F.lit("").alias("date"), F.lit(3).cast("bigint").alias("latest_file_index"),
        F.lit(6).alias("file_width"), F.concat(F.lit("/w/d"), i.cast("string")).alias("data_dir"),
        (i % 2 + 1).alias("first_file_index"),
    )


def test_the_driver_holds_a_wave_at_a_time(spark, tmp_path, monkeypatch):
    kind = type(spark.range(1))
    most, collect = [], kind.collect

    def counted(self):
        found = collect(self)
        most.append(len(found))
        return found

    monkeypatch.setattr(kind, "collect", counted)
    ranges, n = rp.bounded(spark, many_ranges(spark, 200_000), str(tmp_path / "ranges"))
    assert n == 200_000
    units, n_units = rp.bounded(spark, rp.read_units(ranges), str(tmp_path / "units"))
    seen = set()
    for wave in rp.waves(units, n_units, "path"):
        seen |= {r.path for r in wave}
    # ranges that begin with file 1 are read as folders, the others as two files each
    assert len(seen) == n_units == 100_000 + 200_000 and "/w/d0" in seen and "/w/d1/CDC000003.csv" in seen
    assert max(most) <= 1.2 * rp.WAVE


def test_few_ranges_stay_local(spark, tmp_path):
    ranges, n = rp.bounded(spark, many_ranges(spark, 20), str(tmp_path / "ranges"))
    assert n == 20 and not (tmp_path / "ranges").exists() and ranges.schema == many_ranges(spark, 1).schema


def test_large_folders_are_read_by_file(spark, monkeypatch):
    monkeypatch.setattr(rp, "FOLDER_FILES", 2)
    paths = {r.path for r in rp.read_units(many_ranges(spark, 1)).collect()}
    assert paths == {f"/w/d0/CDC00000{i}.csv" for i in (1, 2, 3)}


@pytest.mark.parametrize("wave", [2, 5_000])
@pytest.mark.parametrize("strict", [True, False])
def test_waves_change_nothing(spark, workspace, out, monkeypatch, wave, strict):
    monkeypatch.setattr(rp, "WAVE", wave)
    workspace.snapshot("parcel", 100, _1="place,label\n1,a\n2,b\n").definition(90).checkpoint(900)
    for part in range(4):
        for day in (11, 12):
            ts = 200 + 100 * (day - 11) + part
            files = [f"U,parcel,depot,{ts},{10 * part + day},d{day}\n", f"I,parcel,depot,{ts},{100 + 10 * part + day},e\n"]
            workspace.changes(90, *files, sub=f"{part}/2031-03-{day}")
    options = {"strict": strict, "commit_order": "stream"}
    first = cl.replay(spark, str(workspace), out, **options)
    expected = [(1, "a"), (2, "b")] + [(10 * p + d, f"d{d}") for p in range(4) for d in (11, 12)]
    expected += [(100 + 10 * p + d, "e") for p in range(4) for d in (11, 12)]
    assert first.skipped is None and rows(cl.StateStore(spark, out).read("depot_parcel")) == sorted(expected, key=repr)
    streams = cl.StateStore(spark, out).streams().collect()
    assert len(streams) == 4 and {r.last_file_index for r in streams} == {2}

    workspace.checkpoint(1900)
    for part in range(3):  # a third file in each of three folders, read by itself
        workspace.put(f"increment/depot/parcel/90/{part}/2031-03-12/CDC000003.csv", f"D,parcel,depot,{1000 + part},1\n".replace(",1\n", ",1,\n"))
        workspace.put(f"increment/depot/parcel/90/{part}/2031-03-12/meta/CDC.index", "CDC000003.csv\n")
    cl.replay(spark, str(workspace), out, **options)
    assert rows(cl.StateStore(spark, out).read("depot_parcel")) == sorted(expected[1:], key=repr)
    assert cl.replay(spark, str(workspace), out, **options).skipped == "nothing is new"


def test_an_absent_file_among_waves(spark, workspace, out, monkeypatch):
    monkeypatch.setattr(rp, "WAVE", 1)
    workspace.snapshot("parcel", 100, _1="place,label\n1,a\n").definition(90).checkpoint(900)
    for part in range(3):
        files = [f"I,parcel,depot,{200 + k},{10 * part + k},x\n" for k in range(2, 5)]
        workspace.changes(90, *files, sub=str(part))
    (workspace.root / "increment/depot/parcel/90/1/CDC000002.csv").unlink()
    with pytest.raises(rp.checks.InputError, match="missing"):
        cl.replay(spark, str(workspace), out, commit_order="stream")
    cl.replay(spark, str(workspace), out, strict=False, commit_order="stream")
    places = [r[0] for r in rows(cl.StateStore(spark, out).read("depot_parcel"))]
    assert sorted(places) == [1, 2, 3, 4, 12, 22, 23, 24]
