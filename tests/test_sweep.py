"""Removal of what no kept run needs."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from conftest import rows

import changeloom as cl
from changeloom.plans import sweep as sw
from changeloom.plans.sweep import sweep
from changeloom.streaming import follow
from changeloom.streaming.follow import landed_files


def state(spark, out, run=None):
    return rows(cl.StateStore(spark, out).read("depot_parcel", run))


def step(workspace, n, new=2):
    """One more change file, with an update of row 1 and new rows that come and go."""
    text = f"U,parcel,depot,{1000 + n},1,v{n}\n" + "".join(f"I,parcel,depot,{1000 + n},{10 + k},x{n}\n" for k in range(new))
    name = f"increment/depot/parcel/90/2031-03-11/CDC{n:06d}.csv"
    workspace.put(name, text).put("increment/depot/parcel/90/2031-03-11/meta/CDC.index", f"CDC{n:06d}.csv\n").checkpoint(1000 + n)


@pytest.fixture
def ready(workspace):
    return workspace.snapshot("parcel", 100, _1="place,label\n" + "".join(f"{i},s\n" for i in range(1, 9))).definition(90)


def data_files(out):
    return sorted(str(p.relative_to(out)) for p in Path(out).rglob("*") if p.is_file() and not p.name.startswith("."))


def test_files_stay_the_same_in_number(spark, ready, out):
    counts = []
    for n in range(1, 7):
        step(ready, n)
        cl.replay(spark, str(ready), out, buckets=4, keep_runs=2)
        counts.append(len({p.split("/part-")[0] for p in data_files(out)}))
        assert state(spark, out)[0] == (1, f"v{n}") and len(state(spark, out)) == 10
    assert counts[2:] == [counts[2]] * 4
    # the run before can still be read
    last = cl.StateStore(spark, out).latest_run()
    assert state(spark, out, last - 1)[0] == (1, "v5")


def test_an_interrupted_sweep_loses_nothing(spark, ready, out, monkeypatch):
    for n in range(1, 4):
        step(ready, n)
        cl.replay(spark, str(ready), out, buckets=4, keep_runs=None)
    before, newest = state(spark, out), cl.StateStore(spark, out).latest_run()
    whole = out + "-whole"
    shutil.copytree(out, whole)
    removed = sweep(spark, whole, 1)
    assert removed and state(spark, whole) == before
    remove = sw._Folder.remove
    for stop in range(len(removed)):
        done = []

        def failing(self, name):
            if len(done) == stop:
                raise OSError("gone")
            done.append(name)
            remove(self, name)

        part = f"{out}-{stop}"
        shutil.copytree(out, part)
        monkeypatch.setattr(sw._Folder, "remove", failing)
        with pytest.raises(OSError):
            sweep(spark, part, 1)
        monkeypatch.setattr(sw._Folder, "remove", remove)
        assert cl.StateStore(spark, part).latest_run() == newest
        sweep(spark, part, 1)
        assert data_files(part) == data_files(whole)
    assert state(spark, part) == before
    step(ready, 4)
    cl.replay(spark, str(ready), part, keep_runs=1)
    assert state(spark, part)[0] == (1, "v4")


def test_a_run_in_progress_is_left_alone(spark, ready, out):
    step(ready, 1)
    cl.replay(spark, str(ready), out, buckets=4)
    for name in ("runs/9/files/x", "state/depot_parcel/9/_bucket=1/x", "delta/depot_parcel/9/x", "landing/run-9/x"):
        path = Path(out) / name
        path.parent.mkdir(parents=True)
        path.write_text("")
    sweep(spark, out, 1)
    assert all((Path(out) / n).exists() for n in ("runs/9/files/x", "state/depot_parcel/9/_bucket=1/x", "landing/run-9/x"))
    assert sweep(spark, out + "-none") == []
    with pytest.raises(ValueError):
        sweep(spark, out, 0)


def test_a_stream_drops_applied_batches(spark, ready, out, tmp_path):
    def run():
        follow(spark, str(ready), out, str(tmp_path / "check"), buckets=4, max_files=1, keep_runs=1).awaitTermination()

    for n in (1, 2, 3):
        step(ready, n)
        run()
    # a file that the index does not name yet: landed, and kept until it is applied
    ready.put("increment/depot/parcel/90/2031-03-11/CDC000004.csv", "U,parcel,depot,1004,1,v4\n")
    run()
    assert state(spark, out)[0] == (1, "v3")
    kept = {r.path.rsplit("/", 1)[1] for r in landed_files(spark, cl.StateStore(spark, out)).collect()}
    assert "CDC000004.csv" in kept and "CDC000001.csv" not in kept
    ready.put("increment/depot/parcel/90/2031-03-11/meta/CDC.index", "CDC000004.csv\n").checkpoint(1004)
    run()
    assert state(spark, out)[0] == (1, "v4")
