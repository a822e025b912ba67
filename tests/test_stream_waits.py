"""While landing is behind the index, a stream reads no indexes and definitions again for every batch."""

from __future__ import annotations

import os
import sys

from conftest import COLUMNS, rows

import changeloom as cl
from changeloom.plans import replay as rp
from changeloom.streaming import follow

module = sys.modules["changeloom.streaming.follow"]


def counted(monkeypatch, owner, name):
    calls, real = [], getattr(owner, name)

    def call(*args, **kwargs):
        calls.append(args)
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, call)
    return calls


def days(workspace, n, files=1):
    for k in range(1, n + 1):
        texts = [f"U,parcel,depot,{1000 + 10 * k + i},{k % 3},d{k}f{i}\n" for i in range(files)]
        workspace.changes(90, *texts, sub=f"2031-03-{k:02d}")
        for i in range(1, files + 1):  # the stream hands out older files first
            place = workspace.root / f"increment/depot/parcel/90/2031-03-{k:02d}/CDC{i:06d}.csv"
            os.utime(place, (1_900_000_000 + 100 * k + i,) * 2)


def test_metadata_is_not_read_for_every_batch(spark, workspace, out, tmp_path, monkeypatch):
    workspace.snapshot("parcel", 100, _1="place,label\n9,s\n").definition(90).checkpoint(2000)
    days(workspace, 4)
    plans, reads = counted(monkeypatch, rp, "plan_log"), counted(monkeypatch, module, "_definitions")
    follow(spark, str(workspace), out, str(tmp_path / "check"), buckets=2, max_files=1).awaitTermination()
    store = cl.StateStore(spark, out)
    assert rows(store.read("depot_parcel")) == [(0, "d3f0"), (1, "d4f0"), (2, "d2f0"), (9, "s")]
    # at the start, for the first batch and for the last one, which has the newest day
    assert len(plans) == 3 and len(reads) == 1


def test_definitions_that_come_later_are_read(spark, workspace, out, tmp_path, monkeypatch):
    workspace.snapshot("parcel", 100, _1="place,label\n9,s\n").definition(90).checkpoint(2000)
    days(workspace, 2)
    land, wide = module.land_files, [*COLUMNS, ("extra", "INT")]

    def between(session, root, store, files, batch_id, *rest):
        if batch_id == 1:
            workspace.definition(1100, wide).changes(1100, "I,parcel,depot,1101,7,x,5\n", sub="2031-04-01")
        return land(session, root, store, files, batch_id, *rest)

    monkeypatch.setattr(module, "land_files", between)
    reads = counted(monkeypatch, module, "_definitions")
    for _ in range(2):
        follow(spark, str(workspace), out, str(tmp_path / "check"), buckets=2, max_files=1).awaitTermination()
    found = {r.place: (r.label, r.extra) for r in cl.StateStore(spark, out).read("depot_parcel").collect()}
    assert found[7] == ("x", 5) and found[1] == ("d1f0", None) and found[9] == ("s", None)
    assert len(reads) == 3


def test_a_file_that_is_absent_is_not_waited_for(spark, workspace, out, tmp_path, monkeypatch):
    workspace.snapshot("parcel", 100, _1="place,label\n9,s\n").definition(90).checkpoint(2000)
    days(workspace, 2, files=2)
    lost = workspace.root / "increment/depot/parcel/90/2031-03-02/CDC000002.csv"
    text = lost.read_text()
    lost.unlink()
    plans = counted(monkeypatch, rp, "plan_log")

    def run():
        follow(spark, str(workspace), out, str(tmp_path / "check"), buckets=2, max_files=2).awaitTermination()

    run()
    store = cl.StateStore(spark, out)
    assert rows(store.read("depot_parcel")) == [(9, "s")]
    # nothing is waited for, so each batch is held against the indexes
    before = len(plans)
    assert before == 3
    lost.write_text(text)
    run()
    assert len(plans) > before
    assert rows(store.read("depot_parcel")) == [(1, "d1f1"), (2, "d2f1"), (9, "s")]
