"""Random histories: batch, stepwise and streaming replay against a plain replay in Python."""

from __future__ import annotations

import random

import pytest
from conftest import COLUMNS, rows

import changeloom as cl
from changeloom.streaming import apply_landed, follow


def make_history(seed: int, n: int = 400):
    """Changes ``(version, day, file, line)`` with ties in commit time, and the state after each."""
    rng = random.Random(seed)
    state, out, ts = {k: f"s{k}" for k in range(20)}, [], 101
    versions = [90, 180, 260]
    for i in range(n):
        ts += rng.choice([0, 1, 1, 2])
        version = max(v for v in versions if v < ts) if ts > 90 else 90
        key = min(int(rng.expovariate(0.1)), 60)
        op = "D" if key in state and rng.random() < 0.3 else ("U" if key in state else "I")
        name = f"v{i}\n\"{key}\""
        day = f"2026-05-{1 + ts // 100:02d}"
        text = f'{op},parcel,depot,{ts},{key},"{name.replace(chr(34), chr(34) * 2)}"\n'
        if op == "D":
            state.pop(key)
        else:
            state[key] = name
        out.append((version, day, i // 25, ts, text, dict(state)))
    return out


def write(workspace, history):
    """All files of a history. File numbers restart every day of every version."""
    days: dict = {}
    for version, day, part, _, text, _ in history:
        days.setdefault((version, day), {}).setdefault(part, []).append(text)
    for (version, day), parts in days.items():
        workspace.definition(version, COLUMNS)
        workspace.changes(version, *["".join(t) for _, t in sorted(parts.items())], sub=day)


def expected(history, upper):
    last = {k: f"s{k}" for k in range(20)}
    for *_, ts, _, state in history:
        if ts <= upper:
            last = state
    return sorted(last.items(), key=repr)


def snapshot(workspace):
    workspace.snapshot(_1="place,label\n" + "".join(f"{k},s{k}\n" for k in range(20)))


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_in_steps(spark, workspace, out, seed):
    history = make_history(seed)
    snapshot(workspace)
    write(workspace, history)
    top = history[-1][3]
    for upper in (101, 150, top // 2 + 60, top):
        workspace.checkpoint(upper)
        cl.replay(spark, str(workspace), out, buckets=3)
        assert rows(cl.StateStore(spark, out, 3).read("depot_parcel")) == expected(history, upper)


def test_streaming_equals_batch(spark, workspace, out, tmp_path):
    history = make_history(3)
    snapshot(workspace)
    middle, top = history[200][3], history[-1][3]
    # a file is read once, so the first half ends at a file boundary
    first = [h for h in history if h[2] < 8]
    write(workspace, first)
    workspace.checkpoint(first[-1][3] - 3)
    query = follow(spark, str(workspace), out, str(tmp_path / "cp"), buckets=3, max_files=4)
    query.awaitTermination()
    assert rows(cl.StateStore(spark, out, 3).read("depot_parcel")) == expected(history, first[-1][3] - 3)
    # rows that waited are applied when only the checkpoint moves
    workspace.checkpoint(first[-1][3] - 1)
    apply_landed(spark, str(workspace), cl.StateStore(spark, out, 3), cl.Options())
    assert rows(cl.StateStore(spark, out, 3).read("depot_parcel")) == expected(first, first[-1][3] - 1)
    write(workspace, history)
    workspace.checkpoint(top)
    query = follow(spark, str(workspace), out, str(tmp_path / "cp"), buckets=3, max_files=3)
    query.awaitTermination()
    assert rows(cl.StateStore(spark, out, 3).read("depot_parcel")) == expected(history, top)
    assert middle < top


def test_landing_behind_the_index_changes_nothing(spark, workspace, out):
    snapshot(workspace)
    history = make_history(4, 60)
    write(workspace, history)
    workspace.checkpoint(history[-1][3])
    store = cl.StateStore(spark, out, 3)
    from changeloom.plans.replay import load_snapshot

    run = load_snapshot(spark, str(workspace), store, cl.Options())
    result = apply_landed(spark, str(workspace), store, cl.Options())
    assert result.skipped == "landing is behind the index" and store.latest_run() == run


def test_half_written_run_is_not_seen(spark, workspace, out):
    snapshot(workspace)
    history = make_history(5, 80)
    write(workspace, history)
    workspace.checkpoint(history[-1][3])
    cl.replay(spark, str(workspace), out, buckets=3)
    store = cl.StateStore(spark, out, 3)
    assert store.latest_run() == 2
    import os

    os.rename(f"{out}/runs/2/_DONE", f"{out}/runs/2/not_done")
    assert store.latest_run() == 1
    assert rows(store.read("depot_parcel")) == expected([], 0)
    cl.replay(spark, str(workspace), out, buckets=3)
    assert rows(store.read("depot_parcel")) == expected(history, history[-1][3])
