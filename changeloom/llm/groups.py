"""Groups of consecutive rows in sorted Arrow batches, as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

Arrays = dict[str, np.ndarray]


def groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], arrays: Callable[[pa.RecordBatch], Arrays]
) -> Iterator[Arrays]:
    """Rows with the same keys together; the input has them one after another."""
    held: list[Arrays] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = arrays(batch)
        n = batch.num_rows
        new = np.zeros(n, bool)
        for k in keys:
            new[1:] |= now[k][1:] != now[k][:-1]
        if held:
            new[0] = any(now[k][0] != held[-1][k][-1] for k in keys)
            if new[0]:
                yield _joined(held)
                held = []
        cuts = np.flatnonzero(new).tolist()
        begin = 0
        for cut in cuts:
            if cut == 0:
                continue
            part = {c: x[begin:cut] for c, x in now.items()}
            yield _joined([*held, part]) if held else part
            held, begin = [], cut
        held.append({c: x[begin:] for c, x in now.items()})
    if held:
        yield _joined(held)


def _joined(parts: list[Arrays]) -> Arrays:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def objects(batch: pa.RecordBatch, name: str) -> np.ndarray:
    out = np.empty(batch.num_rows, object)
    out[:] = batch.column(name).to_pylist()
    return out


class Rows:
    """Collects output rows and hands them out as batches of a few thousand."""

    def __init__(self, schema: pa.Schema, size: int = 4096):
        self.schema, self.size = schema, size
        self.columns: list[list] = [[] for _ in schema]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)

    def full(self) -> bool:
        return len(self.columns[0]) >= self.size

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema
        )
        self.columns = [[] for _ in self.schema]
        return out
