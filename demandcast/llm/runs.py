"""Streams of sorted rows in a task, cut where a key changes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Whether each row's key differs from the row's before; the first row starts a run. Keys are numbers without nulls."""
    starts = np.ones(table.num_rows, dtype=bool)
    if table.num_rows > 1:
        starts[1:] = False
        for key in keys:
            held = table.column(key).to_numpy()
            starts[1:] |= held[1:] != held[:-1]
    return starts


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys from batches that are sorted by them. What is held is a batch and one run."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(np.flatnonzero(starts_of(pa.Table.from_batches([batch]), keys))[-1])
        if last == 0 and held and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys):
            held.append(batch)
            continue
        if last:
            held.append(batch.slice(0, last))
        if held:
            yield pa.Table.from_batches(held)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)
