"""Whole groups from key-sorted Arrow batches inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """(table, group starts) with whole groups from batches sorted by ``keys``; the open group is carried over."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([held, now]) if held is not None else now
        cols = [now.column(k).to_numpy() for k in keys]
        change = np.zeros(now.num_rows, bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        if len(starts) > 1:
            yield now.slice(0, int(starts[-1])).combine_chunks(), starts
        held = now.slice(int(starts[-1]))
    if held is not None:
        yield held.combine_chunks(), np.array([0, held.num_rows])
