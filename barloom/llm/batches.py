"""Streams of Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def cells(batches: Batches, keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first columns; the last column becomes an array per row.

    The stream is sorted by these columns, so only one cell is held at a time.
    """
    key, rows = None, []
    for batch in batches:
        scalars = zip(*[c.to_pylist() for c in batch.columns[:-1]], strict=True)
        lists = batch.columns[-1]
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False)
        for i, row in enumerate(scalars):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append((*row[keys:], values[ends[i] : ends[i + 1]].copy()))
    if rows:
        yield key, rows


def batch_of(schema: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(schema))
