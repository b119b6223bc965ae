"""Rows of equal keys as whole runs, streamed from sorted partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def flatten(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    """Values of a numeric column."""
    return batch.column(name).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(name).to_numpy()


def fixed_rows(table: pa.Table, name: str, dtype) -> np.ndarray:
    """A binary column whose values have one length, as a matrix of ``dtype``."""
    column = table.column(name).combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def key_changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Places where a run begins, and the number of rows at the end."""
    changed = np.zeros(len(table), bool)
    changed[:1] = True
    for key in keys:
        values = flatten(table, key)
        changed[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(changed), len(table))


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold only complete runs of ``keys``, with the bounds of the runs.

    A run may reach over any number of batches; only the open run is held back.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = held and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
        starts = key_changes(pa.Table.from_batches([batch]), keys)
        last = int(starts[-2])
        if last == 0 and (same or not held):
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch.slice(0, last)])
        if len(table):
            yield table, key_changes(table, keys)
        held = [batch.slice(last)]
    if held:
        table = pa.Table.from_batches(held)
        yield table, key_changes(table, keys)


def by_runs(df: DataFrame, keys: list[str], work: Callable, schema: str, order: list[str] | None = None) -> DataFrame:
    """Apply ``work`` (tables of complete runs and their bounds in, record batches out) to ``df`` grouped by ``keys``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_runs(batches, keys):
            yield from work(table, bounds)

    return df.repartition(*keys).sortWithinPartitions(*keys, *(order or [])).mapInArrow(task, schema)
