"""Rows of whole keys in Arrow batches, without a call for each key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def begins(table: pa.Table | pa.RecordBatch, keys: int) -> np.ndarray:
    """The places at which a row's first `keys` columns differ from the row before; the first row is one. No NULLs."""
    n = table.num_rows
    new = np.ones(n, dtype=bool)
    if n > 1:
        new[1:] = np.any([pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False) for c in map(_whole, table.columns[:keys])], axis=0)
    return np.flatnonzero(new)


def _whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def whole_keys(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole keys from batches that are sorted by their first `keys` columns; a key is in one table only."""
    held: list[pa.RecordBatch] = []
    of = lambda batch, k: [batch.column(c)[k].as_py() for c in range(keys)]
    for batch in batches:
        if not batch.num_rows:
            continue
        at = begins(batch, keys)
        if held and of(held[-1], held[-1].num_rows - 1) == of(batch, 0):
            at = at[1:]
        if held and len(at) or len(at) > 1:
            done = [*held, batch.slice(0, at[-1])]
            held = []
            yield pa.Table.from_batches(done).combine_chunks()
            batch = batch.slice(at[-1])
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def by_keys(df: DataFrame, keys: list[str], order: list[str], run: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, parts: int | None = None) -> DataFrame:
    """run() on tables of whole keys, sorted by keys and order; df has the keys first, which aren't NULL.

    parts: a number of tasks that stays, for keys whose work is much more than their bytes.
    """

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, len(keys)):
            yield from run(table)

    spread = df.repartition(parts, *keys) if parts else df.repartition(*keys)
    return spread.sortWithinPartitions(*keys, *order).mapInArrow(both, schema)
