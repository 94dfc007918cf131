"""Arrow batches cut by the size of their texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are counted together; a text is never cut.
MOST_BYTES = 4 << 20


def by_size(batches: Iterator[pa.RecordBatch], column: int, most: int = MOST_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of whole texts, of at most `most` bytes or of one text, so that memory depends on the longest
    text and not on how many long ones a batch holds. Empty batches stay as they are."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        first, n = 0, batch.num_rows
        if not n:
            yield batch
        while first < n:
            done = int(ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(first, last - first)
            first = last
