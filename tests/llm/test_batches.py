from __future__ import annotations

import pyarrow as pa

from voxlattice.llm.batches import by_size


def test_pieces_hold_whole_texts_of_bounded_size():
    batch = pa.record_batch({"i": list(range(7)), "t": ["ab", None, "abcdefghij", "", "abc", "abcd", None]})
    pieces = list(by_size(iter([batch]), 1, most=5))
    assert [x.column(0).to_pylist() for x in pieces] == [[0, 1], [2], [3, 4], [5, 6]]
    assert [b.num_rows for b in by_size(iter([batch.slice(0, 0)]), 1)] == [0]
