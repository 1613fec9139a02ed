"""Parts of Arrow batches of bounded rows and bytes, for workers whose output is larger than their input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def slices(batch: pa.RecordBatch, column: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``rows`` rows and, but for single rows, ``size`` bytes in the given binary column."""
    c = batch.column(column)
    offsets = np.frombuffer(c.buffers()[1], dtype=np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset:] if len(c) else np.zeros(1)
    ends, at = offsets[1:len(c) + 1], 0
    while at < len(c):
        n = int(np.searchsorted(ends[at:at + rows], offsets[at] + size, side="right"))
        yield batch.slice(at, max(1, n))
        at += max(1, n)
