"""Texts of Arrow string columns as code points laid end to end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def slices(batch: pa.RecordBatch, at: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts in column ``at`` have about ``size`` bytes, or are one text."""
    if not batch.num_rows:
        return
    column = batch.column(at).cast(pa.large_string())
    batch = pa.RecordBatch.from_arrays([column if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)
    offsets, lo = _offsets(column), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one array of code points, and the offsets of the texts in it."""
    column = column.cast(pa.large_string())
    offsets = _offsets(column)
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[lo:hi]
    cps = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(cps) == len(raw):
        return cps, offsets - lo
    counts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)])
    return cps, counts[offsets - lo]
