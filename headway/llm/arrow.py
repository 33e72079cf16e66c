"""Arrow batches in tasks: bounded slices of texts and flat views of their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: For work that holds many 64-bit numbers for each byte at once: its arrays then take some tens of MB in a worker.
NARROW_SLICE_BYTES = 1 << 18


def text_slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts hold about ``limit`` bytes; one longer text is a slice by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(int(np.searchsorted(ends, base + limit, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def strings(array: pa.Array) -> list[str]:
    """The texts, null as empty."""
    return pc.fill_null(array, "").to_pylist()


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes in one array, and the n+1 offsets into it; null counts as empty."""
    array = pc.fill_null(array, "" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    size = np.dtype(kind).itemsize
    bounds = np.frombuffer(offsets, dtype=kind, count=len(array) + 1, offset=array.offset * size).astype(np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    flat = np.frombuffer(data, dtype=np.uint8, count=int(bounds[-1] - bounds[0]), offset=int(bounds[0]))
    return flat, bounds - bounds[0]


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and n+1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of every (start, length), one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
