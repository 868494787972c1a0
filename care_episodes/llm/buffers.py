"""Arrow text columns as numpy byte arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A slice holds this many bytes of text and this many rows at most; a single longer row is a slice of its own.
SLICE_BYTES, SLICE_ROWS = 2 << 20, 256


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i is bytes[offsets[i]:offsets[i+1]]; null rows are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice's texts stay below the bounds."""
    for batch in batches:
        _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1
            end = min(max(end, start + 1), start + most_rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of each byte."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]
