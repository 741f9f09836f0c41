"""Arrow batches inside tasks: text columns as byte buffers, cut into slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and int64 offsets of its rows from 0; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32) if len(column) else np.zeros(1, np.int64)
    offsets = raw[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2] if len(column) else None
    values = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each holds about ``size`` bytes at most, one row
    at least and SLICE_ROWS rows at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1)
            end = min(end, begin + SLICE_ROWS)
            yield batch.slice(begin, end - begin)
            begin = end


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of the given columns, converted to the schema's types."""
    arrays = [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, type=f.type)
              for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
