"""Lists of whole numbers as one compressed value, for rows that are staged or moved."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(lists: dict[str, np.ndarray | pa.Array]) -> bytes:
    """Lists as one compressed row, whole numbers as narrow as they may be."""
    columns = []
    for values in lists.values():
        if isinstance(values, np.ndarray) and (not len(values) or values.min() >= 0):
            values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
        values = pa.array(values) if isinstance(values, np.ndarray) else values
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    row = pa.RecordBatch.from_arrays(columns, names=list(lists))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(row)
    return sink.getvalue().to_pybytes()


def unpack(packed: pa.Scalar) -> dict[str, pa.Array]:
    """The lists of a value that ``pack`` made."""
    row = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
    return {name: row.column(name)[0].values for name in row.schema.names}


def repeats(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the runs of equal values, and the runs' sizes."""
    new = np.ones(len(sorted_values), bool)
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(sorted_values)))
