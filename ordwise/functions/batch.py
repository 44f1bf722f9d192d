"""Arrow-batch helpers shared by the generator and the record source.

Binary columns of equal-width values are viewed as ``(n, width)`` uint8
matrices without per-row Python objects.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

def binary_from_matrix(m: np.ndarray) -> pa.Array:
    """(n, width) uint8 -> Arrow binary array (zero-copy of the data buffer)."""
    n, width = m.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
    data = np.ascontiguousarray(m).reshape(-1)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def matrix_from_binary(arr, width: int | None = None) -> np.ndarray | None:
    """Arrow binary array -> (n, width) uint8 view, or None if widths differ or NULLs exist.

    With ``width`` given, a different width is also reported as None.
    """
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if arr.null_count:
        return None
    if n == 0:
        return np.empty((0, width or 0), dtype=np.uint8)
    off_type = np.int64 if pa.types.is_large_binary(arr.type) else np.int32
    offsets = np.frombuffer(arr.buffers()[1], dtype=off_type)[arr.offset:arr.offset + n + 1]
    w = int(offsets[1] - offsets[0])
    if width is not None and w != width:
        return None
    if not (np.diff(offsets) == w).all():
        return None
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data.reshape(n, w)
