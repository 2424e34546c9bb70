"""Reading embeddings out of Arrow batches and packing them into binary columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

DIM = 50


def usable(column: pa.Array, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, unit vectors)`` of the usable embeddings of an Arrow list column.

    Usable means ``dim`` finite numbers that are not all zero. Vectors are normalised in double
    precision and returned as float32.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    right = (np.diff(offsets) == dim) & np.asarray(column.is_valid())
    rows = np.flatnonzero(right)
    if not len(rows):
        return rows, np.empty((0, dim), np.float32)
    x = values[offsets[rows][:, None] + np.arange(dim)].astype(np.float64)
    with np.errstate(all="ignore"):
        top = np.abs(x).max(axis=1)
        good = np.isfinite(x).all(axis=1) & (top > 0)
        x = x[good] / top[good][:, None]
        x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return rows[good], x.astype(np.float32)


def pack(x: np.ndarray) -> pa.Array:
    """Rows of a contiguous array as a binary column."""
    x = np.ascontiguousarray(x)
    n = len(x)
    width = x.dtype.itemsize * int(np.prod(x.shape[1:], dtype=np.int64))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * width).tobytes()), pa.py_buffer(x.tobytes())])


def unpack(column: pa.Array | pa.ChunkedArray, dim: int = DIM) -> np.ndarray:
    """The inverse of ``pack`` for float32 rows of equal width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, dim), np.float32)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(np.float32).reshape(len(column), dim) if offsets[0] % 4 == 0 else np.frombuffer(data.tobytes(), np.float32).reshape(len(column), dim)


def top_k(s: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, column, value)`` of at least the ``k`` largest entries of each row of ``s``, ties included.

    A lower bound of the k-th largest entry comes from the maxima of column groups; only the groups whose
    maximum reaches it are looked at. Entries of -2 are never taken.
    """
    n, m = s.shape
    width = max(1, m // (32 * k))
    groups = m // width
    if groups > k:
        peaks = s[:, : groups * width].reshape(n, width, groups).max(axis=1)  # groups of every groups-th column, which reads memory in order
        bound = np.maximum(np.partition(peaks, groups - k, axis=1)[:, groups - k] - 2e-7, -1.5)  # and what equals it to seven places
        row, group = np.divmod(np.flatnonzero(peaks >= bound[:, None]), groups)
        col = group[:, None] + np.arange(width) * groups
        val = np.take(s, (row * m)[:, None] + col)
        at = np.flatnonzero(val >= bound[row][:, None])
        row, col, val = row[at // width], col.ravel()[at], val.ravel()[at]
        if rest := m - groups * width:
            r, c = np.divmod(np.flatnonzero(s[:, -rest:] >= bound[:, None]), rest)
            row, col, val = np.concatenate([row, r]), np.concatenate([col, c + m - rest]), np.concatenate([val, s[r, c + m - rest]])
    else:
        row, col = np.divmod(np.flatnonzero(s >= -1.5), m)
        val = s[row, col]
    place = (row << 26) | (20_000_000 - np.rint(val.astype(np.float64) * 1e7).astype(np.int64))  # by row, then by value to seven places
    order = np.argsort(place)
    same = place[order[1:]] == place[order[:-1]]
    tied = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    part = order[tied]
    order[tied] = part[np.lexsort((part, keys[col[part]], place[part]))]  # equal ones by key
    row, col, val = row[order], col[order], val[order]
    first = np.concatenate([[0], np.flatnonzero(np.diff(row)) + 1]) if len(row) else np.array([], np.int64)
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    keep = rank < k
    return row[keep], col[keep], val[keep]
