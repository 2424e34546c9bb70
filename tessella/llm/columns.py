"""Columns of numbers packed into few rows for an exchange: a row holds all that one task sends to one bucket.

The engine moves and sorts rows, and millions of edges would be millions of rows. Packed, a task writes one row for each
bucket that it has something for; each bucket is one partition after ``to_buckets``.
"""

from __future__ import annotations

import json
import struct
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROW = "bucket int, kind int, fresh long, total long, body binary"
ZSTD = "zstd"

Columns = dict[str, np.ndarray]


def _narrow(a: np.ndarray) -> np.ndarray:
    """A column of integers in as few bytes as hold it; similarities (all that is in double precision) in units of 1e-9, to which exact ones are rounded."""
    if a.dtype == np.float64:
        units = a * 1e9
        return np.rint(units, out=units).astype(np.int32)
    if a.dtype.kind != "i" or a.ndim > 1 or not len(a):
        return a
    low, high = int(a.min()), int(a.max())
    return a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max), copy=False)


def encode(cols: Columns) -> bytes:
    head, bodies = [], []
    for name, a in cols.items():
        few = _narrow(a)
        raw = np.ascontiguousarray(few).tobytes()
        plain = a.ndim > 1 and a.dtype == np.int16  # vectors in fixed point, which no codec shortens
        body = raw if plain else pa.compress(raw, codec=ZSTD, asbytes=True)
        head.append((name, a.dtype.str, few.dtype.str, list(a.shape), len(raw), len(body), plain))
        bodies.append(body)
    text = json.dumps(head).encode()
    return b"".join([struct.pack("<I", len(text)), text, *bodies])


def decode(buf: memoryview | bytes, only: tuple[str, ...] = ()) -> Columns:
    """The columns of a body, all or those in ``only``."""
    (size,) = struct.unpack_from("<I", buf)
    at, out = 4 + size, {}
    for name, kind, few, shape, raw, body, plain in json.loads(bytes(buf[4 : 4 + size])):
        part, at = buf[at : at + body], at + body
        if only and name not in only:
            continue
        a = np.frombuffer(part if plain else pa.decompress(part, decompressed_size=raw, codec=ZSTD), np.dtype(few)).reshape(shape)
        out[name] = a / 1e9 if kind == "<f8" else a.astype(np.dtype(kind), copy=False)
    return out


def joined(parts: list[Columns]) -> Columns:
    """The columns of several parts, one after the other."""
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def picked(cols: Columns, rows: np.ndarray) -> Columns:
    return {c: v[rows] for c, v in cols.items()}


def row(bucket: int, kind: int, cols: Columns, fresh: int = 0, total: int = 0) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([fresh], pa.int64()), pa.array([total], pa.int64()), pa.array([encode(cols)], pa.binary())],
        names=["bucket", "kind", "fresh", "total", "body"],
    )


def scatter(kind: int, bucket: np.ndarray, cols: Columns) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0])) if len(order) else []
    for s, e in zip(cuts, [*cuts[1:], len(order)]):
        yield row(int(bucket[order[s]]), kind, picked(cols, order[s:e]))


def gathered(batches: Iterable[pa.RecordBatch], only: dict[int, tuple[str, ...]] | None = None) -> Iterator[tuple[int, dict[int, list[Columns]]]]:
    """``(bucket, columns by kind)`` of a partition, which holds one bucket unless the engine merged some. ``only`` names the columns wanted of a kind."""
    held: dict[int, dict[int, list[Columns]]] = defaultdict(lambda: defaultdict(list))
    for b in batches:
        bucket, kind, body = b.column("bucket").to_pylist(), b.column("kind").to_pylist(), b.column("body")
        for i in range(b.num_rows):
            held[bucket[i]][kind[i]].append(decode(memoryview(body[i].as_buffer()), (only or {}).get(kind[i], ())))
    while held:
        yield held.popitem()


def to_buckets(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartitionById(buckets, "bucket")
