"""Label masks: boxes and polygons of labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..kernels.raster import label_boxes, label_stack, longest_contours, read_png, write_png16

PIXELS = 2**18


def _stacks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, stack)``: the rasters of an Arrow batch by shape, about ``PIXELS`` pixels at a time; a null pixel is 0, a raster must not be null."""
    col = batch.column(column)
    if col.null_count:
        raise ValueError(f"null in {column}")
    at = col.offsets.to_numpy()
    values = col.values.fill_null(0).to_numpy(zero_copy_only=False)
    shapes = np.stack([np.diff(at), batch.column("width").to_numpy(zero_copy_only=False)], axis=1).astype(np.int64)
    for size, width in np.unique(shapes, axis=0).tolist():
        rows = np.flatnonzero((shapes == (size, width)).all(axis=1))
        step = max(1, PIXELS // max(1, size))
        for i in range(0, len(rows), step):
            own = rows[i : i + step]
            if own[-1] - own[0] + 1 == len(own):
                flat = values[at[own[0]] : at[own[-1] + 1]]
            else:
                flat = np.concatenate([values[at[r] : at[r + 1]] for r in own])
            if size % width:
                raise ValueError(f"{size} pixels are no raster of width {width}")
            yield own, flat.reshape(len(own), size // width, width)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _label_ids(label: np.ndarray) -> pa.Array:
    return pa.array(label, pa.int64()).cast(pa.int32())


def _keyed(batch: pa.RecordBatch, keys: list[str], rows: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of the rows' keys and other columns."""
    at = pa.array(rows)
    return pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in keys], *columns.values()], [*keys, *columns])


def boxes_of_labels(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, label_id, bbox)`` with inclusive maxima from rows ``keys, y, x, label``; label 0 is background."""
    agg = pixels.where("label <> 0").groupBy(*keys, F.col("label").alias("label_id")).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    return agg.select(*keys, "label_id", F.array("x0", "y0", "x1", "y1").alias("bbox"))


def boxes_of_rasters(masks: DataFrame, keys: list[str]) -> DataFrame:
    """``boxes_of_labels`` of ``keys, width, labels ARRAY<INT>``: a raster's pixels never become rows; rasters of equal keys share their labels."""
    kinds = dict(masks.dtypes)
    sides = ["x0", "y0", "x1", "y1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, stack in _stacks(batch, "labels"):
                tile, label, boxes = label_boxes(stack)
                yield _keyed(batch, keys, rows[tile], {"label_id": _label_ids(label)} | {c: pa.array(boxes[:, i], pa.int32()) for i, c in enumerate(sides)})

    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], "label_id int", *[f"{c} int" for c in sides]])
    boxes = masks.select(*keys, "width", "labels").mapInArrow(run, schema)
    whole = boxes.groupBy(*keys, "label_id").agg(*[(F.min if c.endswith("0") else F.max)(c).alias(c) for c in sides])
    return whole.select(*keys, "label_id", F.array(*sides).alias("bbox"))


def valid_box(label: Column, box: Column) -> Column:
    """A box row that can be used at all: a label and four numbers."""
    return label.isNotNull() & (F.size(box) == 4)


def croppable(box: Column) -> Column:
    """A box that spans an area when its maxima are taken as exclusive."""
    return (box[0] < box[2]) & (box[1] < box[3])


def polygons(masks: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, label_id, polygon)``: the longest contour of each label of ``keys, width, labels ARRAY<INT>``.

    A label without contour at 0.5 (one that fills the raster) gives no row.
    """
    kinds = dict(masks.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, stack in _stacks(batch, "labels"):
                tile, label, start, points = longest_contours(stack)
                line = _lists(start, _lists(np.arange(0, 2 * len(points) + 1, 2), pa.array(points.ravel())))
                yield _keyed(batch, keys, rows[tile], {"label_id": _label_ids(label), "polygon": line})

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return masks.select(*keys, "width", "labels").mapInArrow(run, f"{schema}, label_id int, polygon array<array<double>>")


def read_masks(files: DataFrame) -> DataFrame:
    """``(path, width, labels)`` of 8- or 16-bit grey PNG masks ``path, content``; unreadable ones are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    mask = read_png(bytes(data))
                except (ValueError, TypeError):
                    continue
                rows.append((path, mask.shape[1], mask.astype(np.int32).ravel().tolist()))
            yield pd.DataFrame(rows, columns=["path", "width", "labels"])

    return files.select("path", "content").mapInPandas(run, "path string, width int, labels array<int>")


def threshold_segment(tiles: DataFrame, keys: list[str], below: int = 128) -> DataFrame:
    """A stand-in segmenter: connected dark regions of ``keys, width, gray ARRAY<INT>`` become labels."""
    kinds = dict(tiles.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, stack in _stacks(batch, "gray"):
                labels = label_stack(stack < below).astype(np.int32)
                size = labels[0].size
                lists = _lists(np.arange(0, labels.size + 1, size) if size else np.zeros(len(rows) + 1), pa.array(labels.ravel()))
                width = pa.array(np.full(len(rows), labels.shape[2], np.int32))
                yield _keyed(batch, keys, rows, {"width": width, "labels": lists, "error": pa.nulls(len(rows), pa.string())})

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return tiles.select(*keys, "width", "gray").mapInArrow(run, f"{schema}, width int, labels array<int>, error string")


def batched_segmenter(call: Callable[[list[np.ndarray]], list[np.ndarray]], keys: list[str], batch: int = 16) -> Callable[[DataFrame], DataFrame]:
    """Wraps a model that turns grey rasters into label rasters into a stage ``keys, width, labels, error``.

    A batch that fails is tried again tile by tile; a tile that fails alone gets no labels but the error's text.
    """

    def stage(tiles: DataFrame) -> DataFrame:
        kinds = dict(tiles.dtypes)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for at in range(0, len(pdf), batch):
                    part = pdf.iloc[at : at + batch].reset_index(drop=True)
                    rasters = [np.asarray(g).reshape(-1, int(w)) for g, w in zip(part["gray"], part["width"])]
                    errors: list[str | None] = [None] * len(part)
                    try:
                        found = call(rasters)
                    except Exception:  # noqa: BLE001 - a model may raise anything
                        found = []
                        for i, g in enumerate(rasters):
                            try:
                                found.append(call([g])[0])
                            except Exception as e:  # noqa: BLE001
                                found.append(None)
                                errors[i] = str(e)
                    labels = [None if m is None else np.asarray(m).astype(np.int32).ravel().tolist() for m in found]
                    yield pd.DataFrame({c: part[c].tolist() for c in [*keys, "width"]} | {"labels": labels, "error": errors})

        schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
        return tiles.select(*keys, "width", "gray").mapInPandas(run, f"{schema}, width int, labels array<int>, error string")

    return stage


def mask_images(masks: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, content)``: label rasters ``keys, width, labels`` as 16-bit grey PNG."""
    kinds = dict(masks.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            data = [write_png16(np.asarray(v).reshape(-1, int(w))) for v, w in zip(pdf["labels"], pdf["width"])]
            yield pdf[keys].assign(content=data)

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return masks.where("labels IS NOT NULL").select(*keys, "width", "labels").mapInPandas(run, f"{schema}, content binary")


def missing_masks(tiles: DataFrame, masks: DataFrame, keys: list[str]) -> DataFrame:
    """Tiles without a mask, for the log: they drop out of the join with masks."""
    return tiles.select(*keys).distinct().join(masks.select(*keys).distinct(), keys, "left_anti")


def polygon_points(line: Column) -> Column:
    """``(row, col)`` points turned into ``(x, y)``."""
    return F.transform(line, lambda p: F.array(p[1], p[0]))


def polygon_centre(polygon: Column) -> Column:
    """Mean of a polygon's vertices as ``[x, y]``; null for an empty one."""
    n = F.nullif(F.size(polygon), F.lit(0))
    total = lambda i: F.aggregate(polygon, F.lit(0.0), lambda s, p: s + p[i])
    return F.when(n.isNotNull(), F.array(total(0) / n, total(1) / n))
