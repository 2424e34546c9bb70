"""Pixels of cells: crops for models, data URLs, painted tiles, thumbnails. A tile is decoded once for all its cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..kernels.draw import box_crop, outline, rectangle, resize, to_rgb
from ..kernels.raster import read_png, write_png

TILE_NOT_FOUND, TILE_FAILED = "Error - Tile Not Found", "Error - Tile Processing Failed"


def data_url(png: Column) -> Column:
    """PNG bytes as ``data:image/png;base64,...``."""
    return F.concat(F.lit("data:image/png;base64,"), F.base64(png))


def decoded(data: bytes) -> np.ndarray:
    return to_rgb(read_png(bytes(data)))


def cell_crops(cells: DataFrame, tiles: DataFrame, keys: tuple[str, ...] = ("slide_id", "tile_name"), decode: Callable[[bytes], np.ndarray] = decoded) -> DataFrame:
    """``(keys, label_id, bbox, crop, error)``: each cell's pixels as RGB PNG, its box's maxima taken as exclusive.

    ``cells`` has ``keys, label_id, bbox``, ``tiles`` has ``keys, content``. A cell whose tile is missing, cannot be decoded or
    whose box has no area gets no crop but the error class. The cells of a tile meet in one row, so the tile is decoded once.
    """
    kinds = dict(cells.dtypes)
    nested = cells.groupBy(*keys).agg(F.collect_list(F.struct("label_id", "bbox")).alias("__cells"))
    rows = nested.join(tiles.groupBy(*keys).agg(F.first("content").alias("content")), list(keys), "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                at = [rec[k] for k in keys]
                px, error = None, TILE_NOT_FOUND
                if rec["content"] is not None:
                    try:
                        px, error = decode(rec["content"]), None
                    except (ValueError, TypeError):
                        error = TILE_FAILED
                for c in rec["__cells"]:
                    box, crop, why = c["bbox"], None, error
                    if px is not None:
                        try:
                            crop = write_png(box_crop(px, list(box)))
                        except (ValueError, TypeError):
                            why = TILE_FAILED
                    out.append((*at, c["label_id"], None if box is None else list(box), crop, why))
            yield pd.DataFrame(out, columns=[*keys, "label_id", "bbox", "crop", "error"])

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return rows.mapInPandas(run, f"{schema}, label_id {kinds['label_id']}, bbox {kinds['bbox']}, crop binary, error string")


def painted(tiles: DataFrame, commands: DataFrame, keys: tuple[str, ...] = ("slide_id", "tile_name")) -> DataFrame:
    """``(keys, content)``: tiles as PNG with the boxes and outlines of their drawing commands; labels stay rows, there is no font here.

    A tile without commands is left as it is; one that cannot be decoded is left out.
    """
    shapes = commands.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("cell_id", "color", "box", "outline"))).alias("__shapes"))
    rows = tiles.select(*keys, "content").join(shapes, list(keys), "left")
    kinds = dict(tiles.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                try:
                    px = decoded(rec["content"]).copy()
                except (ValueError, TypeError):
                    continue
                for s in rec["__shapes"] if rec["__shapes"] is not None else []:
                    shade = tuple(int(v) for v in s["color"])[::-1]  # commands hold blue, green, red
                    if s["box"] is not None:
                        rectangle(px, s["box"], shade)
                    if s["outline"] is not None:
                        outline(px, [(int(p[0]), int(p[1])) for p in s["outline"]], shade)
                out.append((*[rec[k] for k in keys], write_png(px)))
            yield pd.DataFrame(out, columns=[*keys, "content"])

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return rows.mapInPandas(run, f"{schema}, content binary")


def thumbnails(tiles: DataFrame, side: int = 128, keys: tuple[str, ...] = ("slide_id", "tile_name")) -> DataFrame:
    """``(keys, content)``: tiles shrunk by bicubic resampling so that their longer side is at most ``side``; unreadable ones are left out."""
    kinds = dict(tiles.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                try:
                    px = decoded(rec["content"])
                except (ValueError, TypeError):
                    continue
                f = min(1.0, side / max(px.shape[:2]))
                out.append((*[rec[k] for k in keys], write_png(resize(px, max(1, round(px.shape[1] * f)), max(1, round(px.shape[0] * f)), "bicubic"))))
            yield pd.DataFrame(out, columns=[*keys, "content"])

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return tiles.select(*keys, "content").mapInPandas(run, f"{schema}, content binary")
