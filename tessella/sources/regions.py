"""A data source of image regions: whole-slide files read square by square, each task a band of one slide."""

from __future__ import annotations

import importlib
from collections.abc import Iterator

import numpy as np
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..kernels.draw import box_crop, centre_crop, enlarged, resize, to_rgb
from ..kernels.raster import read_png, write_png


class PngSlide:
    """The built-in opener's slide: a PNG held in memory. Formats with pyramids need an opener of their own."""

    def __init__(self, path: str) -> None:
        system, inner = FileSystem.from_uri(path if "://" in path else f"file://{path}")
        with system.open_input_stream(inner) as f:
            self._px = to_rgb(read_png(f.read()))
        self.dimensions = (self._px.shape[1], self._px.shape[0])

    def read_region(self, at: tuple[int, int], level: int, size: tuple[int, int]) -> np.ndarray:  # noqa: ARG002 - one level only
        return box_crop(self._px, [at[0], at[1], at[0] + size[0], at[1] + size[1]])


class Band(InputPartition):
    def __init__(self, path: str, band: int) -> None:
        super().__init__((path, band))
        self.path, self.band = path, band


def _opener(name: str | None):  # noqa: ANN202
    if not name:
        return PngSlide
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


class RegionReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self._root, self._suffix = options["path"], options.get("suffix", ".png").lower()
        self._tile, self._mag = int(options.get("tile_size", 512)), float(options.get("magnification", 1.0))
        self._bands, self._step = int(options.get("bands", 8)), int(options.get("step", 1))
        self._open = options.get("opener")

    def partitions(self) -> list[Band]:
        system, inner = FileSystem.from_uri(self._root if "://" in self._root else f"file://{self._root}")
        found = system.get_file_info(FileSelector(inner, recursive=True)) if system.get_file_info(inner).type == FileType.Directory else [system.get_file_info(inner)]
        scheme = self._root.split("://")[0] + "://" if "://" in self._root else ""
        return [Band(scheme + f.path, b) for f in sorted(found, key=lambda f: f.path) if f.path.lower().endswith(self._suffix) for b in range(self._bands)]

    def read(self, partition: Band) -> Iterator[tuple]:
        slide = _opener(self._open)(partition.path)
        name = partition.path.rsplit("/", 1)[-1][: -len(self._suffix)]
        w, h = slide.dimensions
        edge = round(self._tile / self._mag) if self._mag <= 1 else self._tile
        stride = edge * self._step
        for row, y in enumerate(range(0, h - edge + 1, stride)):
            if row % self._bands != partition.band:
                continue
            for x in range(0, w - edge + 1, stride):
                px = to_rgb(np.asarray(slide.read_region((x, y), 0, (edge, edge))))
                if edge != self._tile:
                    px = resize(px, self._tile, self._tile)
                elif self._mag > 1:
                    size, _ = enlarged(self._tile, self._mag)
                    px = centre_crop(resize(px, size, size), self._tile)
                yield partition.path, name, self._mag, x, y, edge, write_png(px)


class RegionSource(DataSource):
    """``spark.dataSource.register(RegionSource)``, then ``spark.read.format("tess_regions").load(folder)``.

    Options: ``suffix``, ``tile_size``, ``magnification``, ``step`` (every n-th square), ``bands`` (tasks a slide) and ``opener``
    (``module:function`` that takes a path and gives ``dimensions`` and ``read_region``). Squares that do not fit are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "tess_regions"

    def schema(self) -> str:
        return "path string, slide_name string, magnification double, x int, y int, edge int, content binary"

    def reader(self, schema) -> RegionReader:  # noqa: ANN001, ARG002
        return RegionReader(self.options)
