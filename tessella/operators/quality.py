"""Tile quality: statistics of pixels and the usefulness predicate."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..kernels.raster import read_png, tile_statistics

LIMITS = {"min_edge_density": 0.02, "max_bright_ratio": 0.8, "max_dark_ratio": 0.8, "min_std_intensity": 10.0, "min_laplacian_var": 50.0, "min_color_variance": 5.0}
STATS = "mean_intensity double, std_intensity double, bright_pixels_ratio double, dark_pixels_ratio double, edge_density double, color_variance double, laplacian_var double"


def gray_of(r: Column, g: Column, b: Column) -> Column:
    """Luma in 14-bit fixed point, so that every engine rounds alike."""
    return F.shiftright(r * 4899 + g * 9617 + b * 1868 + 8192, 14).cast("int")


def intensity_stats(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Mean, spread, bright and dark share and colour variance from rows ``keys, r, g, b``."""
    grey = pixels.withColumn("gray", gray_of(F.col("r"), F.col("g"), F.col("b")))
    means = [F.avg(c) for c in ("r", "g", "b")]
    mean = (means[0] + means[1] + means[2]) / 3
    colour = ((means[0] - mean) * (means[0] - mean) + (means[1] - mean) * (means[1] - mean) + (means[2] - mean) * (means[2] - mean)) / 3
    return grey.groupBy(*keys).agg(
        F.avg("gray").alias("mean_intensity"),
        F.stddev_pop("gray").alias("std_intensity"),
        F.avg((F.col("gray") > 240).cast("int")).alias("bright_pixels_ratio"),
        F.avg((F.col("gray") < 15).cast("int")).alias("dark_pixels_ratio"),
        colour.alias("color_variance"),
    )


def rejection_reasons(limits: dict[str, float] = LIMITS) -> Column:
    """Texts of the limits that a row of statistics breaks; a value equal to its limit passes.

    A missing statistic breaks no limit (a grey tile has no colour variance); a tile without any is ``unreadable``.
    """

    def below(stat: str, limit: str, tag: str, form: str) -> Column:
        return F.when(F.col(stat) < limits[limit], F.format_string(f"{tag} ({form} < %s)", F.col(stat), F.lit(str(limits[limit]))))

    def above(stat: str, limit: str, tag: str) -> Column:
        return F.when(F.col(stat) > limits[limit], F.format_string(f"{tag} (%.2f > %s)", F.col(stat), F.lit(str(limits[limit]))))

    return F.array_compact(
        F.array(
            F.when(F.col("std_intensity").isNull(), "unreadable"),
            below("edge_density", "min_edge_density", "low_edge_density", "%.4f"),
            above("bright_pixels_ratio", "max_bright_ratio", "too_bright"),
            above("dark_pixels_ratio", "max_dark_ratio", "too_dark"),
            below("std_intensity", "min_std_intensity", "low_contrast", "%.2f"),
            below("laplacian_var", "min_laplacian_var", "blurry", "%.2f"),
            below("color_variance", "min_color_variance", "low_color_var", "%.2f"),
        )
    )


def filtered(stats: DataFrame, limits: dict[str, float] = LIMITS) -> DataFrame:
    """All rows with ``rejection_reasons`` and ``useful``."""
    return stats.withColumn("rejection_reasons", rejection_reasons(limits)).withColumn("useful", F.size("rejection_reasons") == 0)


def image_stats(images: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """The seven statistics of images as bytes (PNG); one that cannot be read gives nulls. ``decoded_stats`` takes more formats."""
    names = [p.split()[0] for p in STATS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for data in pdf[content]:
                try:
                    rows.append(tile_statistics(read_png(bytes(data))))
                except (ValueError, TypeError):
                    rows.append(dict.fromkeys(names, np.nan))
            yield pd.concat([pdf[[key]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return images.select(key, content).mapInPandas(run, f"{key} string, {STATS}")


def decoded_stats(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """The seven statistics of decoded tiles ``keys, height, width, channels, data`` (BGR bytes, as the engine's image source gives them).

    A tile without data gives nulls.
    """
    names = [p.split()[0] for p in STATS.split(", ")]
    kinds = dict(tiles.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h, w, c, data in zip(pdf["height"], pdf["width"], pdf["channels"], pdf["data"]):
                if data is None or not h or h < 0:
                    rows.append(dict.fromkeys(names, np.nan))
                    continue
                px = np.frombuffer(data, np.uint8).reshape(h, w, c)
                rows.append(tile_statistics(px[:, :, 0] if c < 3 else px[:, :, 2::-1]))
            yield pd.concat([pdf[keys].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    schema = ", ".join(f"{k} {kinds[k]}" for k in keys)
    return tiles.select(*keys, "height", "width", "channels", "data").mapInPandas(run, f"{schema}, {STATS}")


def raster_stats(pixels: DataFrame, key: str, width: str = "width") -> DataFrame:
    """The seven statistics of rows ``key, width, rgb ARRAY<INT>`` (row-major triples)."""
    names = [p.split()[0] for p in STATS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [tile_statistics(np.asarray(v, np.uint8).reshape(-1, int(w), 3)) for v, w in zip(pdf["rgb"], pdf[width])]
            yield pd.concat([pdf[[key]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    kind = dict(pixels.dtypes)[key]
    return pixels.select(key, width, "rgb").mapInPandas(run, f"{key} {kind}, {STATS}")
