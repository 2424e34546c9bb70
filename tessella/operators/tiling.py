"""The tiling grid as a relation: slide x magnification x rows x columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.names import tile_name


def source_edge(mag: Column, tile: int = 512) -> Column:
    """Edge of the source square that becomes a tile: ``tile / mag`` half-even below 1, else ``tile``."""
    return F.when(mag <= 1, F.rint(F.lit(float(tile)) / mag).cast("int")).otherwise(F.lit(tile))


def stride(total: Column, wanted: Column) -> Column:
    """Grid step that thins ``total`` tiles to about ``wanted``."""
    return F.when(wanted.isNull() | (wanted >= total), F.lit(1)).otherwise(F.ceil(F.sqrt(total / wanted)).cast("int"))


def grid(slides: DataFrame, mags: list[float], wanted: int | None = None, tile: int = 512) -> DataFrame:
    """``(slide_id, magnification, edge, x, y, idx)``: source squares of every slide and magnification.

    Needs ``slide_id`` (unique), ``width``, ``height``; slides without a size or smaller than the square give none.
    ``idx`` counts a slide's tiles from 0 by magnification (largest first), row and column. It follows from the
    grids' sizes, so the tiles themselves are neither shuffled nor sorted.
    """
    m = F.explode(F.array(*[F.lit(float(v)) for v in sorted(set(mags), reverse=True)]))
    base = slides.where("width IS NOT NULL AND height IS NOT NULL").select("slide_id", "width", "height", m.alias("magnification")).withColumn("edge", source_edge(F.col("magnification"), tile))
    fits = base.where("width >= edge AND height >= edge").withColumn("nx", F.expr("(width - edge) div edge + 1").cast("int")).withColumn("ny", F.expr("(height - edge) div edge + 1").cast("int"))
    step = stride(F.col("nx").cast("long") * F.col("ny"), F.lit(wanted).cast("long"))
    larger = W.partitionBy("slide_id").orderBy(F.desc("magnification")).rowsBetween(W.unboundedPreceding, -1)
    sized = (
        fits.withColumn("step", step)
        .withColumn("cols", F.expr("(nx - 1) div step + 1"))
        .withColumn("rows", F.expr("(ny - 1) div step + 1"))
        .withColumn("before", F.coalesce(F.sum(F.col("cols") * F.col("rows")).over(larger), F.lit(0)))
    )
    every = sized.withColumn("row", F.explode(F.expr("sequence(0L, rows - 1)"))).withColumn("col", F.explode(F.expr("sequence(0L, cols - 1)")))
    at = lambda i: (F.col(i) * F.col("step") * F.col("edge")).cast("int")
    return every.select("slide_id", "magnification", "edge", at("col").alias("x"), at("row").alias("y"), (F.col("before") + F.col("row") * F.col("cols") + F.col("col")).cast("int").alias("idx"))


def with_names(tiles: DataFrame) -> DataFrame:
    """Adds the tiles' file names."""
    return tiles.withColumn("tile_name", tile_name(F.col("slide_id"), F.col("magnification"), F.col("x"), F.col("y"), F.col("idx")))
