"""Cells and their nesting under tiles: selection, labelling, annotation, representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.names import cell_text, colour
from .masks import polygon_centre


def ranked(cells: DataFrame, group: list[str], conf: str, tie: list[str]) -> DataFrame:
    """Adds ``rank`` by confidence descending (null counts as 0), then by ``tie``."""
    order = W.partitionBy(*group).orderBy(F.coalesce(F.col(conf), F.lit(0.0)).desc(), *tie)
    return cells.withColumn("rank", F.row_number().over(order))


def select_for_labelling(cells: DataFrame, per_cluster: int = 10, group: tuple[str, ...] = ("slide_id", "cluster_id"), conf: str = "confidence", tie: tuple[str, ...] = ("cell_id",)) -> DataFrame:
    """The cells of each cluster, noise included, that go to the classifier; 0 or less selects none."""
    return ranked(cells, list(group), conf, list(tie)).where(F.col("rank") <= per_cluster)


def join_predictions(cells: DataFrame, predictions: DataFrame, on: list[str], default: str = "Unclassified") -> DataFrame:
    """All cells with their predicted class, or the default."""
    return cells.join(predictions, on, "left").withColumn("pred_class", F.coalesce("pred_class", F.lit(default)))


def nest(cells: DataFrame, keys: list[str], order: list[str], fields: list[str], name: str = "cells") -> DataFrame:
    """One row for each key with its cells as an ordered array of structs."""
    item = F.struct(*order, *[f for f in fields if f not in order])
    drop = [F.transform(F.array_sort(F.collect_list(item)), lambda c: F.struct(*[c[f].alias(f) for f in fields])).alias(name)]
    return cells.groupBy(*keys).agg(*drop)


def number_cells(cells: DataFrame, order: list[str], slide: str = "slide_id") -> DataFrame:
    """Adds ``new_cell_id``, counting a slide's cells from 1 by tile (the first of ``order``, not null) and the rest of it.

    Cells are ordered within their tile only and counted on from the tiles before, so that no task orders a
    whole slide.
    """
    tile = order[0]
    before = W.partitionBy(slide).orderBy(tile).rowsBetween(W.unboundedPreceding, -1)
    tiles = cells.groupBy(slide, tile).agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    own = F.row_number().over(W.partitionBy(slide, tile).orderBy(*order[1:]))
    there = cells.where(F.col(slide).isNotNull() & F.col(tile).isNotNull())
    return there.join(tiles, [slide, tile], "left").withColumn("new_cell_id", (F.col("__before") + own).cast("int")).drop("__before")


def first_match(polygons: DataFrame, classified: DataFrame, on: list[str], position: str) -> DataFrame:
    """Polygons with the first classified cell of their key; polygons without one drop out."""
    first = classified.withColumn("__r", F.lag(F.lit(1)).over(W.partitionBy(*on).orderBy(position))).where("__r IS NULL").drop("__r", position)
    return polygons.join(first.hint("merge"), on)  # both grow with the cells; the engine takes polygons for the size of the compressed table of masks


def representatives(cells: DataFrame, threshold: float = 0.0, most: int | None = None, group: tuple[str, ...] = ("slide_id", "cluster_id"), conf: str = "confidence", cell: str = "cell_id") -> DataFrame:
    """The ``most`` most confident cells of every cluster at or above the threshold (null confidence is 0)."""
    kept = cells.where((F.coalesce(F.col(conf), F.lit(0.0)) >= threshold) & F.col(group[-1]).isNotNull() & F.col(cell).isNotNull())
    out = ranked(kept, list(group), conf, [cell])
    return out if most is None else out.where(F.col("rank") <= most)


def cluster_statistics(reps: DataFrame, group: tuple[str, ...] = ("slide_id", "cluster_id"), conf: str = "confidence") -> DataFrame:
    return reps.groupBy(*group).agg(F.count(F.lit(1)).alias("total_cells"), F.min(conf).alias("min_conf"), F.max(conf).alias("max_conf"), F.avg(conf).alias("avg_conf"))


def analysis_totals(reps: DataFrame, slide: str = "slide_id") -> DataFrame:
    return reps.groupBy(slide).agg(
        F.count_distinct("cluster_id").alias("total_clusters"), F.count_distinct("cell_id").alias("total_cells"), F.count_distinct("tile_id").alias("total_tiles")
    )


def tile_summary(reps: DataFrame, keys: tuple[str, ...] = ("slide_id", "tile_id")) -> DataFrame:
    """Cells per cluster of each tile as a map, with the sorted list of clusters."""
    counts = reps.groupBy(*keys, "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("cluster_id", "n")))
    return counts.groupBy(*keys).agg(pairs.alias("p")).select(*keys, F.transform("p", lambda v: v["cluster_id"]).alias("clusters"), F.map_from_entries("p").alias("cells_per_cluster"))


def semi(cells: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    return cells.join(wanted.select(*on).distinct(), on, "left_semi")


def status_split(wanted: DataFrame, there: DataFrame, on: str, done: DataFrame | None = None) -> DataFrame:
    """``(on, status)``: ``SKIP`` if done, ``MISSING`` if not there, else ``OK``."""
    out = wanted.select(on).distinct().join(there.select(on).distinct().withColumn("__there", F.lit(True)), on, "left")
    if done is None:
        out = out.withColumn("__done", F.lit(None).cast("boolean"))
    else:
        out = out.join(done.select(on).distinct().withColumn("__done", F.lit(True)), on, "left")
    return out.select(on, F.when(F.col("__done"), "SKIP").when(F.col("__there"), "OK").otherwise("MISSING").alias("status"))


def draw_commands(cells: DataFrame, by: str = "cluster", box: bool = True, polygon: bool = False, skip_unclassified: bool = True, text: bool = True) -> DataFrame:
    """Adds ``color, label, anchor_x, anchor_y, box, outline`` for drawing cells: geometry cut to whole pixels.

    ``box`` is null unless it has four numbers; the label's place is above the box's corner, or above the polygon's centre
    where there is no box. ``by`` picks what decides the colour: ``class``, ``cluster``, ``default`` or ``none`` (white). Cells that lack
    the geometry asked for are left out, and unclassified ones where classes are shown.
    """
    out = cells
    if skip_unclassified and (by == "class" or text):
        out = out.where(F.coalesce(F.col("pred_class") != "Unclassified", F.lit(True)))
    if box:
        out = out.where(F.coalesce(F.size("bbox") > 0, F.lit(False)))
    if polygon:
        out = out.where(F.coalesce(F.size("polygon") > 0, F.lit(False)))
    value = {"class": F.coalesce("pred_class", F.lit("N/A")), "cluster": F.coalesce(F.col("cluster_id").cast("string"), F.lit("N/A")), "default": F.lit("default")}.get(by)
    shade = F.array(*[F.lit(255)] * 3) if value is None else colour(value)
    whole = lambda v: v.cast("int")
    corner = F.transform("bbox", whole) if "bbox" in cells.columns else F.lit(None).cast("array<int>")
    line = F.transform("polygon", lambda p: F.transform(p, whole)) if "polygon" in cells.columns else F.lit(None).cast("array<array<int>>")
    if "polygon" in cells.columns:
        centre = F.transform(polygon_centre(F.col("polygon")), whole)
        place = [F.coalesce(F.try_element_at(corner, F.lit(i)), F.try_element_at(centre, F.lit(i))) for i in (1, 2)]
    else:
        place = [F.try_element_at(corner, F.lit(i)) for i in (1, 2)]
    return out.withColumns(
        {
            "color": shade,
            "label": cell_text(F.col("pred_class"), F.col("cluster_id"), F.col("confidence")) if text else F.lit(""),
            "anchor_x": F.greatest(F.lit(0), place[0]),
            "anchor_y": F.greatest(F.lit(0), place[1] - 10),
            "box": F.when(F.size(corner) == 4, corner) if box else F.lit(None).cast("array<int>"),
            "outline": line if polygon else F.lit(None).cast("array<array<int>>"),
        }
    )


def filtered_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``(key, removed)``: how many rows of each key a filter took away; keys that lost none have 0."""
    n = before.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    m = after.groupBy(key).agg(F.count(F.lit(1)).alias("__m"))
    return n.join(m, key, "left").select(key, (F.col("__n") - F.coalesce("__m", F.lit(0))).alias("removed"))


def nest_all(parents: DataFrame, cells: DataFrame, keys: list[str], order: list[str], fields: list[str], name: str = "cells") -> DataFrame:
    """Every parent with its cells as an ordered array, an empty one where it has none."""
    nested = parents.join(nest(cells, keys, order, fields, name), keys, "left")
    kind = dict(nested.dtypes)[name]
    return nested.withColumn(name, F.coalesce(name, F.array().cast(kind)))


def without_field(nested: DataFrame, name: str, field: str) -> DataFrame:
    """A column of structs, or of arrays of them, without one field."""
    kind = dict(nested.dtypes)[name]
    bare = F.transform(name, lambda c: c.dropFields(field)) if kind.startswith("array") else F.col(name).dropFields(field)
    return nested.withColumn(name, bare)


def cluster_counts(cells: DataFrame, group: str = "slide_id") -> DataFrame:
    """``(group, clusters, noise)``: clusters found and cells that belong to none."""
    real = F.when(F.col("cluster_id") != -1, F.col("cluster_id"))
    return cells.groupBy(group).agg(F.count_distinct(real).alias("clusters"), F.count_if(F.col("cluster_id") == -1).alias("noise"))


def class_counts(cells: DataFrame, keys: tuple[str, ...] = ("slide_id",)) -> DataFrame:
    return cells.groupBy(*keys, "pred_class").agg(F.count(F.lit(1)).alias("n"))


def draw_limit(commands: DataFrame, most: int, order: list[Column], keys: tuple[str, ...] = ("slide_id", "tile_id")) -> DataFrame:
    """At most ``most`` commands a tile, but at least one."""
    return commands.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("__r") <= max(most, 1)).drop("__r")


def hash_order(seed: int, *cols: str) -> Column:
    """A reproducible shuffle: order by MD5 of the seed and the columns, which every engine computes alike."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
