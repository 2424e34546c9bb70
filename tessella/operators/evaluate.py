"""Agreement of human and model labels: matching, optimal alignment per tile, accuracy, confusion."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..kernels.assign import align
from .grouped import map_groups


def matched(human: DataFrame, model: DataFrame, on: list[str], position: str | None = None) -> DataFrame:
    """Cells labelled by both: ``human`` rows stay as they are, the last model row of a key counts."""
    m = model.where(F.col("model_label").isNotNull())
    if position is not None:
        m = m.groupBy(*on).agg(F.max_by("model_label", position).alias("model_label"))
    return human.join(m.select(*on, "model_label"), on)


def contingency(cells: DataFrame, tile: list[str]) -> DataFrame:
    """Counts of human and model labels per tile, with contiguous indexes from 0."""
    counts = cells.groupBy(*tile, "human_label", "model_label").agg(F.count(F.lit(1)).alias("n"))
    h, m = W.partitionBy(*tile).orderBy("human_label"), W.partitionBy(*tile).orderBy("model_label")
    return counts.withColumn("h_index", F.dense_rank().over(h) - 1).withColumn("m_index", F.dense_rank().over(m) - 1)


def aligned_labels(counts: DataFrame, tile: list[str]) -> DataFrame:
    """``(tile, model_label, aligned_label)``: each model label with the human label that the best assignment gives it, or null.

    Labels may be of any type: the assignment runs on their indexes, and the human label is looked up by its index.
    """
    kinds = dict(counts.dtypes)

    def run(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        table = np.zeros((g["m_index"].max() + 1, g["h_index"].max() + 1))
        np.add.at(table, (g["m_index"], g["h_index"]), g["n"])
        models, first = np.unique(g["m_index"], return_index=True)
        return {c: g[c][first] for c in tile} | {"m_index": models, "h_index": align(table)}

    schema = ", ".join(f"{c} {kinds[c]}" for c in tile)
    best = map_groups(counts.select(*tile, "m_index", "h_index", "n"), tile, run, f"{schema}, m_index int, h_index int")
    model = counts.select(*tile, "m_index", "model_label").distinct()
    human = counts.select(*tile, "h_index", F.col("human_label").alias("aligned_label")).distinct()
    return model.join(best, [*tile, "m_index"]).join(human, [*tile, "h_index"], "left").select(*tile, "model_label", "aligned_label")


def compared(cells: DataFrame, tile: list[str]) -> DataFrame:
    """Cells with their aligned label and whether it agrees."""
    pairs = aligned_labels(contingency(cells, tile), tile)
    return cells.join(pairs, [*tile, "model_label"]).withColumn("match", F.coalesce(F.col("aligned_label") == F.col("human_label"), F.lit(False)))


def accuracy(comparison: DataFrame) -> DataFrame:
    """One row: cells, matches and the share of matches to four places, half to even; 0 for no cells."""
    n, hit = F.count(F.lit(1)), F.coalesce(F.sum(F.col("match").cast("int")), F.lit(0))
    return comparison.agg(n.alias("n_cells"), hit.alias("matched"), F.bround(F.coalesce(F.try_divide(hit, n), F.lit(0.0)), 4).alias("accuracy"))


def confusion(comparison: DataFrame, tile: list[str]) -> DataFrame:
    """Counts of human and aligned labels per tile; cells whose label found no partner are left out."""
    return comparison.where("aligned_label IS NOT NULL").groupBy(*tile, "human_label", "aligned_label").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(comparison: DataFrame, tile: list[str]) -> DataFrame:
    """``(tile, labels, matrix)``: the confusion of each tile over the union of its human and aligned labels, in order.

    ``matrix[i][j]`` counts cells of human label ``i`` and aligned label ``j``; labels that occur on one side only have
    a row or column of zeros. Cells whose label found no partner are left out of the matrix, their human label is not.
    """
    both = F.array_distinct(F.concat(F.collect_set("human_label"), F.collect_set("aligned_label")))
    labels = comparison.groupBy(*tile).agg(F.array_sort(both).alias("labels"))
    counts = confusion(comparison, tile).groupBy(*tile).agg(F.map_from_entries(F.collect_list(F.struct(F.struct("human_label", "aligned_label"), F.col("n")))).alias("cells"))
    matrix = F.transform("labels", lambda h: F.transform("labels", lambda m: F.coalesce(F.try_element_at("cells", F.struct(h.alias("human_label"), m.alias("aligned_label"))), F.lit(0))))
    return labels.join(counts, tile, "left").select(*tile, "labels", matrix.alias("matrix"))


def distinct_labels(comparison: DataFrame) -> DataFrame:
    """One row: how many different human and model labels occur."""
    return comparison.agg(F.count_distinct("human_label").alias("n_human_clusters"), F.count_distinct("model_label").alias("n_model_clusters"))


def with_polygons(comparison: DataFrame, polygons: DataFrame, on: list[str]) -> DataFrame:
    """Compared cells with their polygon, or an empty one; the first polygon of a key (smallest) counts."""
    one = polygons.groupBy(*on).agg(F.min("polygon").alias("polygon"))
    return comparison.join(one, on, "left").withColumn("polygon", F.coalesce("polygon", F.array().cast("array<array<double>>")))


class NothingToCompare(ValueError):
    """No cell has both a human and a model label."""


def evaluation(human: DataFrame, model: DataFrame, on: list[str], tile: list[str], polygons: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole response as tables: ``summary`` (one row), ``cells`` (with polygons), ``confusion`` (one row a tile).

    Raises ``NothingToCompare`` if no labelled cell is in both.
    """
    both = matched(human, model, on)
    if both.isEmpty():
        raise NothingToCompare("no cell has both a human and a model label")
    cells = compared(both, tile)
    summary = accuracy(cells).crossJoin(distinct_labels(cells))  # one row each
    shown = cells if polygons is None else with_polygons(cells, polygons, on)
    return {"summary": summary, "cells": shown, "confusion": confusion_matrix(cells, tile)}
