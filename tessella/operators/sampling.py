"""Quality-assurance sampling: per-slide budgets and batches of tiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .cells import hash_order


def tile_index(cells: DataFrame, keys: tuple[str, ...] = ("slide_id", "tile_id")) -> DataFrame:
    """Cells per non-empty tile."""
    return cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("cell_count"))


def index_totals(index: DataFrame) -> DataFrame:
    """Tiles and cells per slide and in total (``slide_id`` null)."""
    return index.rollup("slide_id").agg(F.count(F.lit(1)).alias("tiles"), F.sum("cell_count").alias("cells"))


def budget_sample(index: DataFrame, total: int, seed: int = 42) -> DataFrame:
    """Tiles of each slide in shuffled order until the cells before one reach the slide's share of ``total``."""
    spark = index.sparkSession
    before = W.partitionBy("slide_id").orderBy("shuffle", "tile_id").rowsBetween(W.unboundedPreceding, -1)
    run = index.withColumn("shuffle", hash_order(seed, "slide_id", "tile_id")).withColumn("before", F.coalesce(F.sum("cell_count").over(before), F.lit(0)))
    return spark.sql(f"SELECT * FROM {{run}} WHERE before < {float(total)}D / (SELECT count(DISTINCT slide_id) FROM {{index}})", run=run, index=index)


def batches(sample: DataFrame, count: int = 3, size: int = 1000) -> DataFrame:
    """``(slide_id, tile_id, cell_count, batch)``: tiles in shuffled order fill batches of at least ``size`` cells; surplus drops out.

    The fill restarts at every batch, so it runs in sequence; a sample has at most a few thousand tiles
    (``count * size`` cells decide its budget, whatever the data's size).
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["shuffle", "slide_id", "tile_id"])
        batch, cells, out = 1, 0, []
        for n in pdf["cell_count"]:
            out.append(batch)
            cells += n
            if cells >= size:
                batch, cells = batch + 1, 0
        pdf["batch"] = out
        return pdf.loc[pdf["batch"] <= count, ["slide_id", "tile_id", "cell_count", "batch"]].astype({"batch": "int32"})

    return sample.select("slide_id", "tile_id", "cell_count", "shuffle", F.lit(0).alias("one")).groupBy("one").applyInPandas(run, "slide_id string, tile_id long, cell_count long, batch int")


def manifest(batched: DataFrame) -> DataFrame:
    return batched.groupBy("batch").agg(F.count(F.lit(1)).alias("tiles"), F.sum("cell_count").alias("cells"), F.count_distinct("slide_id").alias("slides"))


def first_uri(places: DataFrame, key: str, uri: str, order: str) -> DataFrame:
    """The first place of each key."""
    return places.groupBy(key).agg(F.min_by(uri, order).alias(uri))
