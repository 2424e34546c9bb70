"""The staged pipeline as lazily composed DataFrames.

A stage is a function of the tables before it; ``start_from`` reads the tables of earlier stages instead of
computing them. Models are plug-ins called on Arrow batches: a segmenter gives masks, an embedder vectors, a
classifier names; where tiles have ``content`` (image bytes), embedder and classifier get each cell's pixels in a
column ``crop``. Without plug-ins simple stand-ins run, which are no substitute for trained models.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import STAGES, PipelineConfig
from ..functions import names
from ..operators import cells as C
from ..operators import crops, density, masks, quality, tiling
from ..session import cut, partitions
from ..sources.files import write_stage, written


def box_shape_embedding(boxes: DataFrame) -> DataFrame:
    """Stand-in embedder: a box's size and place as a vector."""
    b = F.col("bbox")
    parts = [b[2] - b[0], b[3] - b[1], (b[2] + b[0]) / 2, (b[3] + b[1]) / 2]
    return boxes.withColumn("embedding", F.array(*[p.cast("double") for p in parts]))


def size_class(cells: DataFrame) -> DataFrame:
    """Stand-in classifier: large or small by the box's area."""
    b = F.col("bbox")
    area = (b[2] - b[0]) * (b[3] - b[1])
    return cells.withColumn("pred_class", F.when(area.isNull(), "Undetermined").when(area > 400, "Large").otherwise("Small"))


def batched_classifier(call: Callable[[list[bytes]], list[str]], column: str, schema: str) -> Callable[[DataFrame], DataFrame]:
    """Wraps a model call into a stage: it runs on Arrow batches, and a failing batch is retried row by row.

    A row whose call fails keeps the error class instead of a label.
    """

    def stage(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                try:
                    labels = call(list(pdf[column]))
                except Exception:  # noqa: BLE001 - a model may raise anything
                    labels = []
                    for item in pdf[column]:
                        try:
                            labels.append(call([item])[0])
                        except Exception as e:  # noqa: BLE001
                            labels.append("Error - Rate Limited" if "rate" in str(e).lower() else "Error - Exception")
                yield pdf.assign(raw_label=labels)

        return df.mapInPandas(run, f"{schema}, raw_label string").withColumn("pred_class", names.clean_label(F.col("raw_label"))).drop("raw_label")

    return stage


@dataclass
class Plugins:
    segmenter: Callable[[DataFrame], DataFrame] = field(default=lambda tiles: masks.threshold_segment(tiles, ["slide_id", "tile_name"]))
    embedder: Callable[[DataFrame], DataFrame] = box_shape_embedding
    classifier: Callable[[DataFrame], DataFrame] = size_class


def run_pipeline(tables: dict[str, DataFrame], cfg: PipelineConfig, plugins: Plugins | None = None, store: str | None = None, spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """All tables from ``cfg.start_from`` on. ``tables`` holds the inputs of the first stage to run:

    ``slides`` (slide_id, width, height) and, from ``tile_filter`` on, ``tiles`` (slide_id, tile_name, width, gray
    ARRAY<INT>, and the statistics or ``rgb``); later stages take the outputs of earlier ones. With ``store`` each
    stage is written as parquet and read back, and with ``cfg.resume`` a stage found there is not computed.
    """
    plugins = plugins or Plugins()
    out = dict(tables)
    first = STAGES.index(cfg.start_from)

    def keep(name: str, make: Callable[[], DataFrame], stage: str) -> None:
        if STAGES.index(stage) < first and name in out:
            return
        path = f"{store}/{name}" if store else None
        if path and cfg.resume and spark is not None and written(spark, path):
            out[name] = spark.read.parquet(path)
            return
        df = make()
        if path:
            write_stage(df, path)
            df = df.sparkSession.read.parquet(path)
        elif name in ("masks", "boxes", "assignments"):
            df = cut(df)  # read by several later stages
        out[name] = df

    def chosen(df: DataFrame) -> DataFrame:
        if not cfg.slide_filter:
            return df
        wanted = [cfg.slide_filter[i] for i in range(len(cfg.slide_filter))]
        ids = F.array(*[F.lit(w) for w in wanted])
        return df.where(F.array_contains(names.filter_names(ids), F.col("slide_id")))

    if first <= STAGES.index("data_prep") and "slides" in out:
        keep("grid", lambda: tiling.with_names(tiling.grid(chosen(out["slides"]), list(cfg.magnifications), cfg.num_tiles, cfg.tile_size)), "data_prep")
    if "tiles" not in out and "boxes" not in out:
        return out
    if "tiles" in out:
        if cfg.filter_tiles and first <= STAGES.index("tile_filter") and "edge_density" in out["tiles"].columns:
            stats = [c for c in out["tiles"].columns if c not in ("gray", "rgb", "content")]
            keep("tile_stats", lambda: quality.filtered(chosen(out["tiles"]).select(*stats), cfg.limits()), "tile_filter")
            keep("kept_tiles", lambda: quality.filtered(chosen(out["tiles"]), cfg.limits()).where("useful"), "tile_filter")
        else:
            out["kept_tiles"] = chosen(out["tiles"])
        keep("masks", lambda: plugins.segmenter(out["kept_tiles"]).where("labels IS NOT NULL"), "segment")
        keep("boxes", lambda: masks.boxes_of_rasters(out["masks"], ["slide_id", "tile_name"]), "segment")
        keep("polygons", lambda: masks.polygons(out["masks"], ["slide_id", "tile_name"]), "segment")

    def with_pixels(cells: DataFrame) -> DataFrame:
        if "tiles" not in out or "content" not in out["tiles"].columns:
            return cells
        pixels = crops.cell_crops(cells.select("slide_id", "tile_name", "label_id", "bbox"), out["tiles"].select("slide_id", "tile_name", "content"))
        return cells.join(pixels.drop("bbox", "error"), ["slide_id", "tile_name", "label_id"], "left")

    def assign() -> DataFrame:
        boxes = out["boxes"].where(masks.valid_box(F.col("label_id"), F.col("bbox")) & masks.croppable(F.col("bbox")))
        cells = plugins.embedder(with_pixels(boxes)).where("embedding IS NOT NULL").drop("crop")  # a cell that has no embedding drops out
        keyed = cells.withColumn("cell_key", F.concat_ws("|", "slide_id", "tile_name", F.lpad(F.col("label_id").cast("string"), 8, "0")))
        kept = ("tile_name", "label_id", "bbox")
        got = density.density_clusters(keyed, "slide_id", "cell_key", "embedding", cfg.cluster_min_samples, cfg.cluster_eps, cfg.cluster_normalize, cfg.cluster_metric, kept)
        return got.select("slide_id", "cell_key", *kept, "cluster_id", "confidence")

    keep("assignments", assign, "cluster")

    def classify() -> DataFrame:
        cells = out["assignments"]
        chosen_cells = C.select_for_labelling(cells, cfg.classify_per_cluster, tie=("tile_name", "label_id")).drop("rank")
        named = cut(plugins.classifier(with_pixels(chosen_cells)).select("slide_id", "tile_name", "label_id", "pred_class"))  # the model is called once
        return C.join_predictions(cells, named, ["slide_id", "tile_name", "label_id"])

    keep("classified", classify, "classify")

    def annotate() -> DataFrame:
        cells = out["classified"].withColumn("pos", F.lit(0))
        on = ["slide_id", "tile_name", "label_id"]
        joined = C.first_match(out["polygons"], cells, on, "pos") if "polygons" in out else cells.drop("pos").withColumn("polygon", F.lit(None).cast("array<array<double>>"))
        return C.number_cells(joined, ["tile_name", "label_id"]).withColumnRenamed("new_cell_id", "cell_id")

    keep("annotations", annotate, "post_process")
    keep("representatives", lambda: C.representatives(out["annotations"], cfg.analyzer_threshold, cfg.analyzer_max_items), "cluster_tiles")
    keep("statistics", lambda: C.cluster_statistics(out["representatives"]), "cluster_tiles")
    keep(
        "drawing",
        lambda: C.draw_limit(
            C.draw_commands(out["annotations"], cfg.color_by, box=cfg.draw_box, polygon=cfg.draw_polygon), cfg.max_labels, [F.col("cell_id")], ("slide_id", "tile_name")
        ),
        "annotate",
    )
    return out


def demo_tiles(part: DataFrame, side: int = 12) -> DataFrame:
    """Small grey tiles computed from ``part`` keys, for trying the pipeline: every part is a tile of slide ``key % 8``."""
    keys = part.select("p_partkey").repartition(partitions(part.sparkSession), "p_partkey")  # a short table is one task's, its tiles are not
    edge = lambda i: i % side % 4 == 3 or i // side % 4 == 3
    gray = F.array(*[F.lit(255) if edge(i) else ((F.lit(i * 7) + F.col("p_partkey")) % 120).cast("int") for i in range(side * side)])
    return keys.select(
        F.concat(F.lit("S"), (F.col("p_partkey") % 8).cast("string")).alias("slide_id"),
        F.concat(F.lit("T"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("tile_name"),
        F.lit(side).alias("width"),
        gray.alias("gray"),
    )


