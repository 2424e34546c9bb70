"""Readers and writers of the pipeline's folders: JSON documents, images, archives."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.names import base_name, image_name, run_stamp
from ..schemas import ANNOTATED_TILE, ASSIGNMENT, CHECKPOINT, CLASSIFIED_TILE, HUMAN_LABELS, LABEL_FILE

IMAGES = r"(?i)\.(png|jpg|tif)$"


def folder_of(path: Column) -> Column:
    """The name of the folder that a file lies in."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def list_files(spark: SparkSession, root: str, suffix: str = "") -> DataFrame:
    """``(path, size, modified)`` of the files under ``root`` whose name matches the suffix pattern; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return files.where(F.col("path").rlike(suffix)) if suffix else files


def slide_images(spark: SparkSession, root: str) -> DataFrame:
    """Whole-slide files by their suffix, whatever its case, with the slide's name."""
    f = list_files(spark, root, r"(?i)\.ndpi$")
    return f.withColumn("slide_name", F.regexp_replace(base_name(F.col("path")), r"(?i)\.ndpi$", ""))


def tile_images(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """``(slide_id, tile_name, path, content)`` of tiles; thumbnails, masks, boxes and statistics are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("path").rlike(IMAGES))
    name = base_name(F.col("path"))
    kept = files.where(~name.contains("__THUMBNAIL") & ~name.contains("_mask.") & ~name.contains("_bboxes.") & ~name.contains("_filter_stats"))
    return kept.select(folder_of(F.col("path")).alias("slide_id"), F.regexp_replace(name, IMAGES, "").alias("tile_name"), "path", *["content"] * content)


def decoded_images(spark: SparkSession, root: str) -> DataFrame:
    """``(slide_id, tile_name, path, height, width, channels, data)``: tiles decoded by the engine's image source (PNG, JPEG, TIFF as far as
    the Java runtime reads them), 8 bits, BGR. A file that cannot be decoded has no ``data``."""
    raw = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(root).select("image.*")
    name = base_name(F.col("origin"))
    kept = raw.where(F.col("origin").rlike(IMAGES) & ~name.contains("__THUMBNAIL") & ~name.contains("_mask.") & ~name.contains("_filter_stats"))
    return kept.select(
        folder_of(F.col("origin")).alias("slide_id"),
        F.regexp_replace(name, IMAGES, "").alias("tile_name"),
        F.col("origin").alias("path"),
        "height",
        "width",
        F.col("nChannels").alias("channels"),
        F.when(F.col("height") > 0, F.col("data")).alias("data"),
    )


def listed_slides(listing: DataFrame, column: str = "line") -> DataFrame:
    """``(path, slide_name)`` of the slide files named by lines of text: trimmed, without blank lines and other files."""
    path = F.trim(F.col(column))
    rows = listing.select(path.alias("path")).where(F.col("path").rlike(r"(?i)\.ndpi$"))
    return rows.withColumn("slide_name", F.regexp_replace(base_name(F.col("path")), r"(?i)\.ndpi$", ""))


def _json(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true")
    return reader.json(paths).withColumn("__path", F.col("_metadata.file_path"))


def box_files(spark: SparkSession, root: str) -> DataFrame:
    """``(slide_id, tile_name, bbox_file, label_id, bbox)`` of all box files; rows that are no boxes are left out."""
    text = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*_bboxes.json").text(root)
    entry = F.explode(F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")).alias("e")
    rows = text.select(F.col("_metadata.file_path").alias("path"), entry)
    boxes = rows.select("path", F.try_variant_get("e", "$.label_id", "int").alias("label_id"), F.try_variant_get("e", "$.bbox", "array<int>").alias("bbox"))
    good = boxes.where(F.col("label_id").isNotNull() & (F.size("bbox") == 4))
    return good.select(folder_of(F.col("path")).alias("slide_id"), F.regexp_extract("path", r"([^/]*)_bboxes\.json$", 1).alias("tile_name"), F.col("path").alias("bbox_file"), "label_id", "bbox")


def per_slide_or_global(rows: DataFrame, root: str, slide_in_row: Column) -> DataFrame:
    """Rows of slide folders; for slides without a folder of their own, the rows of a file at the root."""
    depth = F.size(F.split(F.regexp_replace("__path", r"^[a-z]+:/+", "/"), "/")) - len(root.replace("file:", "").rstrip("/").split("/"))
    tagged = rows.withColumn("__own", depth > 1).withColumn("slide_id", F.when(depth > 1, folder_of(F.col("__path"))).otherwise(slide_in_row))
    has = tagged.where("__own").select("slide_id").distinct()
    return tagged.where("__own").unionByName(tagged.where("NOT __own").join(has, "slide_id", "left_anti")).drop("__own", "__path")


def cluster_assignments(spark: SparkSession, root: str) -> DataFrame:
    rows = _json(spark, root, ASSIGNMENT).where(F.col("__path").rlike(r"cluster_assignments\.json$"))
    return per_slide_or_global(rows, root, folder_of(F.col("bbox_file")))


def classification_files(spark: SparkSession, root: str) -> DataFrame:
    """Classified tiles of each slide's own file; for slides without one, those of the file at the root."""
    rows = _json(spark, root, CLASSIFIED_TILE).where(F.col("__path").rlike(r"classification_results\.json$"))
    return per_slide_or_global(rows, root, F.col("slide_id"))


def annotation_files(spark: SparkSession, root: str) -> DataFrame:
    """Annotated tiles of one file for each slide folder: names with "annotation" first, then by name.

    A root without any JSON file is an error.
    """
    paths = list_files(spark, root, r"\.json$").select("path", folder_of(F.col("path")).alias("slide_id"), base_name(F.col("path")).alias("name"))
    order = W.partitionBy("slide_id").orderBy(F.col("name").contains("annotation").desc(), "name")
    chosen = paths.where("name <> '_checkpoint_done.json'").withColumn("r", F.row_number().over(order)).where("r = 1").select("slide_id", F.regexp_replace("path", "^file:/+", "/").alias("p"))
    if chosen.isEmpty():
        raise FileNotFoundError(f"no annotation file under {root}")
    rows = _json(spark, root, ANNOTATED_TILE).withColumn("p", F.regexp_replace("__path", "^file:/+", "/")).drop("__path")
    return rows.join(chosen, "p").drop("p")


def label_files(spark: SparkSession, root: str) -> DataFrame:
    """``cell_labels.json`` files as they are, with their folder."""
    rows = _json(spark, root, LABEL_FILE).where(F.col("__path").rlike(r"cell_labels\.json$"))
    return rows.withColumn("folder", folder_of(F.col("__path"))).drop("__path")


def human_label_files(spark: SparkSession, root: str) -> DataFrame:
    """Cells of all ``human_labels_*.json``: ``(slide_id, tile_name, cell_id, human_label, file)``."""
    rows = _json(spark, root, HUMAN_LABELS).where(F.col("__path").rlike(r"human_labels_[^/]*\.json$"))
    t = rows.select(base_name(F.col("__path")).alias("file"), F.explode("tiles").alias("t"))
    c = t.select("file", "t.slide_id", "t.tile_name", F.explode("t.labelled_cells").alias("c"))
    return c.select("slide_id", "tile_name", "c.cell_id", "c.human_label", "file")


def zipped_json(spark: SparkSession, root: str) -> DataFrame:
    """``(archive, name, stem, text)`` of the JSON entries of the archives under ``root``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
                        rows += [(path, n, n.rsplit("/", 1)[-1][:-5], z.read(n).decode("utf-8", "replace")) for n in sorted(z.namelist()) if n.endswith(".json")]
                except zipfile.BadZipFile:
                    continue
            yield pd.DataFrame(rows, columns=["archive", "name", "stem", "text"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(F.col("path").rlike(r"(?i)\.zip$"))
    return files.select("path", "content").mapInPandas(run, "archive string, name string, stem string, text string")


def checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """``(slide_id, result)`` of the done markers in the folders below ``root``; unreadable ones are left out.

    Spark's file sources skip names with a leading underscore, so the names are listed on the driver (one
    for each slide) and the files are opened by the tasks.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/_checkpoint_done.json")
    listed = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                system, inner = FileSystem.from_uri(path)
                with system.open_input_stream(inner) as f:
                    try:
                        d = json.loads(f.read())
                    except ValueError:
                        continue
                rows.append((d.get("slide_id"), d.get("result")))
            yield pd.DataFrame(rows, columns=["slide_id", "result"])

    return spark.createDataFrame([(re.sub("^file:/+", "file:///", s.getPath().toUri().toString()),) for s in listed], "path string").mapInPandas(run, CHECKPOINT)


def write_documents(df: DataFrame, path: str, by: str = "slide_id", drop_nulls: bool = True) -> None:
    """JSON lines in one folder for each value of ``by``; null fields are left out or written."""
    df.write.mode("overwrite").option("ignoreNullFields", str(drop_nulls).lower()).partitionBy(by).json(path)


def write_stage(df: DataFrame, path: str, by: str = "slide_id") -> None:
    """A stage's table as parquet, partitioned by slide; a rerun replaces the slides it holds. An empty marker file tells that it ended."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    spark = df.sparkSession
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def written(spark: SparkSession, path: str) -> bool:
    """Whether a stage's table was written to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_files(df: DataFrame, root: str, name: Column, content: str = "content") -> int:
    """Writes each row's bytes (or text) as the file ``name`` under ``root``, from the tasks; returns how many were written.

    ``root`` is a folder that all executors reach. A file is written aside and renamed, so a repeated task leaves no half.
    """
    import uuid as _uuid

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = FileSystem.from_uri(root if "://" in root or root.startswith("/") else f"file:///{root}")
        for pdf in batches:
            n = 0
            for to, data in zip(pdf["__to"], pdf["__data"]):
                if to is None or data is None:
                    continue
                path = f"{base.rstrip('/')}/{to}"
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                aside = f"{path}.{_uuid.uuid4().hex}"
                with system.open_output_stream(aside) as f:
                    f.write(data.encode() if isinstance(data, str) else bytes(data))
                system.move(aside, path)
                n += 1
            yield pd.DataFrame({"n": [n]})

    rows = df.select(name.alias("__to"), F.col(content).alias("__data"))
    return rows.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()[0]


def write_markers(status: DataFrame, root: str) -> int:
    """A ``_checkpoint_done.json`` in each slide's folder, from rows ``slide_id, result``."""
    text = status.withColumn("content", F.to_json(F.struct("slide_id", "result")))
    return write_files(text, root, F.concat("slide_id", F.lit("/_checkpoint_done.json")))


def qa_batch_documents(batched: DataFrame, annotated: DataFrame) -> DataFrame:
    """``(name, content)``: ``batch_N/cell_labels.json`` for each batch of tiles, with the annotations of those tiles.

    ``batched`` has ``slide_id, tile_name, batch``; ``annotated`` has a tile's ``slide_id, tile_name, tile_path, magnification, x, y,
    cells``. A batch holds what a labelling session takes, so one document is small.
    """
    fields = ("slide_id", "tile_name", "tile_path", "magnification", "x", "y", "cells")
    tiles = batched.select("slide_id", "tile_name", "batch").join(annotated.select(*fields), ["slide_id", "tile_name"])
    one = tiles.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("tiles"))
    text = F.to_json(F.struct("batch", "tiles"), {"ignoreNullFields": "false"})
    return one.select(F.concat(F.lit("batch_"), F.col("batch").cast("string"), F.lit("/cell_labels.json")).alias("name"), text.alias("content"))


def qa_manifest_document(sample: DataFrame, parameters: dict) -> DataFrame:
    """``(name, content)``: one ``manifest.json`` with the run's parameters, totals by batch and the tiles of ``sample``
    (``batch, slide_id, tile_name, cell_count`` and what else it has)."""
    per = sample.groupBy("batch").agg(F.count(F.lit(1)).alias("tiles"), F.sum("cell_count").alias("cells"))
    batches = per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("batch_"), F.col("batch").cast("string")), F.struct("tiles", "cells"))))).alias("batches"))
    tiles = sample.agg(F.sort_array(F.collect_list(F.struct("batch", "slide_id", "tile_name", *[c for c in sample.columns if c not in ("batch", "slide_id", "tile_name")]))).alias("tiles"), F.sum("cell_count").alias("total_cells_sampled"))
    head = [F.lit(v).alias(k) for k, v in parameters.items()]
    body = F.struct(*head, F.size("tiles").alias("total_tiles_sampled"), "total_cells_sampled", "batches", "tiles")
    return batches.crossJoin(tiles).select(F.lit("manifest.json").alias("name"), F.to_json(body, {"ignoreNullFields": "false"}).alias("content"))  # one row each


def human_label_list(spark: SparkSession, root: str) -> DataFrame:
    """``(path, name)`` of the saved label files, by name."""
    files = list_files(spark, root, r"human_labels_[^/]*\.json$")
    return files.select("path", base_name(F.col("path")).alias("name")).orderBy("name", "path")


def write_archive(df: DataFrame, name: str, text: str, path: str) -> int:
    """Rows ``name, text`` as one zip archive on the driver's disk, streamed row by row; returns their number."""
    n = 0
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for row in df.select(name, text).toLocalIterator():
            z.writestr(row[0], row[1])
            n += 1
    return n


def pretty(record: dict, indent: int = 2) -> str:
    return json.dumps(record, ensure_ascii=False, indent=indent)


def find_batches(spark: SparkSession, root: str) -> list[str]:
    """Folders named ``batch_*`` in ``root``, else in its first folder that has some, sorted by name."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(path) -> list:  # noqa: ANN001
        return sorted((s.getPath() for s in fs.listStatus(path) if s.isDirectory()), key=lambda p: p.getName())

    def batches(path) -> list[str]:  # noqa: ANN001
        return [p.toString() for p in folders(path) if p.getName().startswith("batch_")]

    if not fs.exists(hadoop):
        return []
    return batches(hadoop) or next((b for p in folders(hadoop) if (b := batches(p))), [])


def labelled_tiles(files: DataFrame) -> DataFrame:
    """Tiles of label files, each with the name of its image."""
    t = files.select("batch", "folder", F.posexplode("tiles").alias("tile_index", "t")).select("batch", "folder", "tile_index", "t.*")
    return t.withColumn("image_filename", image_name(F.col("slide_id"), F.col("tile_name")))


def save_stamped(df: DataFrame, folder: str, kind: str) -> None:
    """Appends rows as JSON under the time of the call, as ``human_labels`` or ``eval_metrics`` are kept."""
    df.withColumn("kind", F.lit(kind)).withColumn("stamp", run_stamp()).write.mode("append").partitionBy("kind", "stamp").json(folder)
