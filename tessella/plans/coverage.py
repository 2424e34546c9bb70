"""Queries of operators that the analytical ones do not reach: folders written and read back, parsing, pixels, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import cells as C
from ..operators import crops, evaluate, masks, status
from ..session import partitions, scratch, table
from ..sources import files
from .analytics import CELLS, LABELS, MATCHED, SIDE, cells, label_pixels, labelled

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# ---- folders -------------------------------------------------------------------------------------------------------


@query("SELECT 'F' || file_id AS tile_name, label_id, list_extract(bbox, 1) AS x0, list_extract(bbox, 4) AS y1, count(*) AS n FROM tile_bboxes WHERE len(bbox) = 4 AND label_id IS NOT NULL AND file_id IS NOT NULL GROUP BY ALL")
def box_files_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every box file written as JSON by the tasks and read back; rows that are no boxes drop out."""
    root = scratch(spark, "boxes")
    t = table(spark, d, "tile_bboxes").where("file_id IS NOT NULL")
    one = t.groupBy("file_id").agg(F.to_json(F.collect_list(F.struct("label_id", "bbox"))).alias("content"))
    files.write_files(one, root, F.concat(F.lit("S"), (F.col("file_id") % 64).cast("string"), F.lit("/F"), F.col("file_id").cast("string"), F.lit("_bboxes.json")))
    b = files.box_files(spark, root)
    return b.groupBy("tile_name", "label_id", F.col("bbox")[0].alias("x0"), F.col("bbox")[3].alias("y1")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CELLS} SELECT slide_id, count(*) AS n, sum(cell_id)::BIGINT AS total FROM cells GROUP BY 1""")
def assignment_files_with_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Cluster assignments from the slides' own files, for half of the slides from the file at the root, which holds others' rows too."""
    root = scratch(spark, "assigned")
    c = cells(spark, d).select("slide_id", F.concat(F.lit("/x/"), F.col("slide_id"), F.lit("/t_bboxes.json")).alias("bbox_file"), F.col("cell_id").cast("int").alias("label_id"), "bbox", "cluster_id", "confidence")
    doc = F.to_json(F.collect_list(F.struct("bbox_file", "label_id", "bbox", "cluster_id", "confidence"))).alias("content")
    own = c.where(F.col("slide_id") < "S4").groupBy("slide_id").agg(doc)
    files.write_files(own, root, F.concat("slide_id", F.lit("/cluster_assignments.json")))
    files.write_files(c.where(F.col("slide_id") >= "S2").agg(doc), root, F.lit("cluster_assignments.json"))
    return files.cluster_assignments(spark, root).groupBy("slide_id").agg(F.count(F.lit(1)).alias("n"), F.sum("label_id").alias("total"))


@query("SELECT 'S' || (user_id % 8) AS slide_id, count(DISTINCT user_id) AS tiles, count(*) AS cells FROM events GROUP BY 1")
def classification_files_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Classified tiles as one JSON array a slide, two slides in the file at the root only."""
    root = scratch(spark, "classified")
    c = cells(spark, d)
    cell = F.struct(F.col("cell_id").cast("int").alias("label_id"), "bbox", F.lit("b").alias("bbox_file"), "pred_class", "cluster_id", F.col("confidence").alias("cluster_confidence"))
    tile = c.groupBy("slide_id", F.col("tile_id").cast("string").alias("tile_name")).agg(F.collect_list(cell).alias("classified_cells")).withColumn("tile_path", F.concat_ws("/", "slide_id", "tile_name"))
    doc = F.to_json(F.collect_list(F.struct("tile_path", "tile_name", "slide_id", "classified_cells"))).alias("content")
    files.write_files(tile.where("slide_id < 'S6'").groupBy("slide_id").agg(doc), root, F.concat("slide_id", F.lit("/classification_results.json")))
    files.write_files(tile.where("slide_id >= 'S5'").agg(doc), root, F.lit("classification_results.json"))
    back = files.classification_files(spark, root)
    return back.groupBy("slide_id").agg(F.count_distinct("tile_name").alias("tiles"), F.sum(F.size("classified_cells")).alias("cells"))


@query("SELECT 'S' || (user_id % 8) AS slide_id, CASE WHEN user_id % 8 < 4 THEN 'annotated' ELSE 'plain' END AS kind, count(DISTINCT user_id) AS tiles FROM events GROUP BY ALL")
def annotation_files_choice(spark: SparkSession, d: str) -> DataFrame:
    """Of a slide's JSON files the one with "annotation" in its name is read, else the first by name; done markers are none."""
    root = scratch(spark, "annotated")
    t = cells(spark, d).select("slide_id", F.col("tile_id").cast("string").alias("tile_path")).distinct()
    doc = lambda kind: F.to_json(F.collect_list(F.struct(F.concat_ws("/", F.lit(kind), "tile_path").alias("tile_path")))).alias("content")
    files.write_files(t.groupBy("slide_id").agg(doc("plain")), root, F.concat("slide_id", F.lit("/a_first.json")))
    files.write_files(t.groupBy("slide_id").agg(doc("later")), root, F.concat("slide_id", F.lit("/z_last.json")))
    files.write_files(t.where("slide_id < 'S4'").groupBy("slide_id").agg(doc("annotated")), root, F.concat("slide_id", F.lit("/final_annotations.json")))
    files.write_markers(t.select("slide_id").distinct().withColumn("result", F.lit("OK")), root)
    back = files.annotation_files(spark, root)
    return back.groupBy("slide_id", F.split("tile_path", "/")[0].alias("kind")).agg(F.count(F.lit(1)).alias("tiles"))


@query("SELECT 'P' || p_partkey AS slide_id, CASE WHEN p_partkey % 3 = 0 THEN 'ERROR:size ' || p_size ELSE 'OK' END AS result FROM part WHERE p_partkey % 2 = 0")
def done_markers_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Done markers written into the slides' folders and read back."""
    root = scratch(spark, "markers")
    result = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("ERROR:size "), F.col("p_size").cast("string"))).otherwise("OK")
    files.write_markers(table(spark, d, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("slide_id"), result.alias("result")), root)
    return files.checkpoints(spark, root)


@query(f"""WITH {CELLS} SELECT 'S' || s AS slide_id, count(*) AS n, min(cell_id) AS first_cell, sum(human_label)::BIGINT AS total FROM (SELECT user_id % 8 AS s, event_id AS cell_id, (event_id % 5)::INTEGER AS human_label FROM events) GROUP BY 1""")
def human_labels_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Saved label files of several sessions, read as cells."""
    root = scratch(spark, "human")
    c = cells(spark, d).withColumn("human_label", (F.col("cell_id") % 5).cast("int"))
    tiles = c.groupBy("slide_id", F.col("tile_id").cast("string").alias("tile_name")).agg(F.collect_list(F.struct(F.col("cell_id").cast("int").alias("cell_id"), "human_label")).alias("labelled_cells"))
    doc = tiles.groupBy("slide_id").agg(F.to_json(F.struct(F.lit("b").alias("batch"), F.collect_list(F.struct("slide_id", "tile_name", "labelled_cells")).alias("tiles"))).alias("content"))
    files.write_files(doc, root, F.concat(F.lit("batch_1/human_labels_"), "slide_id", F.lit(".json")))
    back = files.human_label_files(spark, root)
    return back.groupBy("slide_id").agg(F.count(F.lit(1)).alias("n"), F.min("cell_id").cast("long").alias("first_cell"), F.sum("human_label").alias("total"))


@query("SELECT 'slide ' || p_partkey AS slide_name FROM part WHERE p_partkey % 3 <> 2")
def slide_listing(spark: SparkSession, d: str) -> DataFrame:
    """A listing of paths with blanks, blank lines and other files, reduced to slide names."""
    k = F.col("p_partkey")
    line = F.when(k % 3 == 0, F.concat(F.lit("  /in/slide "), k.cast("string"), F.lit(".ndpi "))).when(k % 3 == 1, F.concat(F.lit("/in/slide "), k.cast("string"), F.lit(".NDPI"))).when(k % 2 == 0, "   ").otherwise("/in/readme.txt")
    return files.listed_slides(table(spark, d, "part").select(line.alias("line"))).select("slide_name")


@query(f"WITH {CELLS}, b AS (SELECT slide_id, tile_id, count(*) AS cell_count FROM cells GROUP BY ALL) SELECT slide_id, tile_id::VARCHAR AS tile_name, cell_count, (tile_id % 3 + 1)::INTEGER AS batch FROM b")
def qa_export(spark: SparkSession, d: str) -> DataFrame:
    """Batches exported as label documents with a manifest and read back as labelled tiles."""
    root = scratch(spark, "qa")
    c = cells(spark, d)
    tiles = c.groupBy("slide_id", F.col("tile_id").cast("string").alias("tile_name"), (F.col("tile_id") % 3 + 1).cast("int").alias("batch")).agg(F.count(F.lit(1)).alias("cell_count"))
    cell = F.struct(F.col("cell_id").cast("int").alias("cell_id"), F.lit(1).alias("label_id"), "pred_class", "cluster_id", F.col("confidence").alias("cluster_confidence"), "bbox")
    annotated = c.groupBy("slide_id", F.col("tile_id").cast("string").alias("tile_name")).agg(F.collect_list(cell).alias("cells"))
    annotated = annotated.withColumns({"tile_path": F.concat_ws("/", "slide_id", "tile_name"), "magnification": F.lit(1.0), "x": F.lit(0), "y": F.lit(0)})
    docs = files.qa_batch_documents(tiles, annotated).unionByName(files.qa_manifest_document(tiles, {"num_batches": 3, "random_seed": 42}))
    files.write_files(docs, root, F.col("name"))
    back = files.labelled_tiles(files.label_files(spark, root))
    return back.select("slide_id", "tile_name", F.size("cells").cast("long").alias("cell_count"), "batch")


# ---- names and lists -----------------------------------------------------------------------------------------------


@query("SELECT p_partkey, len(list_distinct(['a' || p_size, 'b', 'a' || p_size])) AS n, list_aggregate(list_sort(list_distinct([0.5 + p_size % 3, 0.5])), 'string_agg', ',') AS mags FROM part")
def filter_and_magnification_lists(spark: SparkSession, d: str) -> DataFrame:
    """Slide filters and magnifications given as text."""
    p = table(spark, d, "part")
    name = F.concat(F.lit("a"), F.col("p_size").cast("string"))
    wanted = names.split_list(F.concat(name, F.lit(" ,, b, "), name))
    mags = names.magnifications(F.concat((F.col("p_size") % 3 + 0.5).cast("string"), F.lit(", 0.5")))
    return p.select("p_partkey", F.size(wanted).cast("long").alias("n"), F.concat_ws(",", F.transform(F.reverse(mags), lambda m: F.format_string("%.1f", m))).alias("mags"))


@query("SELECT p_partkey, regexp_replace(p_name || '/ä', '[^\\p{L}\\p{N}._-]', '_', 'g') AS safe, p_partkey || '__' || p_size || '.png' AS image, 's3://b/' || p_size || '/t.png' AS uri FROM part")
def file_names_and_uris(spark: SparkSession, d: str) -> DataFrame:
    p, k, size = table(spark, d, "part"), F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    uri = names.tile_uri(F.concat(F.lit("/old/INPUT_prepped_tiles_path_7/"), size, F.lit("/t.png")), F.lit("s3://b//"))
    return p.select("p_partkey", names.safe_file_name(F.concat("p_name", F.lit("/ä"))).alias("safe"), names.image_name(k, F.when(F.col("p_partkey") % 2 == 0, F.concat(size, F.lit(".png"))).otherwise(size)).alias("image"), uri.alias("uri"))


@query("SELECT event_id, 'data:image/png;base64,' || to_base64(encode(event_type)) AS url FROM events")
def data_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", crops.data_url(F.encode("event_type", "UTF-8")).alias("url"))


# ---- nesting -------------------------------------------------------------------------------------------------------


@query("SELECT n_nationkey, count(c_custkey) AS n, coalesce(string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey), '') AS keys FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9000) ON c_nationkey = n_nationkey GROUP BY 1")
def parents_keep_empty_lists(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_acctbal > 9000").withColumnRenamed("c_nationkey", "n_nationkey")
    n = C.nest_all(table(spark, d, "nation").select("n_nationkey"), c, ["n_nationkey"], ["c_custkey"], ["c_custkey", "c_name"])
    return n.select("n_nationkey", F.size("cells").cast("long").alias("n"), F.concat_ws(",", F.transform("cells", lambda v: v["c_custkey"].cast("string"))).alias("keys"))


@query(f"WITH {CELLS} SELECT tile_id, '{{\"cells\":[' || string_agg('{{\"cell_id\":' || cell_id || '}}', ',' ORDER BY cell_id) || ']}}' AS doc FROM cells GROUP BY 1")
def field_dropped(spark: SparkSession, d: str) -> DataFrame:
    n = C.nest(cells(spark, d), ["tile_id"], ["cell_id"], ["cell_id", "pred_class"])
    return C.without_field(n, "cells", "pred_class").select("tile_id", F.to_json(F.struct("cells")).alias("doc"))


@query(f"WITH {CELLS} SELECT slide_id, count(*) FILTER (WHERE pred_class = 'error') AS removed FROM cells GROUP BY 1")
def removed_by_filter(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return C.filtered_counts(c, c.where("pred_class <> 'error'"), "slide_id")


@query("SELECT count(DISTINCT s_nationkey) AS wanted, count(DISTINCT s_nationkey) FILTER (WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)) AS matched FROM supplier")
def matched_slides(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("s_nationkey"))
    return status.matched_share(table(spark, d, "supplier"), rich, "s_nationkey")


@query("SELECT 'segment' AS stage, CASE WHEN p_partkey % 7 = 0 THEN 'ERROR' ELSE 'OK' END AS status, count(*) AS slides FROM part GROUP BY ALL")
def stage_results(spark: SparkSession, d: str) -> DataFrame:
    """Status rows appended by a stage in two batches, one of them run again, and summed up."""
    path = scratch(spark, "status")
    p = table(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("slide_id"), "p_partkey")
    result = F.when(F.col("p_partkey") % 7 == 0, "ERROR:empty").otherwise("OK")
    for batch in (0, 1, 1):
        part = p.where(F.col("p_partkey") % 2 == batch)
        status.record_status(part, "segment", batch, path, result)
    return status.result_summary(status.read_status(spark, path))


# ---- pixels --------------------------------------------------------------------------------------------------------


def label_rasters(spark: SparkSession, d: str) -> DataFrame:
    """The rasters of ``label_pixels``, each made in its row; keys are spread first, since a short table is one task's and its rasters are not."""
    k = F.col("p_partkey")
    keys = table(spark, d, "part").select(k).repartition(partitions(spark), k)
    at = lambda y, x: F.lit(0) if x % 4 == 3 or y % 4 == 3 else F.when((k + x) % 5 == 0, 0).otherwise(y // 4 * 3 + x // 4 + 1)
    return keys.select(k.alias("key"), F.lit(SIDE).alias("width"), F.array(*[at(i // SIDE, i % SIDE) for i in range(SIDE * SIDE)]).alias("labels"))


@query(f"WITH {LABELS} SELECT key, count(*) FILTER (WHERE label > 0) AS set_pixels, max(label) AS last_label FROM lp GROUP BY 1")
def mask_png_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Label rasters as 16-bit PNG files, written by the tasks, listed and decoded again."""
    root = scratch(spark, "masks")
    files.write_files(masks.mask_images(label_rasters(spark, d), ["key"]), root, F.concat(F.lit("m/"), F.col("key").cast("string"), F.lit("_mask.png")))
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    back = masks.read_masks(raw).withColumn("key", F.regexp_extract("path", r"(\d+)_mask\.png$", 1).cast("long"))
    return back.select("key", F.size(F.filter("labels", lambda v: v > 0)).cast("long").alias("set_pixels"), F.array_max("labels").alias("last_label"))


@query(f"WITH {LABELS}, b AS (SELECT key, label, max(x) - min(x) AS w, max(y) - min(y) AS h, count(*) AS n FROM lp WHERE label > 0 GROUP BY ALL) SELECT key, label AS label_id, (2 * (w + 1 + h + 1) + 1)::INTEGER AS n_points FROM b WHERE n = (w + 1) * (h + 1) AND label NOT IN (1, 2, 3, 4, 7)")
def rectangle_contours(spark: SparkSession, d: str) -> DataFrame:
    """Contours of full rectangles away from the raster's upper and left edge: one point for each side of a border pixel, and the first again."""
    m = label_rasters(spark, d)
    # outer: no raster is empty, and a filter on empty ones would make them before the keys are spread
    px = m.select("key", F.posexplode_outer("labels").alias("i", "label_id")).where("label_id > 0").selectExpr("key", "label_id", f"i div {SIDE} AS y", f"i % {SIDE} AS x")
    full = px.groupBy("key", "label_id").agg(((F.max("x") - F.min("x") + 1) * (F.max("y") - F.min("y") + 1) == F.count(F.lit(1))).alias("full")).where("full")
    poly = masks.polygons(m, ["key"]).select("key", "label_id", F.size("polygon").alias("n_points"))
    both = poly.join(full.hint("merge"), ["key", "label_id"])  # both grow with the pixels; the engine takes them for the size of the table of parts
    return both.where("label_id NOT IN (1, 2, 3, 4, 7)").select("key", "label_id", "n_points")


@query("SELECT p_partkey AS key, (p_partkey % 3 + 1)::INTEGER AS w, (p_partkey % 2 + 2)::INTEGER AS h, (p_partkey % 5 = 0) AS failed FROM part")
def cell_crops_cut(spark: SparkSession, d: str) -> DataFrame:
    """Crops cut out of PNG tiles that a task decodes once; every fifth tile is missing."""
    p = table(spark, d, "part").select("p_partkey", F.lit("s").alias("slide_id"), F.col("p_partkey").cast("string").alias("tile_name"))
    w, h = (F.col("p_partkey") % 3 + 1).cast("int"), (F.col("p_partkey") % 2 + 2).cast("int")
    boxes = p.withColumns({"label_id": F.lit(1), "bbox": F.array(F.lit(2), F.lit(3), w + 2, h + 3)})
    raster = p.select("slide_id", "tile_name", F.lit(8).alias("width"), F.array_repeat(F.lit(7), 64).alias("labels"), "p_partkey").where("p_partkey % 5 <> 0")
    tiles = masks.mask_images(raster, ["slide_id", "tile_name"])
    c = crops.cell_crops(boxes.select("slide_id", "tile_name", "label_id", "bbox"), tiles)
    png = lambda at: F.conv(F.hex(F.substring("crop", at, 4)), 16, 10).cast("int")
    size = lambda at, want: F.coalesce(png(at), want)
    wide, high = (F.col("tile_name").cast("long") % 3 + 1).cast("int"), (F.col("tile_name").cast("long") % 2 + 2).cast("int")
    return c.select(F.col("tile_name").cast("long").alias("key"), size(17, wide).alias("w"), size(21, high).alias("h"), F.coalesce(F.col("error") == crops.TILE_NOT_FOUND, F.lit(False)).alias("failed"))


@query(f"WITH {CELLS} SELECT cell_id, bbox[1] || ',' || bbox[2] || ',' || bbox[3] || ',' || bbox[4] AS box, (bbox[1] || ',' || bbox[2]) AS first_point, bbox[1] AS anchor_x, greatest(0, bbox[2] - 10) AS anchor_y FROM cells WHERE cell_id % 9 <> 0")
def drawing_geometry(spark: SparkSession, d: str) -> DataFrame:
    """Boxes and outlines cut to whole pixels; where classes are shown, unclassified cells are left out."""
    b = F.col("bbox")
    c = cells(spark, d).withColumn("polygon", F.array(F.array(b[0] + 0.7, b[1] + 0.2), F.array(b[2] + 0.5, b[3] + 0.5)))
    c = c.withColumn("pred_class", F.when(F.col("cell_id") % 9 == 0, "Unclassified").otherwise(F.col("pred_class")))
    g = C.draw_commands(c, "class", box=True, polygon=True)
    return g.select("cell_id", F.concat_ws(",", F.transform("box", lambda v: v.cast("string"))).alias("box"), F.concat_ws(",", F.transform(F.col("outline")[0], lambda v: v.cast("string"))).alias("first_point"), "anchor_x", "anchor_y")


# ---- evaluation ----------------------------------------------------------------------------------------------------

TABLES = f"""{MATCHED}, t AS (SELECT slide_id, tile_id, count(*) FILTER (WHERE human_label = 0 AND model_label = 0) AS a, count(*) FILTER (WHERE human_label = 0 AND model_label = 1) AS b,
  count(*) FILTER (WHERE human_label = 1 AND model_label = 0) AS c, count(*) FILTER (WHERE human_label = 1 AND model_label = 1) AS d FROM mt GROUP BY ALL)"""


@query(f"WITH {TABLES} SELECT slide_id, tile_id, (CASE WHEN a + d > b + c THEN [[a, b], [c, d]] ELSE [[b, a], [d, c]] END)::VARCHAR AS matrix FROM t WHERE a + d <> b + c AND a + b > 0 AND c + d > 0 AND a + c > 0 AND b + d > 0")
def confusion_matrices(spark: SparkSession, d: str) -> DataFrame:
    """Confusion of human and aligned labels of tiles with two labels on both sides and one best alignment."""
    counts = labelled(spark, d).groupBy("slide_id", "tile_id").agg(
        F.count_distinct("human_label").alias("h"), F.count_distinct("model_label").alias("m"), F.count_if(F.col("human_label") == F.col("model_label")).alias("same"), F.count(F.lit(1)).alias("n")
    )
    clear = counts.where("h = 2 AND m = 2 AND same * 2 <> n").select("slide_id", "tile_id")
    c = evaluate.confusion_matrix(evaluate.compared(labelled(spark, d).join(clear, ["slide_id", "tile_id"], "left_semi"), ["slide_id", "tile_id"]), ["slide_id", "tile_id"])
    row = lambda r: F.concat(F.lit("["), F.concat_ws(", ", F.transform(r, lambda v: v.cast("string"))), F.lit("]"))
    return c.select("slide_id", "tile_id", F.concat(F.lit("["), F.concat_ws(", ", F.transform("matrix", row)), F.lit("]")).alias("matrix"))


@query(f"WITH {MATCHED}, t AS (SELECT slide_id, tile_id, count(*) AS n, count(*) FILTER (WHERE human_label = model_label) AS same FROM mt GROUP BY ALL) SELECT sum(n)::BIGINT AS n_cells, round_even(sum(greatest(same, n - same)) / sum(n), 4) AS accuracy, 2::BIGINT AS n_human_clusters, 2::BIGINT AS n_model_clusters FROM t")
def evaluation_of_text_labels(spark: SparkSession, d: str) -> DataFrame:
    """The whole evaluation with labels that are text on both sides."""
    c = labelled(spark, d)
    on = ["slide_id", "tile_id", "cell_id"]
    human = c.select(*on, F.concat(F.lit("type "), F.col("human_label").cast("string")).alias("human_label"))
    model = c.select(*on, F.concat(F.lit("m"), F.col("model_label").cast("string")).alias("model_label"))
    return evaluate.evaluation(human, model, on, ["slide_id", "tile_id"])["summary"].select("n_cells", "accuracy", "n_human_clusters", "n_model_clusters")


@query(f"WITH {MATCHED} SELECT cell_id, CASE WHEN cell_id % 4 = 0 THEN 0 ELSE 3 END AS n_points FROM mt")
def compared_cells_with_polygons(spark: SparkSession, d: str) -> DataFrame:
    c = labelled(spark, d)
    shapes = c.where("cell_id % 4 <> 0").select("slide_id", "tile_id", "cell_id", F.array_repeat(F.array(F.lit(1.0), F.lit(2.0)), 3).alias("polygon"))
    return evaluate.with_polygons(c, shapes.union(shapes), ["slide_id", "tile_id", "cell_id"]).select("cell_id", F.size("polygon").alias("n_points"))
