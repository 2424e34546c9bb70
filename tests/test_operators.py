import pytest
import zipfile
from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from tessella.config import PipelineConfig
from tessella.kernels.raster import write_png16
from tessella.operators import cells as C
from tessella.operators import density, evaluate, masks, quality, status
from tessella.plans.pipeline import Plugins, batched_classifier, demo_tiles, run_pipeline
from tessella.sources import files

CELLS = "slide_id string, tile_id long, cell_id long, cluster_id int, confidence double"


def cells(spark):
    rows = [("s", 1, 1, 0, 0.9), ("s", 1, 2, 0, 0.9), ("s", 2, 3, 0, None), ("s", 2, 4, -1, 0.0), ("s", 2, 5, None, 0.8), ("s", 2, None, 0, 0.8)]
    return spark.createDataFrame(rows, CELLS)


def test_representatives(spark):
    c = cells(spark)
    assert [r.cell_id for r in C.representatives(c, 0.5, 1).collect()] == [1]
    assert C.representatives(c, 0.0, 0).count() == 0
    assert C.representatives(c).count() == 4
    assert {r.cell_id for r in C.representatives(c, 0.9).collect()} == {1, 2}
    assert C.select_for_labelling(c, 0).count() == 0


def test_limits_pass_when_equal(spark):
    row = spark.createDataFrame([(0.02, 0.8, 0.8, 10.0, 50.0, 5.0), (0.01, 0.9, 0.0, 10.0, 50.0, 5.0)], "edge_density double, bright_pixels_ratio double, dark_pixels_ratio double, std_intensity double, laplacian_var double, color_variance double")
    got = sorted(quality.filtered(row).collect(), key=lambda r: r.edge_density)
    assert got[1].useful and got[1].rejection_reasons == []
    assert got[0].rejection_reasons == ["low_edge_density (0.0100 < 0.02)", "too_bright (0.90 > 0.8)"]


def test_status(spark):
    w = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "slide_id string")
    got = {r.slide_id: r.status for r in C.status_split(w, w.where("slide_id = 'a'"), "slide_id", w.where("slide_id = 'b'")).collect()}
    assert got == {"a": "OK", "b": "SKIP", "c": "MISSING"}
    names = spark.createDataFrame([("x.json", "1"), ("x.json", "2"), ("y", "3"), ("y", "4")], "name string, path string")
    assert {r.path: r.unique_name for r in status.unique_names(names, "name", "path").collect()} == {"1": "x.json", "2": "x_1.json", "3": "y", "4": "y_1"}


def test_evaluation_of_uneven_labels(spark):
    rows = [("t", i, h, m) for i, (h, m) in enumerate([(1, 7), (1, 7), (2, 7), (2, 9)])]
    c = spark.createDataFrame(rows, "tile string, cell_id long, human_label long, model_label int")
    comp = evaluate.compared(c, ["tile"])
    acc = evaluate.accuracy(comp).first()
    assert (acc.n_cells, acc.matched, acc.accuracy) == (4, 3, 0.75)
    one = c.withColumn("human_label", F.lit(1).cast("long"))
    comp = evaluate.compared(one, ["tile"])
    assert evaluate.confusion(comp, ["tile"]).count() == 1
    assert evaluate.accuracy(comp.where("false")).first().accuracy == 0


def test_density_forms_agree(spark):
    rng = np.random.default_rng(1)
    pts = [(i % 2, i, (rng.normal(0, 0.1, 3) + (i // 10 % 3)).tolist()) for i in range(120)]
    p = spark.createDataFrame(pts, "g int, k long, v array<double>")
    a = {(r.k): r.cluster_id for r in density.density_clusters(p, "g", "k", "v", 4, 0.3).collect()}
    b = {(r.k): r.cluster_id for r in density.density_labels(p, density.range_edges(p, "g", "k", "v", 0.3), "g", "k", 4).collect()}
    assert a == b and max(a.values()) >= 2
    few = density.density_clusters(p.where("k < 3"), "g", "k", "v", 5).collect()
    assert {r.cluster_id for r in few} == {-1}


def test_polygons_and_masks(spark, tmp_path):
    m = np.zeros((4, 4), np.uint16)
    m[1:3, 1:3] = 300
    (tmp_path / "t_mask.png").write_bytes(write_png16(m))
    (tmp_path / "bad_mask.png").write_bytes(b"x")
    got = masks.read_masks(spark.read.format("binaryFile").load(str(tmp_path)))
    row = got.collect()
    assert len(row) == 1 and row[0].width == 4 and max(row[0].labels) == 300
    poly = masks.polygons(got, ["path"]).collect()
    assert len(poly) == 1 and poly[0].label_id == 300


def test_files(spark, tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "t1_bboxes.json").write_text('[{"label_id": 1, "bbox": [0, 0, 2, 2]}, {"label_id": 2, "bbox": [1]}, {"bbox": [1, 2, 3, 4]}, 5]')
    (tmp_path / "s1" / "cluster_assignments.json").write_text('[{"bbox_file": "/o/s1/t1_bboxes.json", "label_id": 1, "cluster_id": 4}]')
    (tmp_path / "cluster_assignments.json").write_text('[{"bbox_file": "/o/s1/t1_bboxes.json", "label_id": 1, "cluster_id": 5}, {"bbox_file": "/o/s2/t_bboxes.json", "label_id": 1, "cluster_id": 6}]')
    (tmp_path / "A.NDPI").write_text("x")
    assert [tuple(r) for r in files.box_files(spark, str(tmp_path)).select("slide_id", "tile_name", "label_id").collect()] == [("s1", "t1", 1)]
    got = {(r.slide_id, r.cluster_id) for r in files.cluster_assignments(spark, str(tmp_path)).collect()}
    assert got == {("s1", 4), ("s2", 6)}
    assert [r.slide_name for r in files.slide_images(spark, str(tmp_path)).collect()] == ["A"]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d/x.json", "{}")
        z.writestr("d/x.txt", "")
    assert [(r.name, r.stem, r.text) for r in files.zipped_json(spark, str(tmp_path)).collect()] == [("d/x.json", "x", "{}")]


def test_pipeline(spark, data, tmp_path):
    part = spark.read.parquet(f"{data}/part.parquet").limit(40)
    cfg = PipelineConfig(start_from="segment", filter_tiles=False, cluster_eps=2.0, slide_filter=("S1",), analyzer_threshold=0.1, resume=True, draw_box=True)
    out = run_pipeline({"tiles": demo_tiles(part)}, cfg, store=str(tmp_path / "run"), spark=spark)
    first = out["annotations"].count()
    assert first == 5 * 9
    assert {r.slide_id for r in out["annotations"].select("slide_id").distinct().collect()} == {"S1"}
    again = run_pipeline({"tiles": demo_tiles(part)}, cfg, store=str(tmp_path / "run"), spark=spark)
    assert again["annotations"].count() == first
    assert out["drawing"].count() == first and out["representatives"].count() > 0


def test_failing_model(spark):
    def call(items):
        if any(i == 13 for i in items):
            raise RuntimeError("Rate limit")
        return [f"**c{i}**" for i in items]

    df = spark.createDataFrame([(12,), (13,)], "item long").coalesce(1)
    got = {r.item: r.pred_class for r in batched_classifier(call, "item", "item long")(df).collect()}
    assert got == {12: "c12", 13: "Error - Rate Limited"}
    assert Plugins().classifier and datetime


def test_batches_and_labels(spark, tmp_path):
    for name in ("runs/batch_2", "runs/batch_1", "runs/other", "empty"):
        (tmp_path / name).mkdir(parents=True)
    (tmp_path / "runs/batch_1/cell_labels.json").write_text('{"batch": 1, "tiles": [{"slide_id": "s", "tile_name": "t", "cells": []}]}')
    root = str(tmp_path)
    assert [p.rsplit("/", 1)[1] for p in files.find_batches(spark, root + "/runs")] == ["batch_1", "batch_2"]
    assert [p.rsplit("/", 1)[1] for p in files.find_batches(spark, root)] == ["batch_1", "batch_2"]
    assert files.find_batches(spark, root + "/empty") == [] and files.find_batches(spark, root + "/none") == []
    row = files.labelled_tiles(files.label_files(spark, root + "/runs/batch_1")).first()
    assert (row.folder, row.image_filename, row.tile_index) == ("batch_1", "s__t.png", 0)
    files.save_stamped(spark.createDataFrame([(1,)], "n int"), root + "/saved", "eval_metrics")
    assert spark.read.json(root + "/saved").count() == 1


def test_readers_and_writers(spark, tmp_path):
    tiles = tmp_path / "tiles" / "s1"
    tiles.mkdir(parents=True)
    flat = np.full((4, 4), 250, np.uint16)
    for name in ("t1.png", "t2.PNG", "s1__THUMBNAIL.png", "t1_mask.png", "t3.txt"):
        (tiles / name).write_bytes(write_png16(flat))
    (tiles / "broken.png").write_bytes(b"no image")
    found = files.tile_images(spark, str(tmp_path / "tiles"))
    assert {(r.slide_id, r.tile_name) for r in found.collect()} == {("s1", "t1"), ("s1", "t2"), ("s1", "broken")}
    stats = {r.path.rsplit("/", 1)[1]: r.bright_pixels_ratio for r in quality.image_stats(found).collect()}
    assert stats["t1.png"] == 1.0 and stats["broken.png"] is None or np.isnan(stats["broken.png"])

    docs = tmp_path / "docs"
    for slide, name, text in (
        ("s1", "a.json", '[{"tile_path": "wrong"}]'),
        ("s1", "v1_annotations.json", '[{"tile_path": "p1", "magnification": 1.0, "cells": [{"cell_id": 1}]}]'),
        ("s1", "_checkpoint_done.json", '{"slide_id": "s1", "result": "OK:1"}'),
        ("s2", "final.json", '[{"tile_path": "p2", "cells": []}]'),
        ("s1", "classification_results.json", '[{"tile_name": "t", "classified_cells": [{"label_id": 1, "pred_class": "A"}]}]'),
        ("b", "human_labels_1.json", '{"batch": "b", "tiles": [{"slide_id": "s", "tile_name": "t", "labelled_cells": [{"cell_id": 1, "human_label": 2}]}]}'),
    ):
        (docs / slide).mkdir(parents=True, exist_ok=True)
        (docs / slide / name).write_text(text)
    got = {(r.slide_id, r.tile_path) for r in files.annotation_files(spark, str(docs)).where("slide_id <> 'b'").collect()}
    assert got == {("s1", "p1"), ("s2", "p2")}
    assert [(r.slide_id, r.result) for r in files.checkpoints(spark, str(docs)).collect()] == [("s1", "OK:1")]
    assert files.classification_files(spark, str(docs)).first().classified_cells[0].pred_class == "A"
    assert [tuple(r) for r in files.human_label_files(spark, str(docs)).select("slide_id", "cell_id", "human_label").collect()] == [("s", 1, 2)]

    df = spark.createDataFrame([("s1", "n1", None), ("s2", "n2", 2)], "slide_id string, name string, n int")
    files.write_documents(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    assert files.write_archive(df.withColumn("text", F.lit("{}")), "name", "text", str(tmp_path / "a.zip")) == 2
    assert sorted(zipfile.ZipFile(tmp_path / "a.zip").namelist()) == ["n1", "n2"]
    assert files.pretty({"a": "ü"}) == '{\n  "a": "ü"\n}'


def test_addresses(spark):
    from tessella.functions import names

    row = spark.range(1).select(names.tile_uri(F.lit("/x/INPUT_prepped_tiles_path/s/t.png"), F.lit("store://b//")).alias("u"), names.safe_file_name(F.lit("a b/ü.png")).alias("f")).first()
    assert row.u == "store://b/s/t.png" and row.f == "a_b_ü.png"


def test_manifest_by_stage_and_backlog(spark, tmp_path):
    """Two stages, a backlog of days out of order, repeats: every slide reaches its stage once, also when a batch is run again."""
    import datetime

    from tessella.streaming.manifest import follow, to_table

    day = lambda n: datetime.datetime(2024, 1, n)
    send = lambda *rows: spark.createDataFrame(list(rows), "slide_id string, stage string, announced_at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "m"))
    go = lambda stage, check: follow(spark, str(tmp_path / "m"), str(tmp_path / check), stage, to_table(str(tmp_path / stage), lambda b: b), str(tmp_path / "status"), 1)
    send(("A", "segment", day(1)), ("A", "cluster", day(1)), (None, "segment", day(1)))
    send(("B", "segment", day(6)))
    go("segment", "c1")
    send(("C", "segment", day(3)), ("A", "segment", day(9)))
    go("segment", "c1")
    go("cluster", "c2")
    read = lambda stage: sorted(r.slide_id for r in spark.read.parquet(str(tmp_path / stage)).collect())
    assert read("segment") == ["A", "B", "C"] and read("cluster") == ["A"]
    go("segment", "c3")  # another checkpoint: the status table alone keeps slides from running again
    assert read("segment") == ["A", "B", "C"]


def test_unreadable_and_grey_tiles(spark):
    from tessella.kernels.raster import write_png

    grey = np.tile(np.array([[0, 255] * 4, [255, 0] * 4], np.uint8), (4, 1)).repeat(3, axis=0).repeat(3, axis=1)
    rows = [("grey.png", bytearray(write_png(grey))), ("photo.jpg", bytearray(b"\xff\xd8 no png")), ("broken.png", bytearray(write_png(grey)[:40])), ("none.png", None)]
    got = {r.path: r for r in quality.filtered(quality.image_stats(spark.createDataFrame(rows, "path string, content binary"))).collect()}
    assert got["grey.png"].useful and got["grey.png"].color_variance is None
    for name in ("photo.jpg", "broken.png", "none.png"):
        assert got[name].rejection_reasons == ["unreadable"] and not got[name].useful


def test_images_of_all_formats(spark, tmp_path):
    """PNG and JPEG decode through the engine's image source; a broken file has no pixels; thumbnails and masks are no tiles."""
    from tessella.kernels.raster import write_png
    from tessella.sources.files import decoded_images

    folder = tmp_path / "slide"
    folder.mkdir()
    px = np.zeros((16, 16, 3), np.uint8)
    px[:, :8] = (200, 40, 10)
    for name in ("a.png", "x__THUMBNAIL.png", "a_mask.png"):
        (folder / name).write_bytes(write_png(px))
    (folder / "c.tif").write_bytes(b"broken")
    jvm = spark._jvm
    image = jvm.javax.imageio.ImageIO.read(jvm.java.io.File(str(folder / "a.png")))
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(folder / "b.jpg")))
    got = {r.tile_name: r for r in decoded_images(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b", "c"} and got["c"].data is None and got["a"].slide_id == "slide"
    assert list(got["a"].data[:3]) == [10, 40, 200] and abs(got["b"].data[2] - 200) < 12
    stats = {r.tile_name: r for r in quality.filtered(quality.decoded_stats(decoded_images(spark, str(tmp_path)), ["tile_name"])).collect()}
    assert stats["c"].rejection_reasons == ["unreadable"] and abs(stats["a"].mean_intensity - stats["b"].mean_intensity) < 3


def test_masks_of_equal_tile_names(spark):
    """The same tile name in two slides: each tile keeps its own mask, and a failing tile does not take its batch along."""
    rows = [("s1", "t", 2, [0, 255, 255, 255]), ("s2", "t", 2, [255, 255, 255, 0]), ("s2", "u", 2, [9, 9, 9, 9])]
    tiles = spark.createDataFrame(rows, "slide_id string, tile_name string, width int, gray array<int>")
    got = {(r.slide_id, r.tile_name): r.labels for r in masks.threshold_segment(tiles, ["slide_id", "tile_name"]).collect()}
    assert got == {("s1", "t"): [1, 0, 0, 0], ("s2", "t"): [0, 0, 0, 1], ("s2", "u"): [1, 1, 1, 1]}

    def model(rasters):
        if any((g == 9).all() for g in rasters):
            raise RuntimeError("too dark")
        return [g < 100 for g in rasters]

    out = {(r.slide_id, r.tile_name): (r.labels, r.error) for r in masks.batched_segmenter(model, ["slide_id", "tile_name"])(tiles).collect()}
    assert out[("s2", "u")] == (None, "too dark") and out[("s1", "t")] == ([1, 0, 0, 0], None)
    assert masks.missing_masks(tiles, tiles.where("slide_id = 's1'"), ["slide_id", "tile_name"]).count() == 2


def test_grid_edges_equal_all_pairs(spark):
    """The grid loses no pair within reach, in several blocks of a cell too."""
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, (300, 3))
    p = spark.createDataFrame([("g", f"k{i}", v.tolist()) for i, v in enumerate(x)], "g string, k string, v array<double>")
    got = {(r.a, r.b) for r in density.range_edges(p, "g", "k", "v", 0.3).collect()}
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert got == {(f"k{i}", f"k{j}") for i, j in zip(*np.nonzero(d <= 0.3))}


def test_text_labels_and_empty_evaluation(spark):
    human = spark.createDataFrame([("t", i, "tumour" if i < 3 else "other") for i in range(5)], "tile_name string, cell_id int, human_label string")
    model = spark.createDataFrame([("t", i, 7 if i < 3 else 2**60) for i in range(5)], "tile_name string, cell_id int, model_label long")
    out = evaluate.evaluation(human, model, ["tile_name", "cell_id"], ["tile_name"])
    assert out["summary"].first().accuracy == 1.0
    row = out["confusion"].first()
    assert row.labels == ["other", "tumour"] and row.matrix == [[2, 0], [0, 3]]
    with pytest.raises(evaluate.NothingToCompare):
        evaluate.evaluation(human, model.where("cell_id > 9"), ["tile_name", "cell_id"], ["tile_name"])


def test_crops_and_painting(spark):
    from tessella.kernels.draw import centre_crop, enlarged, resize
    from tessella.kernels.raster import read_png, write_png
    from tessella.operators import crops

    px = np.arange(6 * 5 * 3, dtype=np.uint8).reshape(6, 5, 3)
    assert (centre_crop(px, 4) == px[1:5, 0:4]).all() and enlarged(512, 1.5) == (768, 128)
    assert (resize(px, 5, 6) == px).all() and resize(px, 3, 2, "bicubic").shape == (2, 3, 3)
    flat = np.full((9, 9), 77, np.uint8)
    assert (resize(flat, 4, 20) == 77).all()
    tiles = spark.createDataFrame([("s", "t", bytearray(write_png(px))), ("s", "bad", bytearray(b"x"))], "slide_id string, tile_name string, content binary")
    cells = spark.createDataFrame([("s", "t", 1, [1, 2, 4, 9]), ("s", "t", 2, [2, 2, 2, 4]), ("s", "t", 3, None), ("s", "bad", 1, [0, 0, 1, 1]), ("s", "no", 1, [0, 0, 1, 1])], "slide_id string, tile_name string, label_id int, bbox array<int>")
    got = {(r.tile_name, r.label_id): r for r in crops.cell_crops(cells, tiles).collect()}
    cut = read_png(bytes(got[("t", 1)].crop))
    assert cut.shape == (7, 3, 3) and (cut[:4] == px[2:6, 1:4]).all() and (cut[4:] == 0).all()
    assert {k: r.error for k, r in got.items() if r.error} == {("t", 2): crops.TILE_FAILED, ("t", 3): crops.TILE_FAILED, ("bad", 1): crops.TILE_FAILED, ("no", 1): crops.TILE_NOT_FOUND}
    commands = spark.createDataFrame([("s", "t", 1, [1, 2, 3], [0, 0, 4, 5], None)], "slide_id string, tile_name string, cell_id int, color array<int>, box array<int>, outline array<array<int>>")
    shown = read_png(bytes(crops.painted(tiles, commands).first().content))
    assert shown[0, 0].tolist() == [3, 2, 1] and shown[2, 2].tolist() == px[2, 2].tolist()
    assert read_png(bytes(crops.thumbnails(tiles, 3).first().content)).shape == (3, 2, 3)


def test_regions_of_slides(spark, tmp_path):
    from tessella.kernels.raster import read_png, write_png
    from tessella.sources.regions import RegionSource

    px = np.random.default_rng(3).integers(0, 255, (23, 31, 3)).astype(np.uint8)
    (tmp_path / "one.png").write_bytes(write_png(px))
    (tmp_path / "small.png").write_bytes(write_png(px[:4, :4]))
    (tmp_path / "note.txt").write_text("x")
    spark.dataSource.register(RegionSource)
    read = lambda **o: spark.read.format("tess_regions").options(tile_size=10, bands=2, **o).load(str(tmp_path)).collect()
    got = {(r.x, r.y): r for r in read()}
    assert set(got) == {(x, y) for x in (0, 10, 20) for y in (0, 10)} and {r.slide_name for r in got.values()} == {"one"}
    assert (read_png(bytes(got[(10, 10)].content)) == px[10:20, 10:20]).all()
    half = read(magnification=0.5)
    assert [(r.x, r.y, r.edge) for r in half] == [(0, 0, 20)] and read_png(bytes(half[0].content)).shape == (10, 10, 3)
    assert len(read(step=2)) == 2


def test_tiles_of_a_short_table_are_spread(spark, data):
    """A table of one file is one task; the tiles made from it are as many tasks as a shuffle has."""
    part = spark.read.parquet(f"{data}/part.parquet").coalesce(1)
    sizes = demo_tiles(part).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and sum(r["count"] for r in sizes) == part.count()


def test_boxes_of_rasters_equal_those_of_pixels(spark):
    """Rasters of several shapes, two of the same tile, null pixels and an empty one."""
    rows = [("a", 3, [0, 1, 1, 0, None, 2]), ("a", 3, [1, 0, 0, 0, 0, 0]), ("b", 2, [5, 5, 0, 5]), ("c", 2, [0, 0]), ("d", 2, [])]
    m = spark.createDataFrame(rows, "tile string, width int, labels array<int>")
    pixels = m.select("tile", "width", F.posexplode("labels").alias("i", "label")).selectExpr("tile", "i div width AS y", "i % width AS x", "label")
    want = {(r.tile, r.label_id, tuple(r.bbox)) for r in masks.boxes_of_labels(pixels, ["tile"]).collect()}
    got = [(r.tile, r.label_id, tuple(r.bbox)) for r in masks.boxes_of_rasters(m, ["tile"]).collect()]
    assert set(got) == want and len(got) == len(want) == 3


def test_clusters_carry_columns(spark):
    """Columns that are asked for come along, and equal vectors, signed zeros too, weigh by their number in the mean."""
    pts = [("g", f"k{i}", i, [0.0 if i % 2 else -0.0, 1.0]) for i in range(6)] + [("g", "k6", 6, [0.7, 1.0])]
    got = density.density_clusters(spark.createDataFrame(pts, "g string, k string, n int, v array<double>"), "g", "k", "v", 3, 1.0, keep=("n",)).collect()
    assert sorted((r.k, r.n, r.cluster_id, round(r.confidence, 6)) for r in got) == [(f"k{i}", i, 0, round(1 / 1.1, 6)) for i in range(6)] + [("k6", 6, 0, 0.625)]
