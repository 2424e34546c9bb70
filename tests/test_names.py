import math

import pytest
from pyspark.sql import functions as F

from tessella.config import PipelineConfig
from tessella.functions import names
from tessella.operators import tiling


def one(spark, col, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*cols).select(col.alias("v")).first().v


@pytest.mark.parametrize(
    ("name", "keep", "want"),
    [
        ("Slide A", False, "Slide_A_3bc65cf0"),
        ("Pancreas 20% H&E (rat)", False, "Pancreas_20_pct__HE_f4b5c471"),
        ("Pancreas 20% H&E (rat)", True, "Pancreas_20_HE_rat_f4b9ca14"),
        ("S-01_ünïcode test 0123456789 long", False, "S-01_ünïcode_test_01_456ac3c8"),
    ],
)
def test_slide_id(spark, name, keep, want):
    assert one(spark, names.slide_id(F.col("n"), keep), n=name) == want


@pytest.mark.parametrize(("mag", "want"), [(1.0, "1d00"), (0.9, "0d90"), (0.29, "0d28"), (1.15, "1d14"), (1.2, "1d19"), (1.5, "1d50")])
def test_magnification_tag(spark, mag, want):
    assert one(spark, names.magnification_tag(F.col("m")), m=mag) == want


def test_tile_names(spark):
    name = "a b__MAG_0d90__X_12__Y_7__IDX_000003.png"
    t = one(spark, names.parse_tile_name(F.col("n")), n="/x/" + name)
    assert (t.slide_id, t.magnification, t.x, t.y, t.idx) == ("a b", 0.9, 12, 7, 3)
    assert math.isclose(one(spark, names.parse_tile_name(F.col("n"), True), n=name).magnification, 0.09)
    for bad in ("s__THUMBNAIL.png", "s__MAG_x__X_1__Y_1__IDX_1.png", ""):
        assert one(spark, names.parse_tile_name(F.col("n")), n=bad) is None


@pytest.mark.parametrize(
    ("path", "want"),
    [
        ("./r/s 1/t1_bboxes.json", ("./r/s 1/t1.png", "t1", "s 1")),
        ("D:\\r\\s\\t1_bboxes.json", ("D:\\r\\s\\t1.png", "t1", "s")),
        ("/r/s/t1_bboxes.JSON", ("/r/s/t1.png", "t1", "s")),
        ("/r\\s/t1_bboxes_1.json", ("/r\\s/t1.png", "t1", "s")),
        ("s_bboxes/t1_bboxes (2).json.bak", ("s_bboxes/t1.png", "t1", "s_bboxes")),
        ("t1_bboxes_bboxes.json", ("t1.png", "t1", None)),
        ("/s/_bboxes.json", None),
        ("/s_bboxes/t1.json", None),
        (None, None),
    ],
)
def test_tile_of_box_file(spark, path, want):
    got = one(spark, names.tile_of_box_file(F.col("p").cast("string")), p=path)
    assert (tuple(got) if got else None) == want


def test_lists_and_labels(spark):
    assert one(spark, names.split_list(F.col("s")), s=" a, b ,,a") == ["a", "b"]
    assert one(spark, names.magnifications(F.col("s")), s="'0.8,1.0,1.0'") == [1.0, 0.8]
    with pytest.raises(Exception, match="positive"):
        one(spark, names.magnifications(F.col("s")), s="0.8,-1")
    assert one(spark, names.clean_label(F.col("s")), s=" **Beta**. ") == "Beta"
    assert one(spark, names.clean_label(F.col("s")), s="!!!") == "Undetermined"
    assert one(spark, names.colour(F.lit(1))) == [157, 184, 228]
    assert one(spark, names.colour(F.lit("N/A"))) == [128, 128, 128]
    assert one(spark, names.cell_text(F.lit("Alpha"), F.lit(3), F.lit(0.125))) == "c:Alpha, cl:3, p:0.12"
    assert one(spark, names.cell_text(None, None, F.lit(None).cast("double"))) == "p:?"
    assert one(spark, names.tail_after(F.col("p"), "INPUT_prepped"), p="/mnt/INPUT_prepped_tiles/s/t.png") == "s/t.png"
    assert one(spark, names.tail_after(F.col("p"), "INPUT_prepped"), p="/mnt/x/s/t.png") == "s/t.png"
    assert one(spark, names.image_name(F.lit("s"), F.lit("t"))) == "s__t.png"


def test_grid(spark):
    s = spark.createDataFrame([("s", 2000, 1500), ("small", 100, 100), ("none", None, 5)], "slide_id string, width int, height int")
    assert {(r.x, r.y) for r in tiling.grid(s, [1.0]).collect()} == {(x, y) for x in (0, 512, 1024) for y in (0, 512)}
    assert tiling.grid(s, [1.0], wanted=2).count() == 2
    edges = [one(spark, tiling.source_edge(F.lit(m))) for m in (1.0, 0.9, 0.8, 0.7, 0.29, 1.5)]
    assert edges == [512, 569, 640, 731, 1766, 512]
    assert [one(spark, tiling.stride(F.lit(a), F.lit(b).cast("int"))) for a, b in ((6, None), (6, 2), (6, 6), (100, 7))] == [1, 2, 1, 4]


def test_config():
    assert PipelineConfig().signature().startswith("model_cpsam_")
    for wrong in ({"start_from": "x"}, {"magnifications": (0.0,)}, {"cluster_min_samples": 0}, {"color_by": "x"}):
        with pytest.raises(ValueError):
            PipelineConfig(**wrong)


def test_registered_functions(spark):
    from tessella.functions.registered import register

    assert len(register(spark)) == 6
    row = spark.sql("SELECT tess_slide_id('Pancreas 20% H&E (rat)') AS s, tess_confidence(3D) AS c, tess_cosine(array(1D, 0D), array(2D, 0D)) AS k, tess_croppable(array(1, 1, 1, 5)) AS b").first()
    assert (row.s, row.c, row.k, row.b) == ("Pancreas_20_pct__HE_f4b5c471", 0.25, 1.0, False)
    line = spark.sql("SELECT tess_contour(array(0,0,0, 0,2,0, 0,0,0), 3, 2) AS p").first().p
    assert len(line) == 5 and line[0] == line[-1]


def test_run_names_and_environment():
    from tessella.config import PipelineConfig

    c = PipelineConfig()
    assert c.signature() == "model_cpsam_prob_0pt0_flow_0pt4_eps_auto_mins_5_mag_1pt0_filtered_edge_0pt02"
    assert PipelineConfig(start_from="annotate").signature() == "default"
    assert PipelineConfig(start_from="annotate", enable_annotations=True, annotation_draw_bbox=True).signature() == "annotated_maxlabels_100_bbox_colorby_cluster_id"
    assert PipelineConfig(start_from="cluster_tiles", enable_cluster_tiles=True).signature() == "reptiles_0pt75_maxper_20"
    assert c.annotations_name() == "final_annotations.json" and c.annotations_name(True).startswith("v1_model_")
    e = PipelineConfig.from_environment({"TESSELLA_MAGNIFICATIONS": "1.0, 0.5", "TESSELLA_CLUSTER_EPS": "0.3", "TESSELLA_NUM_TILES": "none", "TESSELLA_FILTER_TILES": "false", "OTHER": "x", "TESSELLA_SLIDE_FILTER": "a,b"})
    assert (e.magnifications, e.cluster_eps, e.num_tiles, e.filter_tiles, e.slide_filter) == ((1.0, 0.5), 0.3, None, False, ("a", "b"))
