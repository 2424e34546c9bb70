"""Queries of the pipeline's own operators over the driver's tables, with their SQL.

Slides come from ``slides`` and ``part``, cells from ``events`` (an event is a cell, a user a tile,
``user_id % 8`` a slide), vectors from ``embeddings``; pixels are computed from integers alike in both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import cells as C
from ..operators import density, evaluate, masks, quality, sampling, status, tiling
from ..session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- views ---------------------------------------------------------------------------------------------------------


def cells(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    e = table(spark, d, "events").withColumn("k", k)
    noise = F.col("k") % 13 == 0
    return e.select(
        F.concat(F.lit("S"), (F.col("user_id") % 8).cast("string")).alias("slide_id"),
        F.col("user_id").alias("tile_id"),
        F.col("event_id").alias("cell_id"),
        F.when(noise, F.lit(-1)).otherwise(F.col("k") % 12).cast("int").alias("cluster_id"),
        F.when(noise, F.lit(0.0)).otherwise(1 / (1 + F.col("value"))).alias("confidence"),
        F.col("event_type").alias("pred_class"),
        F.array(F.col("k"), F.col("k") + 1, F.col("k") + 1 + (F.col("event_id") % 40).cast("int"), F.col("k") + 2 + (F.col("event_id") % 30).cast("int")).alias("bbox"),
        "ts",
    )


CELLS = """cells AS (SELECT 'S' || (user_id % 8) AS slide_id, user_id AS tile_id, event_id AS cell_id,
  CASE WHEN k % 13 = 0 THEN -1 ELSE k % 12 END AS cluster_id, CASE WHEN k % 13 = 0 THEN 0 ELSE 1 / (1 + value) END AS confidence,
  event_type AS pred_class, [k, k + 1, k + 1 + (event_id % 40)::INTEGER, k + 2 + (event_id % 30)::INTEGER] AS bbox, ts
  FROM (SELECT *, (props->>'$.k')::INTEGER AS k FROM events))"""


def part_slides(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.concat_ws(" ", "p_name", "p_brand", F.col("p_partkey").cast("string")), F.lit("%"))
    return table(spark, d, "part").select(
        name.alias("slide_name"), names.slide_id(name).alias("slide_id"), (F.lit(600) + F.col("p_size") * 97).alias("width"), (F.lit(600) + (F.col("p_partkey") % 37).cast("int") * 53).alias("height")
    )


PART_SLIDES = """ps AS (SELECT slide_name, 600 + p_size * 97 AS width, 600 + (p_partkey % 37)::INTEGER * 53 AS height,
  replace(trim(substr(regexp_replace(full_name, '[^\\p{L}\\p{N} _-]', '', 'g'), 1, 20)) || '_' || substr(md5(full_name), 1, 8), ' ', '_') AS slide_id
  FROM (SELECT *, replace(slide_name, '%', '_pct_') AS full_name FROM (SELECT *, p_name || ' ' || p_brand || ' ' || p_partkey || '%' AS slide_name FROM part)))"""


def reps(spark: SparkSession, d: str) -> DataFrame:
    return C.representatives(cells(spark, d), 0.05, 5)


REPS = CELLS + """, reps AS (SELECT * FROM cells WHERE confidence >= 0.05
  QUALIFY row_number() OVER (PARTITION BY slide_id, cluster_id ORDER BY confidence DESC, cell_id) <= 5)"""

SIDE = 12


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """A SIDE x SIDE raster for every part: ``key, y, x, r, g, b``."""
    at = table(spark, d, "part").select(F.col("p_partkey").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1))).alias("y")).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1))))
    v = lambda s: ((F.col("x") * 31 * s + F.col("y") * 17 + F.col("key") * (7 + s)) % 256).cast("int")
    return at.select("key", "y", "x", v(1).alias("r"), v(2).alias("g"), v(3).alias("b"))


PIXELS = f"""px AS (SELECT *, ((r * 4899 + g * 9617 + b * 1868 + 8192) // 16384)::INTEGER AS gray FROM (
  SELECT key, y, x, ((x * 31 + y * 17 + key * 8) % 256)::INTEGER AS r, ((x * 62 + y * 17 + key * 9) % 256)::INTEGER AS g, ((x * 93 + y * 17 + key * 10) % 256)::INTEGER AS b
  FROM (SELECT p_partkey AS key FROM part), (SELECT unnest(range({SIDE})) AS y), (SELECT unnest(range({SIDE})) AS x)))"""


def label_pixels(spark: SparkSession, d: str) -> DataFrame:
    """A label raster for every part: ``key, y, x, label`` with blocks of labels and background between them."""
    p = pixels(spark, d).select("key", "y", "x")
    lab = F.when((F.col("x") % 4 == 3) | (F.col("y") % 4 == 3) | ((F.col("key") + F.col("x").cast("int")) % 5 == 0), F.lit(0)).otherwise(F.expr("(y div 4) * 3 + (x div 4) + 1"))
    return p.withColumn("label", lab.cast("int"))


LABELS = f"""lp AS (SELECT key, y, x, (CASE WHEN x % 4 = 3 OR y % 4 = 3 OR (key + x) % 5 = 0 THEN 0 ELSE (y // 4) * 3 + (x // 4) + 1 END)::INTEGER AS label
  FROM (SELECT p_partkey AS key FROM part), (SELECT unnest(range({SIDE})) AS y), (SELECT unnest(range({SIDE})) AS x))"""


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label", (F.col("vec_id") % 2).cast("int").alias("half"))


VECTORS = "vec AS (SELECT vec_id, embedding::DOUBLE[] AS v, label, (vec_id % 2)::INTEGER AS half FROM embeddings)"
EPS, LEAST = 1.165, 5


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---- representatives and nesting -----------------------------------------------------------------------------------


@query(f"WITH {REPS} SELECT slide_id, cluster_id, cell_id, tile_id, round(confidence, 6) AS confidence FROM reps")
def representatives_topn(spark, d):
    return reps(spark, d).select("slide_id", "cluster_id", "cell_id", "tile_id", r6("confidence").alias("confidence"))


@query(f"""WITH {REPS} SELECT slide_id, cluster_id, count(*) AS total_cells, round(min(confidence), 6) AS min_conf, round(max(confidence), 6) AS max_conf, round(avg(confidence), 6) AS avg_conf
  FROM reps GROUP BY ALL""")
def cluster_statistics(spark, d):
    s = C.cluster_statistics(reps(spark, d))
    return s.select("slide_id", "cluster_id", "total_cells", *[r6(c).alias(c) for c in ("min_conf", "max_conf", "avg_conf")])


@query(f"WITH {REPS} SELECT slide_id, count(DISTINCT cluster_id) AS total_clusters, count(DISTINCT cell_id) AS total_cells, count(DISTINCT tile_id) AS total_tiles FROM reps GROUP BY 1")
def cluster_analysis_totals(spark, d):
    return C.analysis_totals(reps(spark, d))


@query(f"""WITH {REPS} SELECT slide_id, tile_id, string_agg(cluster_id::VARCHAR || ':' || n::VARCHAR, ',' ORDER BY cluster_id) AS cells_per_cluster
  FROM (SELECT slide_id, tile_id, cluster_id, count(*) AS n FROM reps GROUP BY ALL) GROUP BY ALL""")
def tile_summary_map(spark, d):
    s = C.tile_summary(reps(spark, d))
    text = F.transform("clusters", lambda c: F.concat_ws(":", c.cast("string"), F.element_at("cells_per_cluster", c).cast("string")))
    return s.select("slide_id", "tile_id", F.concat_ws(",", text).alias("cells_per_cluster"))


@query(f"""WITH {REPS} SELECT slide_id, tile_id, string_agg(cell_id::VARCHAR || '/' || pred_class, ';' ORDER BY cell_id) AS cells FROM cells
  WHERE (slide_id, cell_id) IN (SELECT (slide_id, cell_id) FROM reps) GROUP BY ALL""")
def filtered_annotations_nested(spark, d):
    kept = C.semi(cells(spark, d), reps(spark, d), ["slide_id", "cell_id"])
    nested = C.nest(kept, ["slide_id", "tile_id"], ["cell_id"], ["cell_id", "pred_class"])
    return nested.select("slide_id", "tile_id", F.concat_ws(";", F.transform("cells", lambda c: F.concat_ws("/", c["cell_id"].cast("string"), c["pred_class"]))).alias("cells"))


@query(f"""WITH {CELLS} SELECT slide_id, cluster_id, cell_id, row_number() OVER (PARTITION BY slide_id, cluster_id ORDER BY confidence DESC, cell_id)::INTEGER AS rank FROM cells
  QUALIFY rank <= 10""")
def classify_select_topn(spark, d):
    return C.select_for_labelling(cells(spark, d), 10).select("slide_id", "cluster_id", "cell_id", "rank")


@query(f"""WITH {CELLS}, sel AS (SELECT cell_id, upper(pred_class) AS p FROM cells QUALIFY row_number() OVER (PARTITION BY slide_id, cluster_id ORDER BY confidence DESC, cell_id) <= 10)
  SELECT slide_id, coalesce(p, 'Unclassified') AS pred_class, count(*) AS n FROM cells LEFT JOIN sel USING (cell_id) GROUP BY ALL""")
def classify_left_default(spark, d):
    all_cells = cells(spark, d)
    predicted = C.select_for_labelling(all_cells, 10).select("cell_id", F.upper("pred_class").alias("pred_class"))
    return C.class_counts(C.join_predictions(all_cells.drop("pred_class"), predicted, ["cell_id"]))


@query("""SELECT event_id, coalesce(nullif(trim(regexp_replace(trim(raw), '[^\\p{L}\\p{N}_\\s-]', '', 'g')), ''), 'Undetermined') AS label
  FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '!!!' ELSE ' **' || event_type || '**. ' END AS raw FROM events)""")
def class_label_sanitize(spark, d):
    e = table(spark, d, "events")
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("!!!")).otherwise(F.concat(F.lit(" **"), F.col("event_type"), F.lit("**. ")))
    return e.select("event_id", names.clean_label(raw).alias("label"))


@query("""SELECT CASE WHEN lower(event_type) LIKE '%rate%' OR event_id % 3 = 0 THEN 'Error - Rate Limited' ELSE 'Error - Exception' END AS label, count(*) AS n FROM events GROUP BY 1""")
def error_labels(spark, d):
    message = F.concat("event_type", F.when(F.col("event_id") % 3 == 0, F.lit(" Rate exceeded")).otherwise(F.lit(" failed")))
    return table(spark, d, "events").groupBy(names.error_label(message).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CELLS} SELECT tile_id, count(*) AS n, string_agg(cell_id::VARCHAR, ',' ORDER BY ts, cell_id) AS cells FROM cells GROUP BY 1")
def cells_nested_by_tile(spark, d):
    nested = C.nest(cells(spark, d), ["tile_id"], ["ts", "cell_id"], ["cell_id"])
    return nested.select("tile_id", F.size("cells").cast("long").alias("n"), F.concat_ws(",", F.transform("cells", lambda c: c["cell_id"].cast("string"))).alias("cells"))


@query(f"""WITH {CELLS}, f AS (SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY tile_id, cluster_id, cell_id % 50 ORDER BY cell_id) = 1)
  SELECT cell_id, row_number() OVER (PARTITION BY slide_id ORDER BY tile_id, cell_id)::INTEGER AS new_cell_id FROM f""")
def final_cell_ids(spark, d):
    c = cells(spark, d).withColumn("label_id", F.col("cell_id") % 50)
    on = ["tile_id", "cluster_id", "label_id"]
    got = C.first_match(c.select(*on).distinct(), c.withColumn("pos", F.col("cell_id")), on, "pos")
    return C.number_cells(got, ["tile_id", "cell_id"]).select("cell_id", "new_cell_id")


# ---- ids, names, paths ---------------------------------------------------------------------------------------------


@query(f"WITH {PART_SLIDES} SELECT slide_name, slide_id FROM ps")
def slide_ids(spark, d):
    return part_slides(spark, d).select("slide_name", "slide_id")


@query("SELECT slide_id, slide_name, true AS same, true AS alt_same FROM slides")
def slide_registry_ids(spark, d):
    s = table(spark, d, "slides")
    return s.select("slide_id", "slide_name", (names.slide_id(F.col("slide_name")) == F.col("slide_id")).alias("same"), (names.slide_id(F.col("slide_name"), True) == F.col("alt_slide_id")).alias("alt_same"))


@query(f"""WITH {PART_SLIDES} SELECT slide_id FROM ps WHERE slide_name IN (SELECT p_name || ' ' || p_brand || ' ' || p_partkey || '%' FROM part WHERE p_size = 7)
  OR slide_id IN (SELECT slide_id FROM ps WHERE width = 600 + 97 * 9)""")
def slide_filter_semi(spark, d):
    s = part_slides(spark, d)
    wanted = s.where(F.col("width") == 600 + 97 * 7).select(F.col("slide_name").alias("w")).unionAll(s.where(F.col("width") == 600 + 97 * 9).select(F.col("slide_id").alias("w")))
    listed = F.split(F.concat_ws(",", F.col("w"), F.lit(" "), F.col("w")), ",")
    spelled = wanted.select(F.explode(names.filter_names(F.array_distinct(F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x != "")))).alias("slide_id"))
    return s.join(spelled.distinct(), "slide_id", "left_semi").select("slide_id")


@query("""SELECT p_partkey, mag, floor(mag)::INTEGER::VARCHAR || 'd' || lpad(trunc((mag - floor(mag)) * 100)::INTEGER::VARCHAR, 2, '0') AS tag
  FROM (SELECT p_partkey, p_size::DOUBLE * 0.05::DOUBLE + 0.5::DOUBLE AS mag FROM part)""")
def magnification_tags(spark, d):
    mag = F.col("p_size") * F.lit(0.05) + F.lit(0.5)
    return table(spark, d, "part").select("p_partkey", mag.alias("mag"), names.magnification_tag(mag).alias("tag"))


@query("""SELECT p_partkey, 'P' || p_partkey AS slide_id, (p_size % 4 * 0.25 + 0.5)::DOUBLE AS magnification, (p_size * 512)::INTEGER AS x, ((p_partkey % 9) * 512)::INTEGER AS y, p_partkey::INTEGER AS idx FROM part""")
def tile_name_roundtrip(spark, d):
    p = table(spark, d, "part")
    name = names.tile_name(F.concat(F.lit("P"), F.col("p_partkey").cast("string")), F.col("p_size") % 4 * F.lit(0.25) + F.lit(0.5), F.col("p_size") * 512, (F.col("p_partkey") % 9) * 512, F.col("p_partkey"))
    return p.select("p_partkey", names.parse_tile_name(F.concat(F.lit("/a/b/"), name)).alias("t")).select("p_partkey", "t.*")


@query(r"""SELECT record_id, regexp_extract(b, '^(.*?)__MAG_', 1) AS tile_slide, regexp_extract(b, '__MAG_(\d+)d', 1)::INTEGER + regexp_extract(b, '__MAG_\d+d(\d+)', 1)::DOUBLE / 100 AS magnification,
  regexp_extract(b, '__X_(\d+)', 1)::INTEGER AS x, regexp_extract(b, '__Y_(\d+)', 1)::INTEGER AS y, regexp_extract(b, '__IDX_(\d+)', 1)::INTEGER AS idx
  FROM (SELECT DISTINCT record_id, regexp_extract(tile_path, '([^/\\]*)$', 1) AS b FROM classification_results WHERE tile_path IS NOT NULL) WHERE regexp_full_match(b, '.*__MAG_\d+d\d+__X_\d+__Y_\d+__IDX_\d+(?i:\.png)?')""")
def tile_paths_parsed(spark, d):
    t = table(spark, d, "classification_results").where("tile_path IS NOT NULL").select("record_id", names.parse_tile_name(F.col("tile_path")).alias("t"), F.regexp_extract("tile_path", r"([^/\\]*)$", 1).alias("b"))
    return t.where("t IS NOT NULL").distinct().select("record_id", F.col("t.slide_id").alias("tile_slide"), "t.magnification", "t.x", "t.y", "t.idx")


@query(r"""SELECT file_id, regexp_replace(bbox_file, '_bboxes\.json$', '.png') AS tile_path, split_part(bbox_file, '/', -2) AS slide_dir FROM (SELECT DISTINCT file_id, bbox_file FROM tile_bboxes WHERE bbox_file LIKE '%/%/%\_bboxes.json' ESCAPE '\')""")
def box_file_tiles(spark, d):
    f = table(spark, d, "tile_bboxes").where("bbox_file LIKE '%/%/%\\\\_bboxes.json'").select("file_id", "bbox_file").distinct()
    return f.select("file_id", names.tile_of_box_file(F.col("bbox_file")).alias("t")).select("file_id", "t.tile_path", F.col("t.slide_id").alias("slide_dir"))


@query(r"""SELECT file_id, regexp_replace(bbox_file, '_bboxes[^/\\]*$', '.png') AS tile_path, string_split_regex(bbox_file, '[/\\]')[-2] AS slide_dir FROM (SELECT DISTINCT file_id, bbox_file FROM tile_bboxes)
  WHERE regexp_extract(regexp_extract(bbox_file, '([^/\\]*)$', 1), '^(.*?)_bboxes', 1) <> ''""")
def box_file_tiles_all(spark, d):
    """All box files that name a tile, whatever their slashes and endings; ``box_file_tiles`` has the canonical paths only, as its SQL."""
    f = table(spark, d, "tile_bboxes").select("file_id", "bbox_file").distinct().select("file_id", names.tile_of_box_file(F.col("bbox_file")).alias("t"))
    return f.where("t IS NOT NULL").select("file_id", "t.tile_path", F.col("t.slide_id").alias("slide_dir"))


# ---- tiling grid ---------------------------------------------------------------------------------------------------

GRID = """m AS (SELECT unnest([1.0, 0.9, 0.8])::DOUBLE AS magnification), g AS (SELECT slide_id, magnification, width, height,
  CASE WHEN magnification <= 1 THEN round_even(512 / magnification, 0)::INTEGER ELSE 512 END AS edge FROM ps, m),
  n AS (SELECT *, ((width - edge) // edge + 1)::INTEGER AS nx, ((height - edge) // edge + 1)::INTEGER AS ny FROM g WHERE width >= edge AND height >= edge)"""


@query(f"""WITH {PART_SLIDES}, {GRID}, t AS (SELECT slide_id, magnification, edge, (gx * edge)::INTEGER AS x, (gy * edge)::INTEGER AS y
    FROM (SELECT *, unnest(range(nx)) AS gx FROM (SELECT *, unnest(range(ny)) AS gy FROM n)))
  SELECT slide_id, magnification, edge, x, y, (row_number() OVER (PARTITION BY slide_id ORDER BY magnification DESC, y, x) - 1)::INTEGER AS idx FROM t""")
def tile_grid(spark, d):
    return tiling.grid(part_slides(spark, d), [1.0, 0.9, 0.8])


@query(f"""WITH {PART_SLIDES}, {GRID}, s AS (SELECT *, CASE WHEN 6 >= nx::BIGINT * ny THEN 1 ELSE ceil(sqrt(nx::BIGINT * ny / 6.0))::INTEGER END AS step FROM n)
  SELECT slide_id, magnification, edge, (gx * edge)::INTEGER AS x, (gy * edge)::INTEGER AS y FROM (SELECT *, unnest(range(0, nx, step)) AS gx FROM (SELECT *, unnest(range(0, ny, step)) AS gy FROM s))""")
def tile_grid_thinned(spark, d):
    return tiling.grid(part_slides(spark, d), [1.0, 0.9, 0.8], wanted=6).drop("idx")


@query("""WITH g AS (SELECT slide_id, unnest([1.0, 0.5])::DOUBLE AS magnification, width, height FROM slides WHERE width IS NOT NULL AND height IS NOT NULL),
  e AS (SELECT *, round_even(512 / magnification, 0)::INTEGER AS edge FROM g), n AS (SELECT *, ((width - edge) // edge + 1)::BIGINT * ((height - edge) // edge + 1) AS tiles FROM e WHERE width >= edge AND height >= edge)
  SELECT slide_id, magnification, tiles FROM n""")
def registry_tile_counts(spark, d):
    """Tiles of every registered slide; the grid itself is built and counted."""
    return tiling.grid(table(spark, d, "slides"), [1.0, 0.5]).groupBy("slide_id", "magnification").agg(F.count(F.lit(1)).alias("tiles"))


# ---- tile quality and masks ----------------------------------------------------------------------------------------

STAT_SQL = """st AS (SELECT key, avg(gray) AS mean_intensity, stddev_pop(gray) AS std_intensity, avg((gray > 240)::INTEGER) AS bright_pixels_ratio, avg((gray < 15)::INTEGER) AS dark_pixels_ratio,
  (pow(avg(r) - (avg(r) + avg(g) + avg(b)) / 3, 2) + pow(avg(g) - (avg(r) + avg(g) + avg(b)) / 3, 2) + pow(avg(b) - (avg(r) + avg(g) + avg(b)) / 3, 2)) / 3 AS color_variance FROM px GROUP BY 1)"""


@query(f"""WITH {PIXELS}, {STAT_SQL} SELECT key, round(mean_intensity, 6) AS mean_intensity, round(std_intensity, 6) AS std_intensity, round(bright_pixels_ratio, 6) AS bright_pixels_ratio,
  round(dark_pixels_ratio, 6) AS dark_pixels_ratio, round(color_variance, 6) AS color_variance FROM st""")
def tile_intensity_stats(spark, d):
    s = quality.intensity_stats(pixels(spark, d), ["key"])
    return s.select("key", *[r6(c).alias(c) for c in s.columns[1:]])


@query(f"""WITH {PIXELS}, {STAT_SQL} SELECT key, (CASE WHEN bright_pixels_ratio > 0.05 THEN printf('too_bright (%.2f > 0.05)', bright_pixels_ratio) ELSE '' END) || '|' ||
  (CASE WHEN std_intensity < 50.0 THEN printf('low_contrast (%.2f < 50.0)', std_intensity) ELSE '' END) || '|' || (CASE WHEN color_variance < 5.0 THEN printf('low_color_var (%.2f < 5.0)', color_variance) ELSE '' END) AS reasons FROM st""")
def tile_quality_reasons(spark, d):
    limits = quality.LIMITS | {"max_bright_ratio": 0.05, "min_std_intensity": 50.0}
    s = quality.intensity_stats(pixels(spark, d), ["key"]).withColumns({"edge_density": F.lit(None).cast("double"), "laplacian_var": F.lit(None).cast("double")})
    f = quality.filtered(s, limits)
    pick = lambda tag: F.coalesce(F.try_element_at(F.filter("rejection_reasons", lambda r: r.startswith(tag)), F.lit(1)), F.lit(""))
    return f.select("key", F.concat_ws("|", pick("too_bright"), pick("low_contrast"), pick("low_color_var")).alias("reasons"))


def rasters(spark: SparkSession, d: str) -> DataFrame:
    """One tile a part as the image source gives it (``height, width, channels, data``, BGR): by key % 4 a flat grey one of one channel, a flat
    coloured one, stripes, and the pattern of ``pixels``; every 50th has no data."""
    n = SIDE * SIDE
    key, kind = F.col("p_partkey"), F.col("p_partkey") % 4

    def value(i: Column, s: int) -> Column:
        x, y = i % SIDE, F.floor(i / SIDE)
        stripe = F.when(F.floor(x / 3) % 2 == 0, 20 * s).otherwise(250 - 10 * s)
        return F.when(kind == 0, key % 256).when(kind == 1, (key * s) % 256).when(kind == 2, stripe).otherwise((x * 31 * s + y * 17 + key * (7 + s)) % 256).cast("int")

    at = F.sequence(F.lit(0), F.lit(n - 1))
    grey = F.transform(at, lambda i: value(i, 1))
    colour = F.flatten(F.transform(at, lambda i: F.array(value(i, 3), value(i, 2), value(i, 1))))
    digits = F.transform(F.when(kind == 0, grey).otherwise(colour), lambda v: F.lpad(F.hex(v.cast("long")), 2, "0"))
    return table(spark, d, "part").select(
        key.alias("key"),
        F.lit(SIDE).alias("height"),
        F.lit(SIDE).alias("width"),
        F.when(kind == 0, 1).otherwise(3).alias("channels"),
        F.when(key % 50 != 0, F.unhex(F.concat_ws("", digits))).alias("data"),
    )


RASTERS = f"""rx AS (SELECT key, kind, y, x, r, g, b, CASE WHEN kind = 0 THEN r ELSE (r * 4899 + g * 9617 + b * 1868 + 8192) // 16384 END::INTEGER AS gray FROM (
    SELECT key, kind, y, x, {", ".join(f"(CASE kind WHEN 0 THEN key % 256 WHEN 1 THEN key * {s} % 256 WHEN 2 THEN (CASE WHEN x // 3 % 2 = 0 THEN {20 * s} ELSE {250 - 10 * s} END) ELSE (x * {31 * s} + y * 17 + key * {7 + s}) % 256 END)::INTEGER AS {c}" for s, c in ((1, "r"), (2, "g"), (3, "b")))}
    FROM (SELECT p_partkey AS key, p_partkey % 4 AS kind FROM part WHERE p_partkey % 50 <> 0), (SELECT unnest(range({SIDE})) AS y), (SELECT unnest(range({SIDE})) AS x))),
  rl AS (SELECT *, coalesce(lag(gray) OVER r, lead(gray) OVER r) + coalesce(lead(gray) OVER r, lag(gray) OVER r) + coalesce(lag(gray) OVER c, lead(gray) OVER c) + coalesce(lead(gray) OVER c, lag(gray) OVER c) - 4 * gray AS lap FROM rx
    WINDOW r AS (PARTITION BY key, y ORDER BY x), c AS (PARTITION BY key, x ORDER BY y)),
  rs AS (SELECT key, kind, avg(gray) AS mean_intensity, stddev_pop(gray) AS std_intensity, avg((gray > 240)::INTEGER) AS bright, avg((gray < 15)::INTEGER) AS dark, var_pop(lap) AS laplacian_var,
    CASE WHEN min(kind) > 0 THEN (pow(avg(r) - (avg(r) + avg(g) + avg(b)) / 3, 2) + pow(avg(g) - (avg(r) + avg(g) + avg(b)) / 3, 2) + pow(avg(b) - (avg(r) + avg(g) + avg(b)) / 3, 2)) / 3 END AS color_variance FROM rl GROUP BY key, kind),
  rr AS (SELECT p_partkey AS key, CASE WHEN rs.key IS NULL THEN 'unreadable' ELSE concat_ws('|', CASE WHEN kind < 2 THEN 'low_edge_density (0.0000 < 0.02)' END,
    CASE WHEN bright > 0.8 THEN printf('too_bright (%.2f > 0.8)', bright) END, CASE WHEN dark > 0.8 THEN printf('too_dark (%.2f > 0.8)', dark) END,
    CASE WHEN std_intensity < 10 THEN printf('low_contrast (%.2f < 10.0)', std_intensity) END, CASE WHEN laplacian_var < 50 THEN printf('blurry (%.2f < 50.0)', laplacian_var) END,
    CASE WHEN color_variance < 5 THEN printf('low_color_var (%.2f < 5.0)', color_variance) END) END AS reasons FROM part LEFT JOIN rs ON rs.key = p_partkey)"""


@query(f"WITH {RASTERS} SELECT key, round(mean_intensity, 6) AS mean_intensity, round(std_intensity, 6) AS std_intensity, round(laplacian_var, 6) AS laplacian_var, round(color_variance, 6) AS color_variance FROM rs")
def tile_raster_stats(spark, d):
    """Decoded tiles, grey and coloured, through the kernel: the Laplacian with reflected borders, no colour variance for grey."""
    s = quality.decoded_stats(rasters(spark, d), ["key"]).where("mean_intensity IS NOT NULL")
    return s.select("key", *[r6(c).alias(c) for c in ("mean_intensity", "std_intensity", "laplacian_var", "color_variance")])


@query(f"WITH {RASTERS} SELECT key, reasons FROM rr")
def tile_reasons_all(spark, d):
    """All six reasons and the one of tiles that cannot be read, at the published limits."""
    f = quality.filtered(quality.decoded_stats(rasters(spark, d), ["key"]))
    return f.select("key", F.concat_ws("|", "rejection_reasons").alias("reasons"))


@query(f"WITH {RASTERS} SELECT key % 8 AS slide, count(*) AS processed, count(*) FILTER (WHERE reasons = '') AS kept FROM rr GROUP BY 1")
def tile_filter_counts(spark, d):
    f = quality.filtered(quality.decoded_stats(rasters(spark, d), ["key"]))
    return f.groupBy((F.col("key") % 8).alias("slide")).agg(F.count(F.lit(1)).alias("processed"), F.count_if("useful").alias("kept"))


@query(f"""WITH {PIXELS}, l AS (SELECT key, coalesce(lag(gray) OVER r, lead(gray) OVER r) + coalesce(lead(gray) OVER r, lag(gray) OVER r) + coalesce(lag(gray) OVER c, lead(gray) OVER c) + coalesce(lead(gray) OVER c, lag(gray) OVER c) - 4 * gray AS lap FROM px
  WINDOW r AS (PARTITION BY key, y ORDER BY x), c AS (PARTITION BY key, x ORDER BY y)) SELECT key, round(var_pop(lap), 6) AS laplacian_var FROM l GROUP BY 1""")
def tile_laplacian_variance(spark, d):
    return quality.decoded_stats(pattern_tiles(spark, d), ["key"]).select("key", r6("laplacian_var").alias("laplacian_var"))


def pattern_tiles(spark: SparkSession, d: str) -> DataFrame:
    """The rasters of ``pixels`` as decoded tiles."""
    key = F.col("p_partkey")
    at = F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))
    v = lambda i, s: ((i % SIDE) * 31 * s + F.floor(i / SIDE) * 17 + key * (7 + s)) % 256
    digits = F.flatten(F.transform(at, lambda i: F.transform(F.array(v(i, 3), v(i, 2), v(i, 1)), lambda c: F.lpad(F.hex(c.cast("long")), 2, "0"))))
    return table(spark, d, "part").select(key.alias("key"), F.lit(SIDE).alias("height"), F.lit(SIDE).alias("width"), F.lit(3).alias("channels"), F.unhex(F.concat_ws("", digits)).alias("data"))


@query(f"WITH {PIXELS}, {STAT_SQL} SELECT key, round(mean_intensity, 6) AS mean_intensity, round(std_intensity, 6) AS std_intensity, round(bright_pixels_ratio, 6) AS bright_pixels_ratio, round(dark_pixels_ratio, 6) AS dark_pixels_ratio FROM st")
def tile_kernel_stats(spark, d):
    """The kernel's statistics of coloured tiles; Canny's edge density has no SQL and is tested against hand-made rasters."""
    s = quality.decoded_stats(pattern_tiles(spark, d), ["key"])
    return s.select("key", *[r6(c).alias(c) for c in ("mean_intensity", "std_intensity", "bright_pixels_ratio", "dark_pixels_ratio")])


@query(f"WITH {LABELS} SELECT key, label AS label_id, min(x)::INTEGER AS xmin, min(y)::INTEGER AS ymin, max(x)::INTEGER AS xmax, max(y)::INTEGER AS ymax FROM lp WHERE label <> 0 GROUP BY ALL")
def bbox_from_mask(spark, d):
    b = masks.boxes_of_labels(label_pixels(spark, d), ["key"])
    return b.select("key", "label_id", *[F.col("bbox")[i].alias(c) for i, c in enumerate(("xmin", "ymin", "xmax", "ymax"))])


@query()
def mask_polygons(spark, d):
    """The longest contour of every label of every mask."""
    m = label_pixels(spark, d).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("y", "x", "label"))).alias("p"))
    poly = masks.polygons(m.select("key", F.lit(SIDE).alias("width"), F.transform("p", lambda v: v["label"]).alias("labels")), ["key"])
    return poly.select("key", "label_id", F.size("polygon").alias("n_points"), masks.polygon_centre(F.col("polygon")).alias("c")).select("key", "label_id", "n_points", r6(F.col("c")[0]).alias("cx"), r6(F.col("c")[1]).alias("cy"))


@query("SELECT file_id, label_id, bbox[1] AS xmin, bbox[2] AS ymin, bbox[3] AS xmax, bbox[4] AS ymax, bbox[1] < bbox[3] AND bbox[2] < bbox[4] AS croppable FROM tile_bboxes WHERE len(bbox) = 4 AND label_id IS NOT NULL")
def bbox_valid(spark, d):
    t = table(spark, d, "tile_bboxes").where(masks.valid_box(F.col("label_id"), F.col("bbox")))
    return t.select("file_id", "label_id", *[F.col("bbox")[i].alias(c) for i, c in enumerate(("xmin", "ymin", "xmax", "ymax"))], masks.croppable(F.col("bbox")).alias("croppable"))


@query(r"""SELECT file_id, count(*) AS boxes FROM tile_bboxes b WHERE regexp_extract(regexp_extract(bbox_file, '([^/\\]*)$', 1), '^(.*?)_bboxes', 1) IN (SELECT tile_name FROM classification_results) GROUP BY 1""")
def bbox_tile_semi(spark, d):
    from ..operators.compaction import tile_of

    boxes = table(spark, d, "tile_bboxes").withColumn("tile_name", tile_of(F.col("bbox_file")))
    return C.semi(boxes, table(spark, d, "classification_results"), ["tile_name"]).groupBy("file_id").agg(F.count(F.lit(1)).alias("boxes"))


@query(f"""WITH {CELLS}, p AS (SELECT slide_id, cell_id, [[bbox[1], bbox[2]], [bbox[3], bbox[2]], [bbox[3], bbox[4]]] AS q FROM cells)
  SELECT cell_id, round((q[1][1] + q[2][1] + q[3][1]) / 3.0, 6) AS cx, round((q[1][2] + q[2][2] + q[3][2]) / 3.0, 6) AS cy FROM p""")
def polygon_centroid(spark, d):
    b = F.col("bbox")
    line = F.array(F.array(b[1], b[0]), F.array(b[1], b[2]), F.array(b[3], b[2]))
    centre = masks.polygon_centre(masks.polygon_points(line).cast("array<array<double>>"))
    return cells(spark, d).select("cell_id", centre.alias("c")).select("cell_id", r6(F.col("c")[0]).alias("cx"), r6(F.col("c")[1]).alias("cy"))


# ---- status and resuming -------------------------------------------------------------------------------------------


@query("""SELECT user_id, CASE WHEN user_id % 5 = 0 THEN 'SKIP' WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'error') THEN 'OK' ELSE 'MISSING' END AS status FROM (SELECT DISTINCT user_id FROM events)""")
def missing_left_flag(spark, d):
    e = table(spark, d, "events")
    return C.status_split(e, e.where("event_type = 'error'"), "user_id", done=e.where("user_id % 5 = 0"))


@query("SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 400)")
def checkpoint_antijoin(spark, d):
    e = table(spark, d, "events")
    return status.pending(e, e.where("value > 400"), "user_id").select("event_id")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE d) AS done, count(*) FILTER (WHERE NOT d) AS pending FROM (SELECT user_id, bool_or(value > 400) AS d FROM events GROUP BY 1)")
def done_tally(spark, d):
    e = table(spark, d, "events")
    return status.tally(e, e.where("value > 400"), "user_id")


@query("""SELECT CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value < 5 THEN 'WARN' ELSE 'OK' END AS status, count(*) AS n FROM events GROUP BY 1""")
def status_summary(spark, d):
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("ERROR:"), F.col("user_id"))).when(F.col("value") < 5, F.lit("WARN:few cells")).otherwise(F.lit("OK:done"))
    return table(spark, d, "events").groupBy(status.parse_status(text)["status"].alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT doc_id, coalesce(lang, 'none') || '.json' AS name FROM documents)
  SELECT doc_id, CASE WHEN n = 0 THEN name ELSE replace(name, '.json', '_' || n || '.json') END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id) - 1 AS n FROM f)""")
def run_union_conflict_suffix(spark, d):
    f = table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("lang", F.lit("none")), F.lit(".json")).alias("name"))
    runs = status.union_runs({"a": f.where("doc_id % 2 = 0"), "b": f.where("doc_id % 2 = 1")})
    return status.unique_names(runs, "name", "doc_id").select("doc_id", "unique_name")


@query("""SELECT c_nationkey AS k, 'both' AS side FROM customer INTERSECT SELECT s_nationkey, 'both' FROM supplier
  UNION ALL (SELECT n_nationkey, 'none' FROM nation EXCEPT SELECT c_nationkey, 'none' FROM customer) UNION ALL (SELECT c_nationkey, 'any' FROM customer UNION SELECT s_nationkey, 'any' FROM supplier)""")
def set_ops(spark, d):
    c, s, n = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")), table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    tag = lambda df, t: df.withColumn("side", F.lit(t))
    return tag(c.intersect(s), "both").unionAll(tag(n.exceptAll(c.distinct()).distinct().join(c, "k", "left_anti"), "none")).unionAll(tag(c.union(s).distinct(), "any"))


@query("SELECT r_regionkey, first_nation FROM (SELECT r_regionkey, n_name AS first_nation FROM region LEFT JOIN nation ON n_regionkey = r_regionkey QUALIFY row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) = 1)")
def uri_first_wins(spark, d):
    first = sampling.first_uri(table(spark, d, "nation"), "n_regionkey", "n_name", "n_nationkey")
    return table(spark, d, "region").join(first, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("r_regionkey", F.col("n_name").alias("first_nation"))


# ---- drawing -------------------------------------------------------------------------------------------------------

HEX = "(50 + ('0x' || substr(h, {}, 2))::INTEGER % 206)::INTEGER"


@query(f"WITH {CELLS}, h AS (SELECT DISTINCT cluster_id, sha256(cluster_id::VARCHAR) AS h FROM cells) SELECT cluster_id, {HEX.format(1)} AS b, {HEX.format(3)} AS g, {HEX.format(5)} AS r FROM h")
def color_of_cluster(spark, d):
    c = cells(spark, d).select("cluster_id").distinct().withColumn("c", names.colour(F.col("cluster_id")))
    return c.select("cluster_id", *[F.col("c")[i].alias(n) for i, n in enumerate("bgr")])


@query(f"WITH {CELLS} SELECT cell_id, 'c:' || pred_class || ', cl:' || cluster_id || ', p:' || printf('%.2f', round_even(confidence, 2)) AS label FROM cells")
def text_labels(spark, d):
    return cells(spark, d).select("cell_id", names.cell_text(F.col("pred_class"), F.col("cluster_id"), F.col("confidence")).alias("label"))


@query(f"""WITH {CELLS} SELECT slide_id, tile_id, cell_id, bbox[1] AS anchor_x, greatest(0, bbox[2] - 10) AS anchor_y FROM cells WHERE pred_class <> 'Unclassified'
  QUALIFY row_number() OVER (PARTITION BY slide_id, tile_id ORDER BY cell_id) <= 7""")
def draw_limit(spark, d):
    return C.draw_limit(C.draw_commands(cells(spark, d)), 7, [F.col("cell_id")]).select("slide_id", "tile_id", "cell_id", "anchor_x", "anchor_y")


@query(f"WITH {CELLS} SELECT slide_id, tile_id, cell_id FROM cells QUALIFY row_number() OVER (PARTITION BY slide_id, tile_id ORDER BY md5('42|' || cell_id), cell_id) <= 3")
def label_shuffle_limit(spark, d):
    return C.draw_limit(cells(spark, d), 3, [C.hash_order(42, "cell_id"), F.col("cell_id")]).select("slide_id", "tile_id", "cell_id")


# ---- quality-assurance sampling ------------------------------------------------------------------------------------

INDEX = CELLS + ", idx AS (SELECT slide_id, tile_id, count(*) AS cell_count FROM cells GROUP BY ALL)"
SAMPLED = INDEX + """, sam AS (SELECT * FROM (SELECT *, md5('42|' || slide_id || '|' || tile_id) AS shuffle,
    coalesce(sum(cell_count) OVER (PARTITION BY slide_id ORDER BY md5('42|' || slide_id || '|' || tile_id), tile_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM idx)
  WHERE before < 3000.0 / (SELECT count(DISTINCT slide_id) FROM idx))"""


@query(f"WITH {INDEX} SELECT slide_id, count(*) AS tiles, sum(cell_count)::BIGINT AS cells FROM idx GROUP BY ROLLUP (slide_id)")
def qa_tile_index(spark, d):
    return sampling.index_totals(sampling.tile_index(cells(spark, d)))


@query(f"WITH {SAMPLED} SELECT slide_id, tile_id, cell_count FROM sam")
def qa_budget_sample(spark, d):
    return sampling.budget_sample(sampling.tile_index(cells(spark, d)), 3000).select("slide_id", "tile_id", "cell_count")


BATCHED = SAMPLED.replace("WITH ", "") + """, o AS (SELECT *, row_number() OVER (ORDER BY shuffle, slide_id, tile_id) AS i FROM sam),
  f AS (SELECT i, slide_id, tile_id, cell_count, 1 AS batch, cell_count AS run FROM o WHERE i = 1
    UNION ALL SELECT o.i, o.slide_id, o.tile_id, o.cell_count, CASE WHEN f.run >= 1000 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.run >= 1000 THEN o.cell_count ELSE f.run + o.cell_count END FROM f JOIN o ON o.i = f.i + 1)"""


@query(f"WITH RECURSIVE {BATCHED} SELECT slide_id, tile_id, cell_count, batch::INTEGER AS batch FROM f WHERE batch <= 3")
def qa_batches(spark, d):
    return sampling.batches(sampling.budget_sample(sampling.tile_index(cells(spark, d)), 3000))


@query(f"WITH RECURSIVE {BATCHED} SELECT batch::INTEGER AS batch, count(*) AS tiles, sum(cell_count)::BIGINT AS cells, count(DISTINCT slide_id) AS slides FROM f WHERE batch <= 3 GROUP BY 1")
def qa_manifest(spark, d):
    return sampling.manifest(qa_batches(spark, d))


@query(f"WITH {SAMPLED} SELECT cell_id, cells.slide_id, cells.tile_id FROM cells JOIN sam USING (slide_id, tile_id)")
def qa_label_extract(spark, d):
    sample = sampling.budget_sample(sampling.tile_index(cells(spark, d)), 3000)
    return C.semi(cells(spark, d), sample, ["slide_id", "tile_id"]).select("cell_id", "slide_id", "tile_id")


# ---- evaluation ----------------------------------------------------------------------------------------------------


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Cells with a human label (0 or 1 from the class) and a model label (parity of the cluster, absent for noise)."""
    c = cells(spark, d)
    human = c.select("slide_id", "tile_id", "cell_id", F.when(F.col("pred_class").isin("click", "error"), 1).otherwise(0).cast("long").alias("human_label"))
    model = c.select("slide_id", "tile_id", "cell_id", F.when(F.col("cluster_id") >= 0, F.col("cluster_id") % 2).cast("int").alias("model_label"))
    return evaluate.matched(human, model, ["slide_id", "tile_id", "cell_id"])


MATCHED = CELLS + """, mt AS (SELECT slide_id, tile_id, cell_id, (CASE WHEN pred_class IN ('click', 'error') THEN 1 ELSE 0 END)::BIGINT AS human_label, (cluster_id % 2)::INTEGER AS model_label FROM cells WHERE cluster_id >= 0)"""


@query(f"WITH {MATCHED} SELECT cell_id, human_label, model_label FROM mt")
def eval_match(spark, d):
    return labelled(spark, d).select("cell_id", "human_label", "model_label")


@query(f"""WITH {MATCHED} SELECT slide_id, tile_id, human_label, model_label, count(*) AS n, (dense_rank() OVER (PARTITION BY slide_id, tile_id ORDER BY human_label) - 1)::INTEGER AS h_index,
  (dense_rank() OVER (PARTITION BY slide_id, tile_id ORDER BY model_label) - 1)::INTEGER AS m_index FROM mt GROUP BY slide_id, tile_id, human_label, model_label""")
def eval_contingency(spark, d):
    return evaluate.contingency(labelled(spark, d), ["slide_id", "tile_id"])


@query(f"WITH {MATCHED} SELECT slide_id, count(*) FILTER (WHERE human_label = 0 AND model_label = 0) AS h0_m0, count(*) FILTER (WHERE human_label = 0 AND model_label = 1) AS h0_m1, count(*) FILTER (WHERE human_label = 1 AND model_label = 0) AS h1_m0, count(*) FILTER (WHERE human_label = 1 AND model_label = 1) AS h1_m1 FROM mt GROUP BY 1")
def eval_confusion_pivot(spark, d):
    pair = F.concat(F.lit("h"), F.col("human_label").cast("string"), F.lit("_m"), F.col("model_label").cast("string"))
    return labelled(spark, d).withColumn("pair", pair).groupBy("slide_id").pivot("pair", ["h0_m0", "h0_m1", "h1_m0", "h1_m1"]).count().na.fill(0)


@query(f"""WITH {MATCHED}, t AS (SELECT slide_id, tile_id, count(*) AS n, count(*) FILTER (WHERE human_label = model_label) AS same FROM mt GROUP BY ALL)
  SELECT sum(n)::BIGINT AS n_cells, sum(greatest(same, n - same))::BIGINT AS matched, round_even(sum(greatest(same, n - same)) / sum(n), 4) AS accuracy FROM t""")
def eval_hungarian_accuracy(spark, d):
    return evaluate.accuracy(evaluate.compared(labelled(spark, d), ["slide_id", "tile_id"]))


@query()
def eval_confusion(spark, d):
    return evaluate.confusion(evaluate.compared(labelled(spark, d), ["slide_id", "tile_id"]), ["slide_id", "tile_id"])


# ---- density clustering of vectors ---------------------------------------------------------------------------------


@query(f"WITH {VECTORS} SELECT a.vec_id, round(list_distance(a.v, b.v), 6) AS dist FROM vec a JOIN vec b ON true QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v)) = 5")
def knn_kdistance(spark, d):
    return density.k_distances(vectors(spark, d), "vec_id", "v", LEAST).select("vec_id", r6("dist").alias("dist"))


@query(f"""WITH {VECTORS}, k AS (SELECT list_distance(a.v, b.v) AS dist FROM vec a JOIN vec b ON true QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v)) = 5)
  SELECT round(quantile_cont(dist, 0.95), 6) AS eps FROM k""")
def eps_percentile(spark, d):
    return density.percentile_radius(density.k_distances(vectors(spark, d), "vec_id", "v", LEAST)).select(r6("eps").alias("eps"))


LABELLED = f"""{VECTORS}, ed AS (SELECT a.half, a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.half = b.half AND list_distance(a.v, b.v) <= {EPS}),
  core AS (SELECT half, a FROM ed GROUP BY ALL HAVING count(*) >= {LEAST}), ce AS (SELECT ed.half, ed.a, ed.b FROM ed JOIN core c1 ON c1.a = ed.a JOIN core c2 ON c2.a = ed.b),
  reach(half, node, root) AS (SELECT half, a, a FROM core UNION SELECT ce.half, ce.b, reach.root FROM reach JOIN ce ON ce.a = reach.node AND reach.root < ce.b),
  cl AS (SELECT half, node, dense_rank() OVER (PARTITION BY half ORDER BY root) - 1 AS c FROM (SELECT half, node, min(root) AS root FROM reach GROUP BY ALL)),
  lab AS (SELECT vec.half, vec.vec_id, coalesce(own.c, bo.c, -1)::INTEGER AS cluster_id FROM vec LEFT JOIN cl own ON own.node = vec.vec_id
    LEFT JOIN (SELECT ed.a, min(cl.c) AS c FROM ed JOIN cl ON cl.node = ed.b GROUP BY 1) bo ON bo.a = vec.vec_id)"""


@query(f"WITH RECURSIVE {LABELLED} SELECT half, vec_id, cluster_id FROM lab")
def dbscan_labels(spark, d):
    return density.density_clusters(vectors(spark, d), "half", "vec_id", "v", LEAST, EPS).select("half", "vec_id", "cluster_id")


@query(f"WITH RECURSIVE {LABELLED} SELECT half, vec_id, cluster_id FROM lab")
def dbscan_labels_distributed(spark, d):
    v = vectors(spark, d)
    return density.density_labels(v, density.range_edges(v, "half", "vec_id", "v", EPS), "half", "vec_id", LEAST)


CLUSTERED = f"{VECTORS}, cv AS (SELECT vec_id, half, v, (CASE WHEN label = 9 THEN -1 ELSE label END)::INTEGER AS cluster_id FROM vec)"


def clustered(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).withColumn("cluster_id", F.when(F.col("label") == 9, -1).otherwise(F.col("label")).cast("int"))


@query(f"""WITH {CLUSTERED}, mean AS (SELECT half, cluster_id, list(m ORDER BY i) AS m FROM (SELECT half, cluster_id, i, avg(v[i]) AS m FROM (SELECT *, unnest(range(1, 65)) AS i FROM cv WHERE cluster_id >= 0) GROUP BY ALL) GROUP BY ALL)
  SELECT cv.half, vec_id, cv.cluster_id, round(coalesce(1 / (1 + list_distance(v, m)), 0), 6) AS confidence FROM cv LEFT JOIN mean ON mean.half = cv.half AND mean.cluster_id = cv.cluster_id""")
def cluster_centroid_confidence(spark, d):
    c = density.centroid_confidence(clustered(spark, d), "half", "vec_id", "v")
    return c.select("half", "vec_id", "cluster_id", r6("confidence").alias("confidence"))


@query(f"WITH {CLUSTERED} SELECT half, count(DISTINCT cluster_id) FILTER (WHERE cluster_id <> -1) AS clusters, count(*) FILTER (WHERE cluster_id = -1) AS noise FROM cv GROUP BY 1")
def cluster_counts(spark, d):
    return C.cluster_counts(clustered(spark, d), "half")


@query(f"WITH {VECTORS}, n AS (SELECT vec_id, i, v[i] * (vec_id % 3) AS x FROM (SELECT *, unnest(range(1, 65)) AS i FROM vec)) SELECT vec_id, round(sum(x * x) / nullif(sum(x * x), 0), 6) AS len2, round(max(x) / sqrt(nullif(sum(x * x), 0)), 6) AS top FROM n GROUP BY 1")
def l2_normalize(spark, d):
    scaled = F.transform("v", lambda x: x * (F.col("vec_id") % 3))
    n = vectors(spark, d).select("vec_id", density.l2_normalised(scaled).alias("u"))
    zero = F.col("vec_id") % 3 == 0
    return n.select(
        "vec_id", F.when(~zero, r6(F.aggregate("u", F.lit(0.0), lambda s, x: s + x * x))).alias("len2"), F.when(~zero, r6(F.array_max("u"))).alias("top")
    )


@query()
def kneedle_eps(spark, d):
    """The radius that the k-distances of each half suggest."""
    return density.density_clusters(vectors(spark, d), "half", "vec_id", "v", LEAST).groupBy("half").agg(F.max("eps").alias("eps"), F.max("cluster_id").alias("last_cluster"))


# ---- whole pipeline, streaming, files ------------------------------------------------------------------------------


@query("""SELECT 'S' || s AS slide_id, c::INTEGER AS cluster_id, k AS pred_class, CASE k WHEN 'Small' THEN least(n, 10) ELSE n - 10 END AS cells, 1.0::DOUBLE AS min_conf
  FROM (SELECT p_partkey % 8 AS s, count(*) AS n FROM part GROUP BY 1), (SELECT unnest(range(9)) AS c), (SELECT unnest(['Small', 'Unclassified']) AS k) WHERE k = 'Small' OR n > 10""")
def pipeline_cells(spark, d):
    """The staged pipeline from tiles to annotations over one tile for every part: cells per slide, cluster and class.

    Each tile has nine cells at fixed places, so each place is a cluster of equal vectors; ten cells of each are classified.
    """
    from ..config import PipelineConfig
    from .pipeline import demo_tiles, run_pipeline

    cfg = PipelineConfig(start_from="segment", filter_tiles=False, cluster_eps=2.0)
    out = run_pipeline({"tiles": demo_tiles(table(spark, d, "part"))}, cfg)
    got = out["annotations"].groupBy("slide_id", "cluster_id", "pred_class").agg(F.count(F.lit(1)).alias("cells"), F.min("confidence").alias("min_conf"))
    return got


@query("SELECT 'S' || (user_id % 8) AS slide_id, count(*) AS n FROM events GROUP BY 1")
def manifest_stream(spark, d):
    """Slides announced in a manifest, twice and for another stage too, are taken up by a file stream, each once; the output is read back."""
    from ..session import scratch
    from ..streaming.manifest import announce, follow, to_table

    root = scratch(spark, "manifest")
    all_cells = cells(spark, d)
    slides = all_cells.select("slide_id").distinct()
    announce(slides, "segment", f"{root}/manifest")
    announce(slides, "cluster", f"{root}/manifest")
    count = lambda batch: all_cells.join(batch, "slide_id", "left_semi").groupBy("slide_id").agg(F.count(F.lit(1)).alias("n"))
    for _ in range(2):
        announce(slides, "segment", f"{root}/manifest")
        follow(spark, f"{root}/manifest", f"{root}/checkpoint", "segment", to_table(f"{root}/out", count), f"{root}/status")
    return spark.read.parquet(f"{root}/out").select("slide_id", "n")


@query(r"""SELECT record_id, label_id, pred_class, cluster_id, count(*) AS n FROM (SELECT record_id, unnest(classified_cells) AS c FROM classification_results), LATERAL (SELECT c.label_id, c.pred_class, c.cluster_id) GROUP BY ALL""")
def classified_json_roundtrip(spark, d):
    """Classified tiles written as JSON text without null fields and read back with the explicit schema."""
    from ..schemas import CLASSIFIED_CELL, struct_of

    t = table(spark, d, "classification_results")
    text = t.select("record_id", F.to_json("classified_cells", {"ignoreNullFields": "true"}).alias("j"))
    back = text.select("record_id", F.explode(F.from_json("j", f"ARRAY<{struct_of(CLASSIFIED_CELL)}>", {"allowNonNumericNumbers": "true"})).alias("c"))
    return back.groupBy("record_id", F.col("c.label_id").alias("label_id"), F.col("c.pred_class").alias("pred_class"), F.col("c.cluster_id").alias("cluster_id")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT record_id, tile_path, CASE WHEN cut <> '' THEN cut ELSE regexp_extract(tile_path, '([^/]+/[^/]+)$', 1) END AS tail
  FROM (SELECT DISTINCT record_id, tile_path, regexp_extract(tile_path, '(?:^|/)INPUT_prepped_tiles_path[^/]*/(.+)$', 1) AS cut FROM classification_results WHERE tile_path IS NOT NULL)""")
def tile_path_tails(spark, d):
    t = table(spark, d, "classification_results").where("tile_path IS NOT NULL").select("record_id", "tile_path").distinct()
    return t.withColumn("tail", names.tail_after(F.col("tile_path"), "INPUT_prepped_tiles_path"))


@query(r"""WITH f AS (SELECT DISTINCT file_id, replace(bbox_file, '\', '/') AS p FROM tile_bboxes), c AS (SELECT file_id, 1 AS r, regexp_extract(p, '/INPUT_prepped_tiles_path/(.+)$', 1) AS c FROM f
    UNION ALL SELECT file_id, 2, regexp_extract(p, '/prepped/(.+)$', 1) FROM f UNION ALL SELECT file_id, 3, regexp_extract(p, '([^/]+/[^/]+)$', 1) FROM f)
  SELECT file_id, arg_min(c, r) AS first FROM c WHERE c <> '' GROUP BY 1""")
def image_path_candidates(spark, d):
    f = table(spark, d, "tile_bboxes").select("file_id", "bbox_file").distinct()
    return f.select("file_id", F.element_at(names.image_candidates(F.col("bbox_file"), ("INPUT_prepped_tiles_path", "prepped")), 1).alias("first"))


@query("SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def run_stamps(spark, d):
    return table(spark, d, "events").select("event_id", names.run_stamp(F.col("ts")).alias("stamp"))


@query()
def pca_reduce(spark, d):
    """Embeddings on their first 8 principal components."""
    p = density.pca_reduced(vectors(spark, d), "v", 8)
    return p.select("vec_id", F.transform("reduced", lambda x: F.round(x, 6)).alias("reduced"))
