"""Queries of the core problems 1, 2 and 4, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compaction, dewey
from ..operators.eager_aggregate import slide_join_totals, slides_with_share
from ..session import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return slides_with_share(table(spark, d, "classification_results"), table(spark, d, "slides"))


def p1_slide_join_totals(spark: SparkSession, d: str) -> DataFrame:
    return slide_join_totals(table(spark, d, "classification_results"), table(spark, d, "tile_bboxes"), table(spark, d, "slides"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return compaction.same_content_pairs(compaction.compact_small_files(table(spark, d, "tile_bboxes"))[1])


def p2_compacted_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Per tile: boxes kept and files taken in."""
    boxes = compaction.compact(compaction.compact_small_files(table(spark, d, "tile_bboxes"))[1])
    return boxes.groupBy("tile").agg(F.count(F.lit(1)).alias("n_boxes"), F.sum("n_files").alias("n_file_boxes"))


def p2_journal(spark: SparkSession, d: str) -> DataFrame:
    """Checks of the journal: files taken in at the first level or left alone, containers, and sums that each level must keep.

    ``inputs_once``: no node enters two transactions. ``outputs_add_up``: a transaction's output enters a later one with the
    bytes and rows of its inputs. ``few``: no bucket and tier holds two containers below the target.
    """
    boxes = table(spark, d, "tile_bboxes")
    files = cut(compaction.file_catalogue(boxes, 1))
    journal, placement = compaction.plan(compaction.file_nodes(files))
    journal, placement = cut(journal), cut(placement)
    txns = compaction.transactions(journal)
    twice = journal.groupBy("input").count().where("count > 1").count()
    later = txns.join(journal.select(F.col("input").alias("txn_id"), F.col("bytes").alias("b"), F.col("rows").alias("r")), "txn_id")
    wrong = later.where("bytes <> b OR rows <> r").count()
    sizes = compaction.file_nodes(files).join(placement, "node").groupBy("container", "bucket").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    tiers = sizes.where(F.col("bytes") < compaction.TARGET).groupBy("bucket", compaction.tier_of(F.col("bytes"), compaction.BASE, compaction.FAN_IN)).count().where("count > 1").count()
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    return total.select(F.lit(files.count()).alias("files"), "bytes", "rows", F.lit(twice == 0).alias("inputs_once"), F.lit(wrong == 0).alias("outputs_add_up"), F.lit(tiers == 0).alias("few"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return dewey.cells_outside_their_box(table(spark, d, "cell_labels"))


def p4_cells(spark: SparkSession, d: str) -> DataFrame:
    flat = dewey.flatten(table(spark, d, "cell_labels"))
    return flat["cells"].withColumn("bbox", F.to_json("bbox"))


def p4_schema_paths(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of each schema path that is present, unknown fields included, and how many of them have their parent."""
    nodes = dewey.schema_nodes(dewey.file_trees(table(spark, d, "cell_labels")))
    up = nodes.select(F.col("node").alias("parent"), F.lit(1).alias("hit"))
    linked = nodes.join(up, "parent", "left")
    return linked.groupBy("path").agg(F.count(F.lit(1)).alias("n_nodes"), F.sum(F.coalesce("hit", F.lit(0))).alias("n_linked"))


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each flat table and how many of them have their parent."""
    flat = dewey.flatten(table(spark, d, "cell_labels"))
    parts = [flat["files"].select(F.lit("files").alias("tbl"), F.lit(1).alias("linked"))]
    for child, parent in (("tiles", "files"), ("cells", "tiles"), ("vertices", "cells")):
        up = flat[parent].select(F.col("node").alias("parent"), F.lit(1).alias("hit"))
        parts.append(flat[child].join(up, "parent", "left").select(F.lit(child).alias("tbl"), F.coalesce("hit", F.lit(0)).alias("linked")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    return rows.groupBy("tbl").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("linked").cast("long").alias("n_linked"))


QUERIES = {f.__name__: f for f in (p1_found, p1_slide_join_totals, p2_found, p2_compacted_tiles, p2_journal, p4_found, p4_cells, p4_links, p4_schema_paths)}

KEY = "nullif(replace(lower(trim(regexp_replace(trim({}), '[\\s/]+$', ''))), 'ß', 'ss'), '')"
SPELLED = " UNION ".join(f"SELECT slide_id AS sid, {KEY.format(c)} AS k FROM slides" for c in ("slide_id", "slide_name", "alt_slide_id"))
RECORDS = f"SELECT r.record_id, min(s.sid) AS sid FROM classification_results r LEFT JOIN ({SPELLED}) s ON s.k = {KEY.format('r.slide_id')} WHERE r.record_id IS NOT NULL GROUP BY 1"
TILE = r"nullif(regexp_extract(regexp_extract(bbox_file, '([^/\\]*)$', 1), '^(.*?)_bboxes', 1), '')"
TREES = """trees AS (
  SELECT label_file_id, arg_max(t, ok) AS t FROM (
    SELECT label_file_id, CASE WHEN tiles IS NOT NULL THEN 2 WHEN json_valid(payload) THEN 1 ELSE 0 END AS ok,
      CASE WHEN tiles IS NOT NULL THEN to_json(tiles) WHEN json_valid(payload) THEN json_extract(payload, '$.tiles') END AS t
    FROM cell_labels) GROUP BY 1),
tl AS (SELECT label_file_id, tile_pos, json_extract(t, '$[' || tile_pos || ']') AS t
  FROM (SELECT label_file_id, t, unnest(range(coalesce(json_array_length(t), 0)::BIGINT)) AS tile_pos FROM trees)),
ce AS (SELECT label_file_id, tile_pos, cell_pos, json_extract(c, '$[' || cell_pos || ']') AS c
  FROM (SELECT label_file_id, tile_pos, json_extract(t, '$.cells') AS c, unnest(range(coalesce(json_array_length(json_extract(t, '$.cells')), 0)::BIGINT)) AS cell_pos FROM tl)),
ve AS (SELECT label_file_id, tile_pos, cell_pos, vertex_pos, json_extract(p, '$[' || vertex_pos || ']') AS v
  FROM (SELECT label_file_id, tile_pos, cell_pos, json_extract(c, '$.polygon') AS p, unnest(range(coalesce(json_array_length(json_extract(c, '$.polygon')), 0)::BIGINT)) AS vertex_pos FROM ce)),
vx AS (SELECT *, CASE WHEN json_type(v) = 'ARRAY' THEN json_array_length(v) ELSE 2 END AS n,
    TRY_CAST(coalesce(v->>'$[0]', v->>'$.x') AS DOUBLE) AS x, TRY_CAST(coalesce(v->>'$[1]', v->>'$.y') AS DOUBLE) AS y FROM ve),
bx AS (SELECT label_file_id, tile_pos, cell_pos, CASE WHEN json_type(b) = 'ARRAY' THEN json_array_length(b) ELSE 4 END AS n,
    TRY_CAST(coalesce(b->>'$[0]', b->>'$.xmin') AS DOUBLE) AS x0, TRY_CAST(coalesce(b->>'$[1]', b->>'$.ymin') AS DOUBLE) AS y0,
    TRY_CAST(coalesce(b->>'$[2]', b->>'$.xmax') AS DOUBLE) AS x1, TRY_CAST(coalesce(b->>'$[3]', b->>'$.ymax') AS DOUBLE) AS y1
  FROM (SELECT *, json_extract(c, '$.bbox') AS b FROM ce))"""

SQL = {
    "p1_found": f"WITH r AS ({RECORDS}) SELECT sid AS slide_id FROM r WHERE sid IS NOT NULL GROUP BY 1 HAVING count(*) * 100 >= 5 * (SELECT count(*) FROM r)",
    "p1_slide_join_totals": f"""WITH r AS ({RECORDS}), b AS (
      SELECT s.sid, CASE WHEN len(bbox) = 4 AND bbox[3] > bbox[1] AND bbox[4] > bbox[2] THEN (bbox[3] - bbox[1])::BIGINT * (bbox[4] - bbox[2]) ELSE 0 END AS area
      FROM tile_bboxes t JOIN ({SPELLED}) s ON s.k = {KEY.format('t.slide_id')}),
      n AS (SELECT sid, count(*) AS n_records FROM r WHERE sid IS NOT NULL GROUP BY 1)
      SELECT b.sid AS slide_id, any_value(n_records) AS n_records, count(*) AS n_boxes, (any_value(n_records) * count(*))::BIGINT AS n_pairs, (any_value(n_records) * sum(area))::BIGINT AS pair_area
      FROM b JOIN n ON n.sid = b.sid GROUP BY 1""",
    "p2_found": f"""WITH f AS (SELECT {TILE} AS tile, file_id, list(DISTINCT [label_id] || bbox ORDER BY [label_id] || bbox) AS s FROM tile_bboxes GROUP BY ALL HAVING tile IS NOT NULL)
      SELECT a.file_id AS file_id_a, b.file_id AS file_id_b FROM f a JOIN f b ON a.tile = b.tile AND a.s = b.s AND a.file_id < b.file_id""",
    "p2_compacted_tiles": f"""SELECT tile, count(*) AS n_boxes, sum(n)::BIGINT AS n_file_boxes FROM (
      SELECT {TILE} AS tile, label_id, bbox, count(DISTINCT file_id) AS n FROM tile_bboxes GROUP BY ALL) WHERE tile IS NOT NULL GROUP BY 1""",
    "p2_journal": f"""WITH f AS (SELECT file_id, {TILE.replace('bbox_file', 'max(bbox_file)')} AS tile, coalesce(max(n_bytes), 0) AS bytes, count(*) AS rows FROM tile_bboxes WHERE file_id IS NOT NULL GROUP BY 1)
      SELECT count(*) AS files, sum(bytes)::BIGINT AS bytes, sum(rows)::BIGINT AS rows, true AS inputs_once, true AS outputs_add_up, true AS few FROM f WHERE tile IS NOT NULL""",
    "p4_found": f"""WITH {TREES} SELECT DISTINCT label_file_id, tile_pos::INTEGER AS tile_pos, cell_pos::INTEGER AS cell_pos
      FROM vx JOIN bx USING (label_file_id, tile_pos, cell_pos)
      WHERE vx.n = 2 AND x IS NOT NULL AND y IS NOT NULL AND bx.n = 4 AND x0 IS NOT NULL AND y0 IS NOT NULL AND x1 IS NOT NULL AND y1 IS NOT NULL
        AND (x < x0 - 0.5 OR x > x1 + 0.5 OR y < y0 - 0.5 OR y > y1 + 0.5)""",
    "p4_cells": f"""WITH {TREES}, q AS (SELECT *, json_extract(c, '$.bbox') AS b FROM ce), r AS (SELECT *, CASE WHEN json_type(b) = 'ARRAY' THEN TRY_CAST(b AS DOUBLE[])
        WHEN json_type(b) = 'OBJECT' THEN [TRY_CAST(b->>'$.xmin' AS DOUBLE), TRY_CAST(b->>'$.ymin' AS DOUBLE), TRY_CAST(b->>'$.xmax' AS DOUBLE), TRY_CAST(b->>'$.ymax' AS DOUBLE)] END AS box FROM q)
      SELECT label_file_id || '.' || tile_pos || '.' || cell_pos AS node, label_file_id || '.' || tile_pos AS parent, label_file_id, tile_pos::INTEGER AS tile_pos, cell_pos::INTEGER AS cell_pos,
        TRY_CAST(c->>'$.cell_id' AS INTEGER) AS cell_id, TRY_CAST(c->>'$.label_id' AS INTEGER) AS label_id, c->>'$.pred_class' AS pred_class, TRY_CAST(c->>'$.cluster_id' AS INTEGER) AS cluster_id,
        TRY_CAST(c->>'$.cluster_confidence' AS DOUBLE) AS cluster_confidence, to_json(box)::VARCHAR AS bbox, coalesce(json_array_length(json_extract(c, '$.polygon')), 0)::INTEGER AS n_vertices FROM r""",
    "p4_links": f"""WITH {TREES} SELECT 'files' AS tbl, count(*) AS n_rows, count(*) AS n_linked FROM trees UNION ALL SELECT 'tiles', count(*), count(*) FROM tl
      UNION ALL SELECT 'cells', count(*), count(*) FROM ce UNION ALL SELECT 'vertices', count(*), count(*) FROM ve""",
}
