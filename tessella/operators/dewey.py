"""Problem 4: deeply nested label files as flat tables with parent links.

Dewey labelling: every node gets the path of its ordinals (file, tile position, cell position,
vertex position); the parent's label is the label without its last step. Nodes are grouped by
schema path into the tables ``files``, ``tiles``, ``cells`` and ``vertices``.

``schema_nodes`` does the same for any tree: its tables are found from the schema paths that are present, so fields that
the four tables do not name are kept too.

Both forms of a file (typed columns and JSON text) become one VARIANT tree, so that there is one
reading of optional fields, numbers given as text and vertices or boxes given as objects.

Defined results: text that is not valid JSON, null tiles, null cells and null polygons have no
children; a position counts array elements, nulls included; a vertex keeps the count of its numbers
(``n_numbers``) and has ``x``/``y`` only where its first two numbers are present; redeliveries of a file
give its nodes once, from a delivery that can be read if there is one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut

STEP = "."


def parent_label(label: Column) -> Column:
    """The label of a node's parent, by truncation; null for a root."""
    step = F.length(F.substring_index(label, STEP, -1)) + 1
    return F.nullif(F.substr(label, F.lit(1), F.length(label) - step), F.lit(""))


def _get(node: str, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(node), path, kind)


def file_trees(label_files: DataFrame) -> DataFrame:
    """One row per file: ``label_file_id, batch, exported_at, tree`` (VARIANT array of tiles, or null)."""
    tiles = F.when(F.col("tiles").isNotNull(), F.to_variant_object(F.col("tiles")))
    text = F.try_parse_json(F.col("payload"))
    tree = F.coalesce(tiles, F.try_variant_get(text, "$.tiles", "variant"))
    readable = F.col("tiles").isNotNull() | text.isNotNull()
    first = W.partitionBy("label_file_id").orderBy(F.desc("__ok"), F.desc("__typed"), F.col("exported_at").desc_nulls_last(), F.desc("__size"))
    return (
        label_files.where("label_file_id IS NOT NULL")
        .select(
            "label_file_id",
            F.coalesce(F.col("batch"), F.try_variant_get(text, "$.batch", "int")).alias("batch"),
            "exported_at",
            tree.alias("tree"),
            readable.alias("__ok"),
            F.col("tiles").isNotNull().alias("__typed"),
            F.coalesce(F.size("tiles"), F.length("payload"), F.lit(0)).alias("__size"),
        )
        .withColumn("__rank", F.row_number().over(first))
        .where("__rank = 1")
        .select("label_file_id", "batch", "exported_at", "tree")
    )


def files_table(trees: DataFrame) -> DataFrame:
    return trees.select(
        F.col("label_file_id").cast("string").alias("node"),
        "label_file_id",
        "batch",
        "exported_at",
        F.coalesce(F.size(_get("tree", "$", "array<variant>")), F.lit(0)).alias("n_tiles"),
    )


def _tile_nodes(trees: DataFrame) -> DataFrame:
    return trees.select("label_file_id", F.posexplode(_get("tree", "$", "array<variant>")).alias("tile_pos", "tile"))


def tiles_table(trees: DataFrame) -> DataFrame:
    label = F.concat_ws(STEP, "label_file_id", "tile_pos")
    return _tile_nodes(trees).select(
        label.alias("node"),
        parent_label(label).alias("parent"),
        "label_file_id",
        "tile_pos",
        *[_get("tile", f"$.{c}", "string").alias(c) for c in ("slide_id", "tile_name", "tile_path")],
        _get("tile", "$.magnification", "double").alias("magnification"),
        _get("tile", "$.x", "int").alias("x"),
        _get("tile", "$.y", "int").alias("y"),
        F.coalesce(F.size(_get("tile", "$.cells", "array<variant>")), F.lit(0)).alias("n_cells"),
    )


def _cell_nodes(trees: DataFrame) -> DataFrame:
    return _tile_nodes(trees).select("label_file_id", "tile_pos", F.posexplode(_get("tile", "$.cells", "array<variant>")).alias("cell_pos", "cell"))


def _numbers(node: str, path: str, names: tuple[str, ...]) -> Column:
    """Numbers of a node that is an array of numbers or an object with the given fields."""
    listed = _get(node, path, "array<double>")
    named = F.array(*[_get(node, f"{path}.{n}", "double") for n in names])
    return F.coalesce(listed, F.when(F.exists(named, lambda v: v.isNotNull()), named))


BOX = ("xmin", "ymin", "xmax", "ymax")


def cells_table(trees: DataFrame) -> DataFrame:
    label = F.concat_ws(STEP, "label_file_id", "tile_pos", "cell_pos")
    return _cell_nodes(trees).select(
        label.alias("node"),
        parent_label(label).alias("parent"),
        "label_file_id",
        "tile_pos",
        "cell_pos",
        _get("cell", "$.cell_id", "int").alias("cell_id"),
        _get("cell", "$.label_id", "int").alias("label_id"),
        _get("cell", "$.pred_class", "string").alias("pred_class"),
        _get("cell", "$.cluster_id", "int").alias("cluster_id"),
        _get("cell", "$.cluster_confidence", "double").alias("cluster_confidence"),
        _numbers("cell", "$.bbox", BOX).alias("bbox"),
        F.coalesce(F.size(_get("cell", "$.polygon", "array<variant>")), F.lit(0)).alias("n_vertices"),
    )


def vertices_table(trees: DataFrame) -> DataFrame:
    label = F.concat_ws(STEP, "label_file_id", "tile_pos", "cell_pos", "vertex_pos")
    numbers = _numbers("vertex", "$", ("x", "y"))
    return (
        _cell_nodes(trees)
        .select("label_file_id", "tile_pos", "cell_pos", F.posexplode(_get("cell", "$.polygon", "array<variant>")).alias("vertex_pos", "vertex"))
        .select(label.alias("node"), parent_label(label).alias("parent"), "label_file_id", "tile_pos", "cell_pos", "vertex_pos", numbers.alias("v"))
        .select(
            "node",
            "parent",
            "label_file_id",
            "tile_pos",
            "cell_pos",
            "vertex_pos",
            F.coalesce(F.size(F.filter("v", lambda n: n.isNotNull())), F.lit(0)).alias("n_numbers"),
            F.try_element_at("v", F.lit(1)).alias("x"),
            F.try_element_at("v", F.lit(2)).alias("y"),
        )
    )


def flatten(label_files: DataFrame) -> dict[str, DataFrame]:
    """The related flat tables ``files``, ``tiles``, ``cells``, ``vertices``; ``parent`` leads to ``node``."""
    trees = file_trees(label_files)
    return {"files": files_table(trees), "tiles": tiles_table(trees), "cells": cells_table(trees), "vertices": vertices_table(trees)}


NODE = ("root", "node", "parent", "path", "pos", "value")


def schema_nodes(trees: DataFrame, root: str = "label_file_id", tree: str = "tree", most_depth: int = 64) -> DataFrame:
    """``(root, node, parent, path, pos, value)``: every node of every tree, whatever its fields.

    ``node`` is the Dewey label (ordinals from 0 of array elements and, in order of name, of an object's fields), ``path`` the schema path
    (``$.cells[].bbox[]``), ``value`` the text of a leaf. Nodes with one path form one table. A level of all trees is opened at
    a time; a null element is a leaf without value, an empty array or object a node without children.
    """
    label = F.concat_ws(STEP, F.col(root).cast("string"), F.lit("0"))
    level = cut(trees.where(F.col(tree).isNotNull()).select(F.col(root).alias("root"), label.alias("node"), F.col(root).cast("string").alias("parent"), F.lit("$").alias("path"), F.lit(0).alias("pos"), F.col(tree).alias("v")))
    parts = []
    for _ in range(most_depth):
        kind = F.schema_of_variant("v")
        open_node = kind.startswith("ARRAY") | kind.startswith("OBJECT")
        text = F.when(~open_node, F.try_variant_get("v", "$", "string"))
        parts.append(level.select("root", "node", "parent", "path", "pos", text.alias("value")))
        inner = level.where(open_node)
        if inner.isEmpty():
            break
        inner.createOrReplaceTempView(name := f"open_{uuid.uuid4().hex}")
        opened = inner.sparkSession.sql(f"SELECT root, node AS parent, path AS up, c.pos, c.key, c.value AS v FROM {name}, LATERAL variant_explode(v) AS c")
        path = F.when(F.col("key").isNull(), F.concat("up", F.lit("[]"))).otherwise(F.concat_ws(".", "up", "key"))
        level = cut(opened.select("root", F.concat_ws(STEP, "parent", F.col("pos").cast("string")).alias("node"), "parent", path.alias("path"), "pos", "v"))
        inner.sparkSession.catalog.dropTempView(name)
    else:
        raise RecursionError(f"trees deeper than {most_depth} levels")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def schema_tables(nodes: DataFrame) -> dict[str, DataFrame]:
    """One flat table for each schema path whose nodes are objects: ``root, node, parent, pos`` and its leaf fields as text.

    The paths (a schema's size, not the data's) come to the driver. ``parent`` leads to the nearest object above.
    """
    paths = sorted(r.path for r in nodes.select("path").distinct().collect())
    tables = {}
    for p in paths:
        fields = [q for q in paths if q.startswith(p + ".") and "." not in q[len(p) + 1 :] and "[" not in q[len(p) + 1 :]]
        if not fields:
            continue
        leaves = nodes.where(F.col("path").isin(fields)).withColumn("field", F.substring_index("path", ".", -1))
        wide = leaves.groupBy(F.col("parent").alias("node")).pivot("field", [q.rsplit(".", 1)[1] for q in fields]).agg(F.first("value"))
        own = nodes.where(F.col("path") == p).select("root", "node", F.col("parent").alias("within"), "pos")
        steps = 1 if p.endswith("[]") else 0  # an element's parent is its array, and above it the object that holds the array
        up = F.col("within")
        for _ in range(steps):
            up = parent_label(up)
        tables[p] = own.select("root", "node", up.alias("parent"), "pos").join(wide, "node", "left")
    return tables


def cells_outside_their_box(label_files: DataFrame, slack: float = 0.5) -> DataFrame:
    """Cells that have a box of four numbers and a vertex of exactly two numbers beyond it by more than ``slack``."""
    flat = flatten(label_files)
    b = F.col("bbox")
    boxed = flat["cells"].where((F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull())).select(
        F.col("node").alias("parent"), b[0].alias("xmin"), b[1].alias("ymin"), b[2].alias("xmax"), b[3].alias("ymax")
    )
    outside = (F.col("x") < F.col("xmin") - slack) | (F.col("x") > F.col("xmax") + slack) | (F.col("y") < F.col("ymin") - slack) | (F.col("y") > F.col("ymax") + slack)
    return (
        flat["vertices"].where("n_numbers = 2 AND x IS NOT NULL AND y IS NOT NULL")
        .join(boxed, "parent")
        .where(outside)
        .select("label_file_id", "tile_pos", "cell_pos")
        .distinct()
    )
