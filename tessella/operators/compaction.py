"""Problem 2: far too many small files.

Size-tiered incremental compaction. Every file has a size tier (powers of ``fan_in``). Files of one
bucket and tier are merged in groups of ``fan_in``; the outputs enter a higher tier and are merged again, level by level,
until no tier holds a full group or the files have the target size. Containers of earlier runs that are below the target
enter again with new files, so that any number of runs leaves a number of containers that grows with its logarithm.
Each merge is a transaction whose id is a hash of its inputs; the journal lists the inputs and the output of every transaction
of every level and is written *before* any data moves: planning again over the same files gives the same journal.

All versions of a tile go to one bucket (hash of the tile's name), so that an output can drop
repeated boxes of a tile. Planning reads metadata only (one row a file or container); the boxes are rewritten
once, from the leaves to the last level reached.

Defined results: rows without a file id or whose path names no tile keep no place in a container;
a null size counts as the tier of the smallest files; equal boxes of a tile are kept once, and
a lineage names the files that held them; boxes of any arity, null boxes and null labels are kept as they
are; an empty table gives an empty journal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut, discard

JOURNAL = ("txn_id", "level", "bucket", "tier", "input", "bytes", "rows")
TARGET, BASE, FAN_IN = 128 << 20, 1 << 10, 8


def tile_of(path: Column) -> Column:
    """The tile that a box file belongs to: its base name before ``_bboxes``; null if there is none."""
    return F.nullif(F.regexp_extract(path, r"^(?:.*[/\\])?([^/\\]*?)_bboxes[^/\\]*$", 1), F.lit(""))


def file_catalogue(boxes: DataFrame, buckets: int) -> DataFrame:
    """``(file_id, tile, bytes, rows, bucket)``: one row a file, from its rows with map-side combining."""
    return (
        boxes.where("file_id IS NOT NULL")
        .groupBy("file_id")
        .agg(F.max("bbox_file").alias("path"), F.coalesce(F.max("n_bytes"), F.lit(0)).cast("long").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select("file_id", tile_of(F.col("path")).alias("tile"), "bytes", "rows")
        .where("tile IS NOT NULL")
        .withColumn("bucket", F.pmod(F.xxhash64("tile"), F.lit(buckets)).cast("int"))
    )


def tier_of(size: Column, base: int, fan_in: int) -> Column:
    """0 for files up to ``base`` bytes, then one tier for each factor of ``fan_in``."""
    return F.greatest(F.lit(0), F.ceil(F.log(float(fan_in), F.greatest(size, F.lit(1)) / F.lit(float(base))))).cast("int")


def merge_level(nodes: DataFrame, level: int, base: int, fan_in: int, target: int, least: int) -> DataFrame:
    """Assigns the nodes ``(node, bucket, bytes, rows)`` of one level to merge transactions.

    Within ``(bucket, tier)`` nodes are taken in order of identity, ``fan_in`` to a group; the nodes of a group of fewer
    than ``least``, or of the target size, stay (``txn_id`` null). Buckets bound the files in a window.
    """
    place = W.partitionBy("bucket", "tier").orderBy("node")
    group = W.partitionBy("bucket", "tier", "grp")
    open_nodes = nodes.where(F.col("bytes") < target).withColumn("tier", tier_of(F.col("bytes"), base, fan_in))
    return (
        open_nodes.withColumn("grp", F.floor((F.row_number().over(place) - 1) / fan_in))
        .withColumn("members", F.count(F.lit(1)).over(group))
        .withColumn("first", F.min("node").over(group))
        .withColumn("sig", F.sum(F.xxhash64("node") % F.lit(1 << 40)).over(group))
        .where(F.col("members") >= least)
        .withColumn("txn_id", F.concat_ws("-", F.lit(f"L{level}"), F.hex(F.xxhash64("bucket", "tier", "first", "members", "sig"))))
        .select("node", "bucket", "tier", "bytes", "rows", "txn_id")
    )


def plan(nodes: DataFrame, base: int = BASE, fan_in: int = FAN_IN, target: int = TARGET, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Plans all merges of ``(node, bucket, bytes, rows)``: ``(journal, placement)``.

    ``journal`` has a row for each input of each transaction (JOURNAL); the transaction's id names its output. ``placement``
    gives each node's ``container``: the output of the last transaction that takes it in, or the node itself. ``least`` is how
    many nodes a group needs to be merged: ``fan_in`` while more files are to come, 2 to leave as few containers as can be.
    Levels end when nothing is merged; each level divides the nodes that it merges by at least two.
    """
    placed = cut(nodes.select("node", "bucket", "bytes", "rows", F.col("node").alias("container")))
    journal, level = None, 0
    while True:
        level += 1
        now = placed.groupBy(F.col("container").alias("node"), "bucket").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        step = cut(merge_level(now, level, base, fan_in, target, least))
        inputs = step.select("txn_id", F.lit(level).alias("level"), "bucket", "tier", F.col("node").alias("input"), "bytes", "rows")
        journal = inputs if journal is None else journal.unionByName(inputs)
        if step.isEmpty():
            return journal, placed.select("node", "container")
        moves = step.select(F.col("node").alias("container"), "txn_id")
        moved = cut(placed.join(moves, "container", "left").withColumn("container", F.coalesce("txn_id", "container")).drop("txn_id"))
        discard(placed)
        placed = moved


def file_nodes(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows as nodes of the plan."""
    return catalogue.select(file_node(F.col("file_id")).alias("node"), "bucket", "bytes", "rows")


def file_node(file_id: Column) -> Column:
    return F.concat(F.lit("F"), file_id.cast("string"))


def transactions(journal: DataFrame) -> DataFrame:
    """``(txn_id, level, bucket, tier, n_inputs, bytes, rows)``: one row for each transaction."""
    return journal.groupBy("txn_id", "level", "bucket", "tier").agg(F.count(F.lit(1)).alias("n_inputs"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))


def lineage(boxes: DataFrame, placement: DataFrame) -> DataFrame:
    """``(tile, label_id, bbox, file_id, container)``: which files hold each box, and where their boxes go.

    One row for each box and file, so that a tile with any number of files needs no list of them. ``placement`` has one row a
    file: ``file_id, tile, container``.
    """
    rows = boxes.where("file_id IS NOT NULL").select("file_id", "label_id", "bbox").distinct()
    return rows.join(placement, "file_id").select("tile", "label_id", "bbox", "file_id", "container")


def compact(rows: DataFrame) -> DataFrame:
    """The rewritten boxes ``container, tile, label_id, bbox, n_files`` out of the lineage.

    Every box of a tile stands once, in the first of its files' containers; ``n_files`` files held it.
    """
    return rows.groupBy("tile", "label_id", "bbox").agg(F.min("container").alias("container"), F.count(F.lit(1)).alias("n_files"))


def buckets_for(boxes: DataFrame, rows_per_bucket: int = 4_000_000) -> int:
    """Number of tile buckets: one for each ``rows_per_bucket`` rows."""
    return max(1, -(-boxes.count() // rows_per_bucket))


def compact_small_files(boxes: DataFrame, **tiers: int) -> tuple[DataFrame, DataFrame]:
    """Catalogue, plan and rewrite in one go: ``(journal, lineage)``; ``compact`` gives the boxes."""
    files = cut(file_catalogue(boxes, buckets_for(boxes)))
    journal, placement = plan(file_nodes(files), **tiers)
    placed = files.select("file_id", "tile", file_node(F.col("file_id")).alias("node")).join(placement, "node").drop("node")
    return journal, lineage(boxes, placed)


def same_content_pairs(rows: DataFrame) -> DataFrame:
    """``(file_id_a, file_id_b)``: files of one tile with the same set of ``(label_id, bbox)``.

    Read off the compaction's lineage: a file's set is the set of boxes that came from it. Sets
    are compared by count and two independent sums of 46-bit hashes, which combine map-side and
    need no list of a file's boxes in memory; that two different sets of one tile agree in all three has a chance below 2^-90.
    """
    parts = ["label_id", F.size("bbox"), "bbox", F.col("label_id").isNull()]  # a hash leaves nulls out, so they are told apart here
    parts.append(F.transform("bbox", lambda v: v.isNull()))
    sets = cut(
        rows.select("tile", "file_id", F.xxhash64(*parts).alias("h"), F.xxhash64(F.lit(7), *parts).alias("g"))
        .groupBy("file_id")
        .agg(F.first("tile").alias("tile"), F.count(F.lit(1)).alias("n"), F.sum(F.col("h") % F.lit(1 << 46)).alias("h"), F.sum(F.shiftrightunsigned("g", 18)).alias("g"))
    )
    b = sets.select("tile", "n", "h", "g", F.col("file_id").alias("file_id_b"))
    return sets.withColumnRenamed("file_id", "file_id_a").join(b, ["tile", "n", "h", "g"]).where("file_id_a < file_id_b").select("file_id_a", "file_id_b")
