"""Problem 7: filling containers of fixed capacity.

Pattern packing by non-negative least squares. Sizes are rounded up to classes; patterns of a few
classes that nearly fill a container are enumerated; the repeats of each pattern that best
reproduce the class histogram come from a non-negative least squares fit, are rounded down, and
what is left of the histogram is packed first-fit decreasing, still as counts. Everything up to
here handles one number per class, however many documents there are. The plan is a small table of
segments "ordinals a..b of class c fill slots of containers k.."; documents meet it through a
distributed ordinal within their class.

Defined results: a null text is no document; an empty text has size 0 and is packed as size 1; a
document larger than the capacity is cut into pieces of the capacity and a rest; every piece
stands in exactly one container; no container exceeds the capacity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import partitions

CAPACITY = 8192


def byte_tokens(text: Column) -> Column:
    """Tokens of a byte-level tokenizer without end token: one for each UTF-8 byte."""
    return F.octet_length(text).cast("long")


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, size, piece, piece_size)``: whole documents, or pieces of those over the capacity."""
    n = F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int")
    return (
        docs.where("text IS NOT NULL")
        .select("doc_id", byte_tokens(F.col("text")).alias("size"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("piece_size", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece").cast("long") * capacity))
    )


def patterns(classes: int, present: np.ndarray, most: int = 4, slack: int = 1) -> np.ndarray:
    """Rows of class counts: all multisets of up to ``most`` present classes within ``slack`` of full.

    ``classes`` is the capacity in class units; a class of weight w takes w of them.
    """
    usable = np.flatnonzero(present) + 1
    found: list[tuple[int, ...]] = []

    def grow(picked: tuple[int, ...], left: int) -> None:
        if picked and left <= slack:
            found.append(picked)
        if len(picked) == most or not left:
            return
        top = min(left, picked[-1] if picked else left)
        low = left - slack if len(picked) == most - 1 else 1
        for w in usable[(usable <= top) & (usable >= low)]:
            grow((*picked, int(w)), left - int(w))

    grow((), classes)
    out = np.zeros((len(found), classes), np.float64)
    for r, p in enumerate(found):
        for w in p:
            out[r, w - 1] += 1
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Minimises |a x - b| over x >= 0 by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tol = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        j = int(np.argmax(gradient)) if n else 0
        if not n or gradient[j] <= tol:
            break
        free[j] = True
        while True:
            cols = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
            if s.min() > 0:
                x[:] = 0
                x[cols] = s
                break
            low = s <= 0
            step = np.min(x[cols][low] / np.maximum(x[cols][low] - s[low], 1e-300))
            x[cols] += step * (s - x[cols])
            free[cols[x[cols] <= 1e-12]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


@dataclass(frozen=True)
class Segment:
    """Ordinals ``start..stop-1`` of ``cls`` go ``per`` to a container, from container ``base`` on."""

    cls: int
    start: int
    stop: int
    base: int
    per: int


def plan_containers(histogram: np.ndarray, most: int = 4) -> tuple[list[Segment], int]:
    """Segments that place every item of the class histogram, and the number of containers."""
    classes = len(histogram)
    left = histogram.astype(np.int64).copy()
    rows = patterns(classes, left > 0, most)
    segments: list[Segment] = []
    taken = np.zeros(classes, np.int64)
    containers = 0

    def use(pattern: dict[int, int], repeats: int) -> None:
        nonlocal containers
        for c, per in pattern.items():
            segments.append(Segment(c + 1, int(taken[c]), int(taken[c]) + per * repeats, containers, per))
            taken[c] += per * repeats
            left[c] -= per * repeats
        containers += repeats

    if len(rows):
        fit = np.floor(nnls(rows.T, left.astype(np.float64)) + 1e-6).astype(np.int64)
        for r in np.argsort(-fit, kind="stable"):
            row = rows[r].astype(np.int64)
            used = np.flatnonzero(row)
            repeats = int(min(fit[r], (left[used] // row[used]).min()))
            if repeats > 0:
                use({int(c): int(row[c]) for c in used}, repeats)
    while left.any():
        # first fit decreasing over counts: fill one container greedily, repeat it as often as counts allow
        room, pattern = classes, {}
        for c in range(classes - 1, -1, -1):
            k = int(min(left[c], room // (c + 1)))
            if k:
                pattern[c] = k
                room -= k * (c + 1)
        use(pattern, int(min(left[c] // k for c, k in pattern.items())))
    return segments, containers


def pack(docs: DataFrame, capacity: int = CAPACITY, unit: int = 64, most: int = 4) -> DataFrame:
    """``(doc_id, size, piece, piece_size, container)``: every piece with its container.

    ``unit`` is the class width in tokens (it must divide ``capacity``), ``most`` the number of
    documents in an enumerated pattern. Ordinals within a class are local row numbers of hash
    shards plus the shards' offsets, so that no class is ordered in one task.
    """
    shards = min(1024, 4 * partitions(docs.sparkSession))
    items = (
        pieces(docs, capacity)
        .withColumn("cls", F.greatest(F.lit(1), F.ceil(F.col("piece_size") / unit)).cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    )
    counts = items.groupBy("cls", "shard").agg(F.count(F.lit(1)).alias("n"))
    spark = docs.sparkSession
    # at most shards x classes rows, whatever the number of documents
    found = sorted((r.cls, r.shard, r.n) for r in counts.collect())
    histogram = np.zeros(capacity // unit, np.int64)
    offsets = []
    for cls, shard, n in found:
        offsets.append((cls, shard, int(histogram[cls - 1])))
        histogram[cls - 1] += n
    segments, _ = plan_containers(histogram, most)
    plan = spark.createDataFrame([(s.cls, s.start, s.stop, s.base, s.per) for s in segments], "cls int, start long, stop long, base long, per long")
    place = spark.createDataFrame(offsets, "cls int, shard int, before long")
    local = F.row_number().over(W.partitionBy("shard", "cls").orderBy("doc_id", "piece")) - 1
    return (
        items.withColumn("local", local)
        .join(F.broadcast(place), ["cls", "shard"])  # shards x classes rows
        .withColumn("ord", F.col("before") + F.col("local"))
        .join(F.broadcast(plan), "cls")  # a few segments a class
        .where("ord >= start AND ord < stop")
        .select("doc_id", "size", "piece", "piece_size", (F.col("base") + F.floor((F.col("ord") - F.col("start")) / F.col("per"))).alias("container"))
    )


def split_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id)`` of the documents that the packing had to cut: those with more than one piece."""
    packed = pack(docs, capacity)
    return packed.where("piece = 1").select("doc_id")


def fill_report(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, tokens, share of room used, the largest load, and the fewest containers possible."""
    loads = pack(docs, capacity).groupBy("container").agg(F.sum("piece_size").alias("load"))
    return loads.agg(
        F.count(F.lit(1)).alias("containers"),
        F.sum("load").alias("tokens"),
        F.max("load").alias("largest"),
        (F.sum("load") / (F.count(F.lit(1)) * capacity)).alias("fill"),
        F.ceil(F.sum("load") / capacity).alias("least_containers"),
    )
