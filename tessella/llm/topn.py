"""Problem 5: the N highest-scoring items of every group.

Secondary sort: rows are hash-partitioned by group, sorted inside the partitions by group, score and
identifiers, and streamed as Arrow batches that emit the first N distinct items of a group. Only the
emitted items of the group at hand are remembered, so a group of any size needs constant memory.

Before the exchange the same emitter runs over each Arrow batch of the scan (a combiner): of a hot
group at most N rows a batch travel, so no task receives a group's full weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.registry import key_hash, slide_key, spelling_hashes
from ..session import partitions


def _codes(batch: pa.RecordBatch, cols: list[str]) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in cols]


def _change(columns: list[np.ndarray]) -> np.ndarray:
    """True where a row differs from the one before it in any column."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _first_n(group: list[np.ndarray], item: list[np.ndarray], n: int) -> np.ndarray:
    """Positions of the first ``n`` distinct items of each group in sorted columns."""
    starts = np.flatnonzero(_change(group))
    ends = np.append(starts[1:], len(group[0]))
    keep = []
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s == 1:
            keep.append(s)
            continue
        seen: set[tuple] = set()
        for i in range(s, e):
            key = tuple(c[i] for c in item)
            if key not in seen:
                seen.add(key)
                keep.append(i)
                if len(seen) == n:
                    break
    return np.array(keep, dtype=np.int64)


def combine(batches: Iterator[pa.RecordBatch], group: list[str], score: str, item: list[str], n: int) -> Iterator[pa.RecordBatch]:
    """Reduces each batch to its own top ``n`` of every group."""
    for b in batches:
        if not b.num_rows:
            continue
        g, s, i = _codes(b, group), -_codes(b, [score])[0], _codes(b, item)
        order = np.lexsort([*reversed(i), s, *reversed(g)])
        yield b.take(pa.array(order[_first_n([c[order] for c in g], [c[order] for c in i], n)]))


def emit(batches: Iterator[pa.RecordBatch], group: list[str], item: list[str], n: int) -> Iterator[pa.RecordBatch]:
    """Streams sorted batches, letting through the first ``n`` distinct items of each group."""
    current: tuple | None = None
    seen: set[tuple] = set()
    for b in batches:
        if not b.num_rows:
            continue
        g, i = _codes(b, group), _codes(b, item)
        starts = np.flatnonzero(_change(g)).tolist()
        keep = []
        for s, e in zip(starts, [*starts[1:], b.num_rows]):
            key = tuple(c[s] for c in g)
            if key != current:
                current, seen = key, set()
            for r in range(s, e):
                if len(seen) == n:
                    break
                it = tuple(c[r] for c in i)
                if it not in seen:
                    seen.add(it)
                    keep.append(r)
        if keep:
            yield b.take(pa.array(keep))


def top_n(df: DataFrame, group: list[str], score: str, item: list[str], n: int) -> DataFrame:
    """The first ``n`` items of each group by ``score`` descending, then ``item`` ascending.

    ``group``, ``score`` and ``item`` columns must be numeric or string and hold no nulls or NaN; an
    item that occurs repeatedly counts once, with its highest score. ``n <= 0`` gives no rows.
    """
    if n <= 0:
        return df.limit(0)
    cols = [*group, score, *item]
    df = df.select(*cols)
    sort = [*map(F.col, group), F.desc(score), *map(F.col, item)]
    return (
        df.mapInArrow(lambda it: combine(it, group, score, item, n), df.schema)
        .repartition(partitions(df.sparkSession), *group)
        .sortWithinPartitions(*sort)
        .mapInArrow(lambda it: emit(it, group, item, n), df.schema)
    )


def grouped_cells(results: DataFrame) -> DataFrame:
    """``(key_hash, cluster_id, confidence, record_id, label_id)`` of the cells that belong to a group.

    Null and NaN confidences are 0. Cells without slide, record or label, with null or negative
    cluster, null cells and null or empty arrays give no row.
    """
    conf = F.coalesce(F.nanvl("cell.cluster_confidence", F.lit(0.0)), F.lit(0.0))
    return (
        results.select("record_id", key_hash(slide_key(F.col("slide_id"))).alias("key_hash"), F.explode("classified_cells").alias("cell"))
        .select("key_hash", F.col("cell.cluster_id").alias("cluster_id"), (conf + F.lit(0.0)).alias("confidence"), "record_id", F.col("cell.label_id").alias("label_id"))
        .where("key_hash IS NOT NULL AND cluster_id >= 0 AND record_id IS NOT NULL AND label_id IS NOT NULL")
    )


def top_cells(results: DataFrame, slides: DataFrame, n: int = 5) -> DataFrame:
    """``(slide_id, cluster_id, confidence, record_id, label_id)``: the first ``n`` cells of every slide and cluster.

    The combiner runs under the hash of the spelling, before the registry is joined: what a slide's
    spellings keep separately contains what the slide keeps.
    """
    group, item = ["key_hash", "cluster_id"], ["record_id", "label_id"]
    cells = grouped_cells(results)
    few = cells.mapInArrow(lambda it: combine(it, group, "confidence", item, n), cells.schema)
    return top_n(few.join(spelling_hashes(slides), "key_hash"), ["slide_id", "cluster_id"], "confidence", item, n)
