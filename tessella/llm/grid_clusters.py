"""Problem 6: clusters of similar vectors within each slide.

Grid density clustering. Unit vectors are quantised: a fixed orthonormal map to AXES features, each cut into
steps of STEP, gives the grid cell. Cells are counted (hot ones are split by hash, so that no task
holds more than HOT rows of one), and within a cell vectors gather around the densest ones into cores,
all of whose members are linked to the core's centre. Cores are then joined: two are adjacent if any member of one is
linked to any member of the other, which is tested exactly.

Cells lie in blocks of about BLOCK vectors. Within a block all its cores are compared. Between the blocks of a larger slide only centres
and radii of cores travel: a block finds which of its rows the triangle inequality leaves within reach of a foreign core. A row linked to
the centre settles the pair; where none is, the rows in reach are sent to the core's block and compared with its members. So no link
is lost, a slide of any size is spread over many tasks, and what meets in full is cores, not rows. Minimum labels propagate
over adjacent cores to convergence.

A core's id is its smallest cell_key, so a cluster's label is its smallest cell_key. Exact copies of a
vector in one share of a cell are compared once.

Defined results: unusable embeddings, null keys and embeddings that name no slide belong to no cluster; redeliveries of
a key count once; sets of fewer than ``least`` cells are no cluster; a cell is linked to itself only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.components import minimum_labels
from ..operators.registry import key_hash, slide_key, spelling_hashes
from ..session import cut, discard, partitions
from .vectors import DIM, pack, unpack, usable

AXES, STEP, HOT, BLOCK = 6, 0.3, 2048, 16384
POINTS = "key_hash long, cell_key long, grid long, vec binary"
BLOCKS = "slide_no long, blk int, blocks int, keys binary, edges binary, core binary, vecs binary, centres binary"
MET = "slide_no long, blk int, u long, v long, ask binary"


def axes(dim: int = DIM, count: int = AXES) -> np.ndarray:
    """A fixed orthonormal map from ``dim`` to ``count`` dimensions."""
    return np.linalg.qr(np.random.default_rng(11).standard_normal((dim, count)))[0]


def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key_hash, cell_key, grid, vec)`` of the usable rows of ``(key_hash, cell_key, embedding)``."""
    turn = axes()
    for b in batches:
        rows, x = usable(b.column(2))
        steps = np.floor(x.astype(np.float64) @ turn / STEP).astype(np.int64) + 8
        grid = (steps << (4 * np.arange(AXES))).sum(axis=1)
        take = pa.array(rows)
        yield pa.record_batch([b.column(0).take(take), b.column(1).take(take), pa.array(grid), pack(x)], names=["key_hash", "cell_key", "grid", "vec"])


def points(embeddings: DataFrame, slides: DataFrame) -> DataFrame:
    """``(slide_no, cell_key, grid, vec)`` of the usable embeddings that name a slide; ``slide_no`` is a hash of the slide."""
    rows = embeddings.select(key_hash(slide_key(F.col("slide_id"))).alias("key_hash"), "cell_key", "embedding").where("key_hash IS NOT NULL AND cell_key IS NOT NULL")
    registry = spelling_hashes(slides).select("key_hash", F.xxhash64("slide_id").alias("slide_no"))
    return rows.mapInArrow(quantise, POINTS).join(registry, "key_hash").select("slide_no", "cell_key", "grid", "vec")


def gather_cores(x: np.ndarray, keys: np.ndarray, least_sim: float) -> tuple[np.ndarray, np.ndarray]:
    """``(core id, row of the core's centre)`` of each row: rows join the densest remaining row that they are linked to.

    Of the rows left, the one with most links is the centre of the next core. The id is the smallest key.
    """
    n = len(x)
    if n == 1:
        return keys, np.zeros(1, np.int64)
    linked = x @ x.T >= least_sim
    core, centre, left = np.empty(n, np.int64), np.empty(n, np.int64), np.ones(n, bool)
    degree = linked.sum(axis=1)
    while left.any():
        top = np.argmax(np.where(left, degree, -1))
        members = left & linked[top]
        members[top] = True
        core[members], centre[members] = keys[members].min(), top
        left &= ~members
        degree = degree - linked[:, members].sum(axis=1)
    return core, centre


def _spanning(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the smallest node of its component, for the edges ``(low, high)``."""
    nodes, index = np.unique(np.concatenate([low, high]), return_inverse=True)
    a, b = index[: len(low)], index[len(low) :]
    label = np.arange(len(nodes))
    while True:
        m = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == label).all():
            break
        label = new
    tied = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[tied], nodes[label[tied]]


def _runs(core: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]]))


def adjacent_cores(x: np.ndarray, cx: np.ndarray, y: np.ndarray, cy: np.ndarray, least_sim: float, chunk: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of cores with a link between their members. Rows come in runs of equal core."""
    starts = _runs(cy)
    names = cy[starts]
    lows, highs = [], []
    yt = y.T.copy()
    for at in range(0, len(x), chunk):
        part = x[at : at + chunk] @ yt
        own = cx[at : at + chunk]
        near = np.maximum.reduceat(part, starts, axis=1)
        rows = _runs(own)
        near = np.maximum.reduceat(near, rows, axis=0)
        sure = near >= least_sim + 1e-5
        a, b = np.nonzero(sure)
        lows.append(own[rows][a])
        highs.append(names[b])
        for a, b in zip(*np.nonzero((near >= least_sim - 1e-5) & ~sure)):
            # too close to the threshold for single precision
            p = x[at : at + chunk][own == own[rows[a]]].astype(np.float64)
            q = y[cy == names[b]].astype(np.float64)
            if (p @ q.T).max() >= least_sim:
                lows.append(own[rows[a] : rows[a] + 1])
                highs.append(names[b : b + 1])
    low, high = np.concatenate(lows), np.concatenate(highs)
    keep = low != high
    return _spanning(low[keep], high[keep])


def _cores_of(keys: np.ndarray, x: np.ndarray, least_sim: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(core of each row, distinct vectors, core of each distinct vector, row of its centre)`` of one unit."""
    if len(keys) == 1:
        return keys, x, keys, np.zeros(1, np.int64)
    raw = x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, back = np.unique(raw, return_index=True, return_inverse=True)
    lows = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(lows, back, keys)
    core, centre = gather_cores(x[first].astype(np.float64), lows, least_sim)
    return core[back], x[first], core, centre


def _centres(x: np.ndarray, core: np.ndarray, centre: np.ndarray) -> bytes:
    """Per core its id, the cosine of its radius and its centre, packed; rows come in runs of equal core."""
    starts = _runs(core)
    c = x[centre[starts]]
    near = np.einsum("ij,ij->i", x.astype(np.float64), np.repeat(c, np.diff(np.append(starts, len(core))), axis=0).astype(np.float64))
    out = np.empty(len(starts), CENTRE)
    out["core"], out["radius"], out["vec"] = core[starts], np.minimum.reduceat(near, starts), c
    out["single"] = np.diff(np.append(starts, len(core))) == 1
    return out.tobytes()


CENTRE = np.dtype([("core", np.int64), ("radius", np.float64), ("single", np.bool_), ("vec", np.float32, DIM)])
ASKED = np.dtype([("core", np.int64), ("other", np.int64), ("vec", np.float32, DIM)])


def make_blocks(batches: Iterator[pa.RecordBatch], least_sim: float) -> Iterator[pa.RecordBatch]:
    """One row for each block of a slide: its keys with their cores, the adjacent cores within it, and, if the
    slide has other blocks, its distinct vectors in runs of equal core and the cores' centres."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    t = pa.Table.from_batches(parts)
    slide, blk, blocks, unit, keys = (np.asarray(t.column(c)) for c in ("slide_no", "blk", "blocks", "unit", "cell_key"))
    x = unpack(t.column("vec"))
    order = np.lexsort((keys, unit, blk, slide))
    s, b, u, k = slide[order], blk[order], unit[order], keys[order]
    new_block = np.concatenate([[True], (s[1:] != s[:-1]) | (b[1:] != b[:-1])])
    new_unit = new_block | np.concatenate([[True], u[1:] != u[:-1]])
    fresh = new_unit | np.concatenate([[True], k[1:] != k[:-1]])  # redeliveries of a key are neighbours here
    order = order[fresh]
    unit_at, block_at = np.flatnonzero(new_unit[fresh]), np.flatnonzero(new_block[fresh])
    unit_end = np.append(unit_at[1:], len(order))
    for at, end in zip(block_at, [*block_at[1:], len(order)]):
        units = range(*np.searchsorted(unit_at, [at, end]))
        got = [_cores_of(keys[order[unit_at[i] : unit_end[i]]], x[order[unit_at[i] : unit_end[i]]], least_sim) for i in units]
        core = np.concatenate([g[0] for g in got])
        distinct, own = np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])
        place = np.cumsum([0, *[len(g[1]) for g in got]])
        centre = np.concatenate([g[3] + p for g, p in zip(got, place)])
        by = np.argsort(own, kind="stable")
        at_row = np.empty(len(by), np.int64)
        at_row[by] = np.arange(len(by))
        distinct, own, centre = distinct[by], own[by], at_row[centre[by]]
        low, high = adjacent_cores(distinct, own, distinct, own, least_sim) if len(own) > 1 else (own[:0], own[:0])
        shared = blocks[order[at]] > 1
        yield pa.record_batch(
            [
                pa.array([slide[order[at]]], pa.int64()),
                pa.array([blk[order[at]]], pa.int32()),
                pa.array([blocks[order[at]]], pa.int32()),
                *[pa.array([v], pa.binary()) for v in (np.concatenate([keys[order[at:end]], core]).tobytes(), np.concatenate([low, high]).tobytes(), own.tobytes() if shared else None, distinct.tobytes() if shared else None, _centres(distinct, own, centre) if shared else None)],
            ],
            names=["slide_no", "blk", "blocks", "keys", "edges", "core", "vecs", "centres"],
        )


def _block_first(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, list]]:
    """``(name, vectors, cores, rows)`` of each block out of rows sorted by ``slide_no, blk, from``: the block itself comes first (``from`` -1)."""
    name, x, core, rest = None, None, None, []
    for b in batches:
        names = list(zip(b.column("slide_no").to_pylist(), b.column("blk").to_pylist()))
        for r, own in enumerate(names):
            if own != name:
                if name is not None and rest:
                    yield name, x, core, rest
                name, x, rest = own, None, []
            if b.column("from")[r].as_py() < 0:
                x = np.frombuffer(b.column("vecs")[r].as_buffer(), np.float32).reshape(-1, DIM)
                core = np.frombuffer(b.column("core")[r].as_buffer(), np.int64)
            elif x is not None:
                rest.append((b.column("from")[r].as_py(), b.column("sent")[r].as_buffer()))
    if name is not None and rest:
        yield name, x, core, rest


def _met(slide: int, blk: int, u: np.ndarray, v: np.ndarray, ask: bytes | None = None) -> pa.RecordBatch:
    """Edges, or (with ``ask``) rows sent to a block."""
    n = len(u) if ask is None else 1
    cols = [pa.array([slide] * n, pa.int64()), pa.array([blk] * n, pa.int32())]
    cols += [pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.nulls(n, pa.binary())] if ask is None else [pa.nulls(1, pa.int64())] * 2 + [pa.array([ask], pa.binary())]
    return pa.record_batch(cols, names=["slide_no", "blk", "u", "v", "ask"])


def meet_centres(batches: Iterator[pa.RecordBatch], least_sim: float, chunk: int = 1024) -> Iterator[pa.RecordBatch]:
    """A block's rows against the cores of other blocks of its slide: edges that the centres settle, and the rows in reach of the others."""
    reach = np.arccos(least_sim)
    for (slide, blk), x, core, rest in _block_first(batches):
        starts = _runs(core)
        names, xt = core[starts], x.T.copy()
        for sender, buf in rest:
            cores, asked, us, vs = np.frombuffer(buf, CENTRE), [], [], []
            for at in range(0, len(cores), chunk):
                part = cores[at : at + chunk]
                s = part["vec"] @ xt
                best = np.maximum.reduceat(s, starts, axis=1)
                sure = best >= least_sim + 1e-5
                c, o = np.nonzero(sure)
                us.append(part["core"][c])
                vs.append(names[o])
                bound = np.cos(np.minimum(np.pi, np.arccos(np.clip(part["radius"], -1, 1)) + reach)) - 1e-5
                bound = np.where(part["single"], least_sim - 1e-5, bound)
                for c, o in zip(*np.nonzero((best >= bound[:, None]) & ~sure)):
                    end = starts[o + 1] if o + 1 < len(starts) else len(core)
                    rows = starts[o] + np.flatnonzero(s[c, starts[o] : end] >= bound[c])
                    one = np.empty(len(rows), ASKED)
                    one["core"], one["other"], one["vec"] = part["core"][c], names[o], x[rows]
                    asked.append(one)
            u, v = _spanning(np.concatenate(us), np.concatenate(vs)) if sum(map(len, us)) else (names[:0], names[:0])
            yield _met(slide, blk, u, v)
            if asked:
                yield _met(slide, sender, u, v, np.concatenate(asked).tobytes())


def meet_members(batches: Iterator[pa.RecordBatch], least_sim: float) -> Iterator[pa.RecordBatch]:
    """Rows of other blocks against the members of the cores that they are in reach of: edges."""
    for (slide, blk), x, core, rest in _block_first(batches):
        starts = _runs(core)
        ends, names = np.append(starts[1:], len(core)), core[starts]
        for _, buf in rest:
            asked = np.frombuffer(buf, ASKED)
            asked = asked[np.lexsort((asked["other"], asked["core"]))]
            cuts = _runs(asked["core"])
            for s, e in zip(cuts, np.append(cuts[1:], len(asked))):
                i = np.searchsorted(names, asked["core"][s])
                u, v = adjacent_cores(np.ascontiguousarray(asked["vec"][s:e]), asked["other"][s:e], x[starts[i] : ends[i]], core[starts[i] : ends[i]], least_sim)
                yield _met(slide, blk, u, v)


def read_pairs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Two columns out of binaries that hold all of the first and then all of the second."""
    for b in batches:
        both = [np.frombuffer(v.as_buffer(), np.int64).reshape(2, -1) for v in b.column(0)]
        if both:
            first, second = np.concatenate(both, axis=1)
            yield pa.record_batch([pa.array(first), pa.array(second)], names=names)


def clusters(embeddings: DataFrame, slides: DataFrame, least_sim: float = 0.8, least: int = 5) -> DataFrame:
    """``(cell_key, first_key, size, core, core_size)``: the cells of every cluster.

    ``core`` is the cell's core and ``core_size`` the number of its cells: members of the largest core are
    the most typical ones.
    """
    spark = embeddings.sparkSession
    pts = cut(points(embeddings, slides))
    counts = cut(pts.groupBy("slide_no", "grid").agg(F.count(F.lit(1)).alias("cells")))
    # of each at most one row for every HOT or BLOCK points; the engine knows their size and joins accordingly
    hot = cut(counts.where(F.col("cells") > HOT).select("slide_no", "grid", F.ceil(F.col("cells") / HOT).alias("shares")))
    big = cut(counts.groupBy("slide_no").agg(F.ceil(F.sum("cells") / BLOCK).cast("int").alias("blocks")).where("blocks > 1"))
    total = counts.agg(F.coalesce(F.sum("cells"), F.lit(0))).first()[0]
    unit = F.xxhash64("grid", F.when(F.col("shares").isNotNull(), F.pmod(F.xxhash64("cell_key"), F.col("shares"))))
    placed = (
        pts.join(hot, ["slide_no", "grid"], "left")
        .join(big, "slide_no", "left")
        .select("slide_no", unit.alias("unit"), F.coalesce("blocks", F.lit(1)).alias("blocks"), "cell_key", "vec")
        .withColumn("blk", F.pmod("unit", F.col("blocks")).cast("int"))
    )
    n_parts = max(partitions(spark), -(-total // (2 * BLOCK)))
    packed = cut(placed.repartition(n_parts, "slide_no", "blk").mapInArrow(lambda it: make_blocks(it, least_sim), BLOCKS))
    discard(pts, counts, hot, big)
    whole = packed.where("blocks > 1").select("slide_no", "blk", F.lit(-1).alias("from"), "core", "vecs", F.lit(None).cast("binary").alias("sent"))

    def to_blocks(sent: DataFrame) -> DataFrame:
        rows = whole.unionByName(sent.select("slide_no", "blk", "from", F.lit(None).cast("binary").alias("core"), F.lit(None).cast("binary").alias("vecs"), "sent"))
        return rows.repartition(n_parts, "slide_no", "blk").sortWithinPartitions("slide_no", "blk", "from")

    higher = F.explode(F.sequence(F.col("blk") + 1, F.col("blocks") - 1)).alias("to")
    centres = packed.where("blk + 1 < blocks").select("slide_no", higher, F.col("blk").alias("from"), F.col("centres").alias("sent")).withColumnRenamed("to", "blk")
    met = cut(to_blocks(centres).mapInArrow(lambda it: meet_centres(it, least_sim), MET))
    asked = met.where("ask IS NOT NULL").select("slide_no", "blk", F.lit(0).alias("from"), F.col("ask").alias("sent"))
    across = met.where("ask IS NULL").select("u", "v").unionByName(to_blocks(asked).mapInArrow(lambda it: meet_members(it, least_sim), MET).select("u", "v"))
    edges = cut(packed.select("edges").mapInArrow(lambda it: read_pairs(it, ["u", "v"]), "u long, v long").unionByName(across))
    members = packed.select("keys").mapInArrow(lambda it: read_pairs(it, ["cell_key", "core"]), "cell_key long, core long")
    cores = cut(members.groupBy("core").agg(F.count(F.lit(1)).alias("core_size")))
    labels = minimum_labels(cores.select(F.col("core").alias("node")), edges).select(F.col("node").alias("core"), F.col("label").alias("first_key"))
    sized = labels.join(cores, "core")
    size = sized.groupBy("first_key").agg(F.sum("core_size").alias("size")).where(F.col("size") >= least)
    return members.join(sized.join(size, "first_key"), "core").select("cell_key", "first_key", "size", "core", "core_size")


def describe(members: DataFrame) -> DataFrame:
    """``(first_key, size, n_cores, densest_core, densest_size, typical)``: each cluster with its densest core.

    ``typical`` lists the smallest three keys of the core with most cells (ties: smaller core).
    """
    first = W.partitionBy("core").orderBy("cell_key")
    few = members.withColumn("r", F.row_number().over(first)).where("r <= 3")
    cores = few.groupBy("first_key", "size", "core", "core_size").agg(F.array_sort(F.collect_list("cell_key")).alias("typical"))
    rank = F.struct((-F.col("core_size")).alias("s"), F.col("core").alias("c"))
    top = cores.groupBy("first_key", "size").agg(F.count(F.lit(1)).alias("n_cores"), F.min_by(F.struct("core", "core_size", "typical"), rank).alias("t"))
    return top.select("first_key", "size", "n_cores", F.col("t.core").alias("densest_core"), F.col("t.core_size").alias("densest_size"), F.concat_ws(",", "t.typical").alias("typical"))


def against_labels(members: DataFrame, embeddings: DataFrame, results: DataFrame) -> DataFrame:
    """``(first_key, cluster_id, n)``: how many cells of each cluster carry each recorded cluster number.

    A cell without recorded number counts under null. Redelivered records and repeated cells count once.
    """
    cells = embeddings.where("cell_key IS NOT NULL").groupBy("cell_key").agg(F.max(F.struct("record_id", "label_id")).alias("c")).select("cell_key", "c.record_id", "c.label_id")
    recorded = results.select("record_id", F.explode("classified_cells").alias("c")).groupBy("record_id", F.col("c.label_id").alias("label_id")).agg(F.max("c.cluster_id").alias("cluster_id"))
    return members.select("cell_key", "first_key").join(cells, "cell_key").join(recorded, ["record_id", "label_id"], "left").groupBy("first_key", "cluster_id").agg(F.count(F.lit(1)).alias("n"))
