"""Problem 3: the most similar vectors of every vector.

NN-descent. A first neighbour graph comes from blocks of similar vectors; then every node takes part in rounds that join
the graph with itself: a node's neighbours, and the nodes it is a neighbour of, are compared with each other
(they are each other's neighbours of neighbours), and each keeps the best it has met: k + 2, and LOOSE times as many where
the last of those is further than COVER, because paths between rows far from all others are rare. An edge is *fresh* in the round
after it was found; a pair is compared only if one of the two edges that lead to it is fresh. In
the first graph an edge within one block is not fresh, because a block is compared in full. Rounds end
when fewer than UPDATES of all edges are new, or after ``rounds``.

Rounds run on buckets of about BUCKET nodes whose blocks are alike; what moves is packed into one row for each pair of buckets. A round
is three exchanges: buckets tell each other of the fresh edges that lead to their nodes and list each node's neighbours, with
at most WIDE nodes that it is a neighbour of (WIDE bounds the work at hubs; an edge left out keeps its forward copy); they ask for
the vectors that their lists name, each sent once to a bucket in 16-bit fixed point; they compare, and send what may be among
a node's best to its bucket. Similarities below NEAR are held in single precision. No task holds more than a bucket: BUCKET lists of at most LOOSE * (k + 2) + WIDE entries. Similarities found in fixed point are computed anew from the
full vectors before they are ranked or put out.

Blocks: leaders are chosen greedily in a sample of at most SAMPLE vectors (taken by hash of the key), so that
no two are more similar than COVER; leaders are gathered into blocks of about BLOCK rows by
recursive bisection. Every vector (not only the sample) goes to its nearest leader's block; one that no
leader covers also goes to the sparse blocks of its two nearest leaders, which hold uncovered vectors only, about
SPARSE of them, because their neighbours lie far apart. A block is compared in full, and a row also gets edges to the
leaders of other blocks that are nearer than its neighbours in its own; they connect the blocks.

Borders: where a pair of similarity NEAR or more has two leaders, at least one of its rows lies within half the pair's angle
of the plane between them. Every such row is a guest in the other leader's block: it meets all members, and they meet
it. An uncovered row is a guest only where a covered row can be that near; pairs of uncovered rows are left to
the sparse blocks and the rounds.

Crowds: a leader that more than UNIT rows follow is split before the exchange into parts of about UNIT rows, among the sample's
rows near it, and every part meets every other: its rows are guests in the following half of the parts. Guests of more than
HALL parts are spread over tasks, each with a copy of the part's members. If only edges of NEAR or more are asked
for, a row leaves out the parts that the planes between the sample's rows put out of reach. The work in a crowd is quadratic.

Exact copies of one vector beyond COPIES need no comparison: by the tie rule their
neighbours are the smallest keys among them; vectors with more than UNIT copies are taken out before the exchange.

Defined results: unusable embeddings have no neighbours; redeliveries of a key count once; ties go to the
smaller key; a collection of fewer than k + 1 vectors gives fewer neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import cut, discard, discard_part, partitions
from .columns import ROW, Columns, decode, gathered, joined, picked, row, scatter, to_buckets
from .vectors import DIM, pack, top_k, unpack, usable

SAMPLE, BLOCK, UNIT, SPARSE, COPIES, HALL = 16384, 4096, 12288, 16384, 64, 4
COVER, NEAR = 0.7, 0.98
BUCKET, WIDE, LOOSE, UPDATES = 32768, 64, 3, 0.01
EDGES = "node long, nbr long, sim double"
STATE, BACK, VECTOR, EDGE, LIST, ASK, ANSWER, MEMBER = range(8)


def sample_vectors(df: DataFrame, key: str, embedding: str, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, vectors)`` of at most about ``most`` usable rows, by hash of their key, one for each key."""
    step = max(1, df.count() // most)
    part = df.where(F.pmod(F.xxhash64(key), F.lit(step)) == 0).select(key, embedding)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = usable(b.column(1))
            yield pa.record_batch([b.column(0).take(pa.array(rows)), pack(x)], names=["key", "vec"])

    got = part.where(F.col(key).isNotNull()).mapInArrow(read, "key long, vec binary").toArrow()
    keys, first = np.unique(np.asarray(got.column(0)), return_index=True)
    x = unpack(got.column(1))[first]
    order = np.random.default_rng(3).permutation(len(keys))
    return keys[order], x[order]


def choose_leaders(x: np.ndarray, cover: float = COVER, chunk: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, leaders, weights)``: a greedy cover of the sample, as row numbers and vectors, and how many of it each leader covers.

    A leader that covers nothing but itself stands for no group and is left out.
    """
    if not len(x):
        return np.full(1, -1), np.zeros((1, x.shape[1]), np.float32), np.ones(1)
    leaders, rows = np.empty((0, x.shape[1]), np.float32), np.empty(0, np.int64)
    for at in range(0, len(x), chunk):
        part, name = x[at : at + chunk], np.arange(at, min(at + chunk, len(x)))
        if len(leaders):
            far = (part @ leaders.T).max(axis=1) < cover
            part, name = part[far], name[far]
        near = part @ part.T >= cover
        taken = np.zeros(len(part), bool)
        new = []
        for i in range(len(part)):
            if not taken[i]:
                new.append(i)
                taken |= near[i]
        leaders, rows = np.concatenate([leaders, part[new]]), np.concatenate([rows, name[new]])
    weights = np.zeros(len(leaders))
    for at in range(0, len(x), 2048):
        np.add.at(weights, (x[at : at + 2048] @ leaders.T).argmax(axis=1), 1)
    crowd = weights > 1
    return (rows[crowd], leaders[crowd], weights[crowd]) if crowd.any() else (rows, leaders, weights)


def group_leaders(leaders: np.ndarray, weights: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each leader: recursive bisection along the line between two far leaders."""
    rng = np.random.default_rng(5)
    out = np.zeros(len(leaders), np.int32)
    limit = weights.sum() / max(1, blocks)
    todo, n = [np.arange(len(leaders))], 0
    while todo:
        part = todo.pop()
        if weights[part].sum() <= limit * 1.3 or len(part) == 1:
            out[part] = n
            n += 1
            continue
        a = leaders[part[rng.integers(len(part))]]
        b = leaders[part[np.argmin(leaders[part] @ a)]]
        a = leaders[part[np.argmin(leaders[part] @ b)]]
        order = part[np.argsort(leaders[part] @ (a - b), kind="stable")]
        middle = np.searchsorted(np.cumsum(weights[order]), weights[order].sum() / 2)
        middle = min(max(1, int(middle)), len(order) - 1)
        todo += [order[:middle], order[middle:]]
    return out


class Crowd(NamedTuple):
    """The parts of one leader's followers: ``first`` is the first block of ``parts``, ``starts`` where each part begins in ``subs``."""

    first: int
    parts: int
    subs: np.ndarray
    part_of: np.ndarray
    starts: np.ndarray
    wide: np.ndarray | None


class Plan(NamedTuple):
    """``bucket_of`` spreads the blocks over buckets of about equal size. ``margin`` and ``Crowd.wide`` bound how much nearer a row is to one leader than to another if it has kin beyond their plane."""

    keys: np.ndarray
    leaders: np.ndarray
    block_of: np.ndarray
    sparse_of: np.ndarray
    crowds: dict[int, Crowd]
    margin: np.ndarray
    reach: float
    blocks: int
    bucket_of: np.ndarray
    lead_home: np.ndarray


def _planes(x: np.ndarray, sine: float) -> np.ndarray:
    """For each pair of unit vectors, the difference of similarities of a point at an angle of ``sine`` from the plane between them."""
    return (sine * np.sqrt(np.maximum(0, 2 - 2 * x.astype(np.float64) @ x.T.astype(np.float64))) + 1e-5).astype(np.float32)


def plan_blocks(x: np.ndarray, keys: np.ndarray, leaders: np.ndarray, weights: np.ndarray, total: int, least: float, buckets: int) -> Plan:
    """Blocks for the leaders (rows with ``keys``) of the sample ``x`` of ``total`` rows; leaders that more than UNIT rows follow get several."""
    angle = float(np.arccos(min(1.0, max(least, NEAR))))
    rows = weights * total / max(1, len(x))
    blocks = max(1, -(-total // BLOCK))
    crowded = rows > UNIT
    block_of = np.zeros(len(leaders), np.int32)
    if not crowded.all():
        share = weights[~crowded].sum() / max(1.0, weights.sum())
        block_of[~crowded] = group_leaders(leaders[~crowded], weights[~crowded], max(1, round(blocks * share)))
    n, crowds = int(block_of.max()) + 1 if not crowded.all() else 0, {}
    if crowded.any():
        near = np.concatenate([(x[at : at + 2048] @ leaders.T).argmax(axis=1) for at in range(0, len(x), 2048)])
    for c in np.flatnonzero(crowded):
        own = x[near == c]
        subs = own[: -(-int(4 * rows[c]) // UNIT)]
        held = np.zeros(len(subs))
        for at in range(0, len(own), 2048):
            np.add.at(held, (own[at : at + 2048] @ subs.T).argmax(axis=1), 1)
        part = group_leaders(subs, held, -(-int(rows[c]) // UNIT))
        order = np.argsort(part, kind="stable")
        subs, part = subs[order], part[order]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(part) != 0]))
        block_of[c] = n
        crowds[int(c)] = Crowd(n, len(starts), subs, part, starts, _planes(subs, np.sin(angle)) if least >= NEAR else None)
        n += len(starts)
    lone = max(0.0, 1 - weights.sum() / max(1, len(x)))
    sparse_of = group_leaders(leaders, weights, max(1, round(total * lone / SPARSE)))
    held = np.bincount(block_of, weights, minlength=n)
    for c, crowd in crowds.items():
        held[crowd.first : crowd.first + crowd.parts] = weights[c] / crowd.parts
    middle = (np.cumsum(held) - held / 2) / max(1e-9, held.sum())
    bucket_of = np.minimum((middle * buckets).astype(np.int32), buckets - 1)
    lead_home = block_of.copy()
    for c, crowd in crowds.items():
        lead_home[c] = crowd.first + crowd.part_of[(leaders[c] @ crowd.subs.T).argmax()]
    return Plan(keys, leaders, block_of, sparse_of, crowds, _planes(leaders, np.sin(angle / 2)), float(np.cos(np.arccos(COVER) + angle)), n, bucket_of, lead_home)


def _block(x: np.ndarray, leader: np.ndarray, plan: Plan) -> np.ndarray:
    """The block of each row under the given leader."""
    block = plan.block_of[leader]
    for c, crowd in plan.crowds.items():
        rows = np.flatnonzero(leader == c)
        if len(rows):
            block[rows] = crowd.first + crowd.part_of[(x[rows] @ crowd.subs.T).argmax(axis=1)]
    return block


def _border_guests(s: np.ndarray, best: np.ndarray, home: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """``(row, block)``: rows near the plane between their leader and another one, once for each block of that one."""
    top = s[np.arange(len(s)), best]
    near = (top[:, None] - s <= plan.margin[best]) & ((top >= COVER)[:, None] | (s >= plan.reach - 1e-5))
    near[np.arange(len(s)), best] = False
    row, to = np.nonzero(near)
    times = np.ones(len(plan.leaders), np.int64)
    for c, crowd in plan.crowds.items():
        times[c] = crowd.parts
    n = times[to]
    block = np.repeat(plan.block_of[to], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    row = np.repeat(row, n)
    pairs = np.unique(np.stack([row, block], axis=1)[block != home[row]], axis=0)
    return pairs[:, 0], pairs[:, 1]


def _crowd_guests(x: np.ndarray, best: np.ndarray, home: np.ndarray, plan: Plan) -> Iterator[tuple[np.ndarray, np.ndarray, int, bool]]:
    """``(rows, blocks, hall, guest)`` for rows in crowds: the parts they visit, and the further halls of their own part."""
    for c, crowd in plan.crowds.items():
        rows = np.flatnonzero(best == c)
        if not len(rows):
            continue
        m, part = crowd.parts, home[rows] - crowd.first
        open_parts = np.ones((len(rows), m), bool)
        if crowd.wide is not None:
            t = x[rows] @ crowd.subs.T
            a = t.argmax(axis=1)
            open_parts = np.logical_or.reduceat(t[np.arange(len(rows)), a][:, None] - t <= crowd.wide[a], crowd.starts, axis=1)
        for step in range(1, m // 2 + 1):
            hall, to = (step - 1) // HALL, (part + step) % m
            go = open_parts[np.arange(len(rows)), to] & ((2 * step != m) | (part < step))
            yield rows[go], crowd.first + to[go], hall, True
            if hall and (step - 1) % HALL == 0:
                yield rows, home[rows], hall, False


def place(batches: Iterator[pa.RecordBatch], plan: Plan, tasks: int) -> Iterator[pa.RecordBatch]:
    """Sends each usable vector to its block and to those it is a guest in, uncovered ones also to two sparse blocks (numbered below 0).

    Blocks and their halls go to tasks in turn.
    """
    ids = plan.blocks + int(plan.sparse_of.max()) + 1
    leaders = plan.leaders
    for b in batches:
        rows, x = usable(b.column(1))
        keys = np.asarray(b.column(0).take(pa.array(rows)))
        sent: list[tuple[np.ndarray, np.ndarray, int, bool]] = []
        homes = np.empty(len(rows), np.int32)
        for at in range(0, len(rows), 2048):
            part = x[at : at + 2048]
            s = part @ leaders.T
            best = s.argmax(axis=1)
            home = homes[at : at + 2048] = _block(part, best, plan)
            alone = np.flatnonzero(s[np.arange(len(part)), best] < COVER)
            sparse = plan.sparse_of[best[alone]]
            other = s[alone].copy()
            other[plan.sparse_of[None, :] == sparse[:, None]] = -2
            second = plan.sparse_of[other.argmax(axis=1)] if len(alone) else sparse
            twice = second != sparse
            found = [
                (np.arange(len(part)), home, 0, False),
                (alone, -1 - sparse, 0, False),
                (alone[twice], -1 - second[twice], 0, False),
                (*_border_guests(s, best, home, plan), 0, True),
                *_crowd_guests(part, best, home, plan),
            ]
            sent += [(at + v[0], *v[1:]) for v in found]
        if not sent:
            continue
        src, dst = np.concatenate([v[0] for v in sent]), np.concatenate([v[1] for v in sent]).astype(np.int32)
        n = [len(v[0]) for v in sent]
        hall, guest = np.repeat(np.array([v[2] for v in sent], np.int32), n), np.repeat([v[3] for v in sent], n)
        to = (np.where(dst < 0, plan.blocks - 1 - dst, dst) + hall * np.int64(ids)) % tasks
        yield from scatter(MEMBER, to, {"block": dst, "hall": hall, "guest": guest, "home": homes[src], "key": keys[src], "vec": x[src]})


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine similarity of paired rows in double precision, to nine places."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.round(np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b)), 9)


def _edges(node: np.ndarray, nbr: np.ndarray, sim: np.ndarray) -> list[pa.Array]:
    return [pa.array(node.astype(np.int64)), pa.array(nbr.astype(np.int64)), pa.array(sim.astype(np.float64))]


def _first(node: np.ndarray, home: np.ndarray, nbr: np.ndarray, nbr_home: np.ndarray, sim: np.ndarray) -> Columns:
    return {"node": node.astype(np.int64), "home": home.astype(np.int32), "nbr": nbr.astype(np.int64), "nbr_home": nbr_home.astype(np.int32), "sim": sim.astype(np.float64)}


def _nearest(q_keys: np.ndarray, q: np.ndarray, keys: np.ndarray, x: np.ndarray, k: int, loose: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, column, similarity)`` of the rows of ``x`` nearest to each of ``q`` under another key, as many as ``_within`` keeps (or more, if ``loose`` says that most are far), a chunk at a time."""
    m = x.T.copy()
    chunk = max(32, min(256, (1 << 23) // max(1, len(x))))  # many rows at once, because the product of few costs twice as much for each
    order = np.argsort(keys, kind="stable")
    room = np.empty((min(chunk, len(q)), len(x)), np.float32)
    for at in range(0, len(q) if len(x) else 0, chunk):
        own = q_keys[at : at + chunk]
        s = np.matmul(q[at : at + chunk], m, out=room[: len(own)])
        pos = np.minimum(np.searchsorted(keys, own, sorter=order), len(keys) - 1)
        same = np.flatnonzero(keys[order[pos]] == own)
        s[same, order[pos[same]]] = -2
        row, col, val = top_k(s, keys, LOOSE * k if loose else k)
        if loose:
            yield row + at, col, val
            continue
        worst = np.full(len(s), -2.0, np.float32)
        worst[row] = val  # the last of each row
        far = np.flatnonzero((worst < COVER) & (np.bincount(row, minlength=len(s)) == k))
        if len(far):
            r, c, v = top_k(s[far], keys, LOOSE * k)
            near = ~np.isin(row, far)
            row, col, val = np.concatenate([row[near], far[r]]), np.concatenate([col[near], c]), np.concatenate([val[near], v])
            by = np.argsort(row, kind="stable")
            row, col, val = row[by], col[by], val[by]
        yield row + at, col, val


def _near_exact(x: np.ndarray, a: np.ndarray, b: np.ndarray, val: np.ndarray) -> np.ndarray:
    """Similarities ``val`` of the rows ``a`` and ``b`` of ``x``; those about NEAR or more are computed anew in double precision."""
    sim = val.astype(np.float64)
    near = np.flatnonzero(val >= NEAR - 1e-3)
    sim[near] = exact(x[a[near]], x[b[near]])
    return sim


def _compare(key: np.ndarray, home: np.ndarray, x: np.ndarray, guest: np.ndarray, hall: int, sparse: bool, k: int, plan: Plan) -> Iterator[Columns]:
    """The best ``k`` of every member of one block (rows in order of key) and of its guests among the members, and of members among guests.

    A member also gets edges to those leaders of other blocks that are nearer than its ``k``-th in the block.
    """
    rows, g = np.flatnonzero(~guest), np.flatnonzero(guest)
    if not len(rows):
        return
    codes = np.unique(x[rows].view(np.void(x.dtype.itemsize * x.shape[1]).dtype).ravel(), return_inverse=True)[1]
    rank = np.empty(len(rows), np.int64)
    by = np.argsort(codes, kind="stable")
    first = np.concatenate([[0], np.flatnonzero(np.diff(codes[by])) + 1])
    rank[by] = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
    if rank.max() >= COPIES:
        late = rows[rank > k]
        if hall == 0:
            lows = {c: rows[by[f : f + k]] for c, f in zip(codes[by[first]], first)}
            to = np.concatenate([lows[c] for c in codes[rank > k]]) if len(late) else late
            at = np.repeat(late, [len(lows[c]) for c in codes[rank > k]]) if len(late) else late
            yield _first(key[at], home[at], key[to], home[to], np.ones(len(at)))
        rows = rows[rank <= k]
    for q, to in ((rows, rows), (g, rows), (rows, g)):
        if q is to and hall:
            continue
        for r, c, val in _nearest(key[q], x[q], key[to], x[to], k, sparse):
            a, b = q[r], to[c]
            sim = _near_exact(x, a, b, val)
            yield _first(key[a], home[a], key[b], home[b], sim)
            if q is to and not sparse:
                yield _leads(q[np.unique(r)], a, sim, key, home, x, k, plan)


def _leads(rows: np.ndarray, node: np.ndarray, sim: np.ndarray, key: np.ndarray, home: np.ndarray, x: np.ndarray, k: int, plan: Plan) -> Columns:
    """Edges from ``rows`` to the at most ``k`` nearest leaders elsewhere that beat the worst of a row's edges ``(node, sim)``."""
    worst = np.full(len(key), 2.0)
    np.minimum.at(worst, node, sim)
    n = np.bincount(node, minlength=len(key))
    worst[(n < LOOSE * k) & ((n < k) | (worst < COVER))] = -2
    s = x[rows] @ plan.leaders.T
    lead_home = plan.lead_home
    s[(s <= worst[rows][:, None]) | (lead_home[None, :] == home[rows][:, None]) | (plan.keys < 0)[None, :]] = -2
    r, c, val = top_k(s, plan.keys, LOOSE * k)
    sim, near = val.astype(np.float64), val >= NEAR - 1e-3
    sim[near] = exact(x[rows[r[near]]], plan.leaders[c[near]])
    return _first(key[rows[r]], home[rows[r]], plan.keys[c], lead_home[c], sim)


def _runs(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, lengths)`` of the runs of equal nodes."""
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.empty(0, np.int64)
    return start, np.diff(np.append(start, len(node)))


def _ranks(node: np.ndarray) -> np.ndarray:
    """The position of each row in its run of equal nodes."""
    start, n = _runs(node)
    return np.arange(len(node)) - np.repeat(start, n)


def _among(names: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position, found)`` of nodes among names in ascending order; looked up once for each run of equal nodes."""
    start, n = _runs(node)
    head = node[start]
    at = np.minimum(np.searchsorted(names, head), len(names) - 1)
    return np.repeat(at, n), np.repeat(names[at] == head, n)


def _within(node: np.ndarray, sim: np.ndarray, k: int) -> np.ndarray:
    """Of edges in order of node and nearness, each node's first ``k``; LOOSE times as many if the ``k``-th is further than COVER."""
    start, n = _runs(node)
    far = (n >= k) & (sim[np.minimum(start + k - 1, max(0, len(node) - 1))] < COVER)
    return np.arange(len(node)) - np.repeat(start, n) < np.repeat(np.where(far, LOOSE * k, k), n)


def compare_blocks(batches: Iterator[pa.RecordBatch], k: int, plan: Plan) -> Iterator[pa.RecordBatch]:
    """Edges of the first graph, sent to the bucket of their node."""
    for _, kinds in gathered(batches):
        rows = joined(kinds[MEMBER])
        order = np.lexsort((rows["guest"], rows["key"], rows["hall"], rows["block"]))
        block, hall, key = (rows[c][order] for c in ("block", "hall", "key"))
        new = np.concatenate([[True], (np.diff(block) != 0) | (np.diff(hall) != 0)])
        order = order[new | np.concatenate([[True], np.diff(key) != 0])]  # members before guests, redeliveries once
        block, hall = rows["block"][order], rows["hall"][order]
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 0) | (np.diff(hall) != 0)]))
        for s, e in zip(cuts, [*cuts[1:], len(order)]):
            part = picked(rows, order[s:e])
            found = [f for f in _compare(part["key"], part["home"], part["vec"], part["guest"], int(hall[s]), bool(block[s] < 0), k, plan) if len(f["node"])]
            if found:
                edges = joined(found)
                flags = {"fresh": edges["home"] != edges["nbr_home"], "rough": np.zeros(len(edges["node"]), bool)}
                yield from scatter(EDGE, plan.bucket_of[edges["home"]], edges | flags)

def vectors_at_home(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Sends each usable vector in fixed point to the bucket of its block."""
    for b in batches:
        rows, x = usable(b.column(1))
        keys = np.asarray(b.column(0).take(pa.array(rows)))
        best = np.concatenate([np.empty(0, np.int64), *[(x[at : at + 2048] @ plan.leaders.T).argmax(axis=1) for at in range(0, len(x), 2048)]]).astype(np.int64)
        home = _block(x, best, plan).astype(np.int32)
        yield from scatter(VECTOR, plan.bucket_of[home], {"node": keys, "home": home, "vec": to_fixed(x)})


def to_fixed(x: np.ndarray) -> np.ndarray:
    """Unit vectors as 16-bit numbers with their scale in front, 102 bytes for 50 numbers; the error of a similarity is about 1e-5."""
    scale = np.maximum(np.abs(x).max(axis=1), 1e-9).astype(np.float32) if len(x) else np.empty(0, np.float32)
    out = np.empty((len(x), x.shape[1] + 2), np.int16)
    out[:, :2] = scale.view(np.int16).reshape(-1, 2)
    out[:, 2:] = np.round(x / scale[:, None] * 32767)
    return out


def from_fixed(raw: np.ndarray) -> np.ndarray:
    scale = np.ascontiguousarray(raw[:, :2]).view(np.float32)
    return raw[:, 2:].astype(np.float32) * (scale / 32767)


def _once(at: np.ndarray, nbr: np.ndarray) -> np.ndarray:
    """Positions of the first of every pair, in order of ``at`` (numbers below 2**25); a pair kept twice by a clash of mixes does no harm."""
    with np.errstate(over="ignore"):
        mix = (at << 38) | ((nbr * np.int64(-4417276706812531889) ^ (nbr >> 31)) >> 26 & ((1 << 38) - 1))
    order = np.argsort(mix)
    new = np.concatenate([[True], (np.diff(mix[order]) != 0) | (np.diff(nbr[order]) != 0)])
    return np.minimum.reduceat(order, np.flatnonzero(new))


def _in_order(node: np.ndarray, nbr: np.ndarray, sim: np.ndarray) -> np.ndarray:
    """The order by node (numbers below 2**31), similarity descending, neighbour."""
    key = (node << 32) | ((1.5 - sim) * (1 << 30)).astype(np.int64)
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
    part = order[tied]
    order[tied] = part[np.lexsort((nbr[part], -sim[part], key[part]))]
    return order


def settle(batches: Iterator[pa.RecordBatch], plan: Plan, k: int) -> Iterator[pa.RecordBatch]:
    """Keeps the best edges of each node of a bucket (``_within``) out of those it had and those found, and tells other buckets of the
    fresh edges that lead to them. Of an edge that was there and is found again, the old one stays."""
    for bucket, kinds in gathered(batches):
        if not kinds[STATE] + kinds[EDGE]:
            continue
        old = [s | {"fresh": np.zeros(len(s["node"]), bool)} for s in kinds[STATE]]
        still = []
        if kinds[EDGE]:
            e = joined(kinds[EDGE])
            touched = np.unique(e["node"])
            for s in old:
                at = _among(touched, s["node"])[1]
                still.append(picked(s, np.flatnonzero(~at)))
                e = joined([picked(s, np.flatnonzero(at)), e])  # what was there comes first
            at = _among(touched, e["node"])[0]
            one = _once(at, e["nbr"])
            one = one[_in_order(at[one], e["nbr"][one], e["sim"][one])]
            e = joined([*still, picked(e, one[_within(at[one], e["sim"][one], k)])])
        else:
            e = joined(old)
        yield row(bucket, STATE, e, int(e["fresh"].sum()), len(e["node"]))
        to = plan.bucket_of[e["nbr_home"]]
        out = np.flatnonzero((to != bucket) & e["fresh"])
        yield from scatter(BACK, to[out], {"node": e["nbr"][out], "home": e["nbr_home"][out], "to": e["node"][out], "to_home": e["home"][out]})


def list_neighbours(batches: Iterator[pa.RecordBatch], plan: Plan, seed: int) -> Iterator[pa.RecordBatch]:
    """The list of each node of a bucket that a fresh edge leads from or to: itself, its neighbours and at most WIDE nodes that it is a
    neighbour of (fresh ones first, the others in an order without meaning). Asks the buckets of all nodes named for their vectors."""
    for bucket, kinds in gathered(batches, {STATE: ("node", "home", "nbr", "nbr_home", "fresh")}):
        e = joined(kinds[STATE]) if kinds[STATE] else None
        own = np.flatnonzero(plan.bucket_of[e["nbr_home"]] == bucket) if e else []
        fresh = [e["node"][e["fresh"]], e["nbr"][own][e["fresh"][own]]] if e else []
        active = np.unique(np.concatenate([np.empty(0, np.int64), *fresh, *[r["node"] for r in kinds[BACK]]]))
        if not len(active):
            continue

        parts = []
        if e:
            at, there = _among(active, e["node"])
            out = np.flatnonzero(there)
            parts.append({"at": at[out], "home": e["home"][out], "to": e["nbr"][out], "to_home": e["nbr_home"][out], "fresh": e["fresh"][out], "back": np.zeros(len(out), bool)})
            at, there = _among(active, e["nbr"][own])
            own = own[there]
            parts.append({"at": at[there], "home": e["nbr_home"][own], "to": e["node"][own], "to_home": e["home"][own], "fresh": e["fresh"][own], "back": np.ones(len(own), bool)})
        for r in kinds[BACK]:
            yes = np.ones(len(r["to"]), bool)
            parts.append({"at": np.searchsorted(active, r["node"]), "home": r["home"], "to": r["to"], "to_home": r["to_home"], "fresh": yes, "back": yes})
        e = joined(parts)
        at = e["at"]
        with np.errstate(over="ignore"):
            mixed = ((e["to"] * np.int64(2654435761) + active[at] * np.int64(40503) + seed * 97) * np.int64(2246822519) >> 20) & 0xFFFFF
        order = np.argsort((at << 22) | (e["back"].astype(np.int64) << 21) | ((~e["fresh"]).astype(np.int64) << 20) | mixed)
        order = order[~e["back"][order] | (_ranks((at * 2 + e["back"])[order]) < WIDE)]
        first = np.empty(len(active), np.int64)
        first[at[order]] = order
        me = {"at": np.arange(len(active)), "to": active, "to_home": e["home"][first], "fresh": np.zeros(len(active), bool)}
        order = np.concatenate([order[e["fresh"][order]], order[~e["fresh"][order]]])  # where a node is named twice, the fresh edge counts
        e = joined([{c: e[c][order] for c in me}, me])
        e = picked(e, _once(e["at"], e["to"]))
        order = np.argsort(e["to"])
        start, n = _runs(e["to"][order])
        to = np.empty(len(order), np.int64)
        to[order] = np.repeat(np.arange(len(n)), n)
        named = e["to"][order[start]]
        yield row(bucket, LIST, {"at": e["at"], "to": to, "fresh": e["fresh"], "named": named})
        yield from scatter(ASK, plan.bucket_of[e["to_home"][order[start]]], {"node": named, "asker": np.full(len(named), bucket, np.int32)})


def answer(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sends vectors to the buckets that ask for them, each with the similarity that a better edge of it has to exceed."""
    for _, kinds in gathered(batches, {STATE: ("node", "sim")}):
        if not kinds[ASK] or not kinds[VECTOR]:
            continue
        v = joined(kinds[VECTOR])
        nodes, first = np.unique(v["node"], return_index=True)
        n, worst = np.zeros(len(nodes), np.int64), np.full(len(nodes), 2.0)
        for e in kinds[STATE]:
            start, held = _runs(e["node"])  # a node's edges stand together
            at = np.searchsorted(nodes, e["node"][start])
            np.add.at(n, at, held)
            np.minimum.at(worst, at, np.minimum.reduceat(e["sim"], start) if len(start) else e["sim"])
        full = (n >= LOOSE * k) | ((n == k) & (worst >= COVER))
        bound = np.where(full, worst, -2).astype(np.float32)
        for ask in kinds[ASK]:
            pos = np.minimum(np.searchsorted(nodes, ask["node"]), len(nodes) - 1)
            pos = pos[nodes[pos] == ask["node"]]
            yield row(int(ask["asker"][0]), ANSWER, {"node": nodes[pos], "home": v["home"][first[pos]], "vec": v["vec"][first[pos]], "bound": bound[pos]})


def join_lists(batches: Iterator[pa.RecordBatch], plan: Plan, k: int) -> Iterator[pa.RecordBatch]:
    """Compares the entries of each list with each other. Puts out what may be among a node's best, to the bucket of that node."""
    for _, kinds in gathered(batches):
        if not kinds[LIST] or not kinds[ANSWER]:
            continue
        there, (e,) = joined(kinds[ANSWER]), kinds[LIST]
        there = picked(there, np.argsort(there["node"]))
        pos = np.minimum(np.searchsorted(there["node"], e["named"]), len(there["node"]) - 1)
        known = np.flatnonzero((there["node"][pos] == e["named"])[e["to"]])
        n = _runs(e["at"][known])[1]
        a, b, s = _local_join(np.repeat(np.arange(len(n)), n), pos[e["to"][known]], e["fresh"][known], from_fixed(there["vec"]), there["node"], there["bound"], LOOSE * k)
        flags = {"fresh": np.ones(len(a), bool), "rough": np.ones(len(a), bool)}
        yield from scatter(EDGE, plan.bucket_of[there["home"][a]], _first(there["node"][a], there["home"][a], there["node"][b], there["home"][b], s) | flags)


def _local_join(at: np.ndarray, pos: np.ndarray, fresh: np.ndarray, x: np.ndarray, keys: np.ndarray, bound: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, similarity)`` of pairs of one list, at least one of them fresh, that exceed the bound of ``a``: at most ``most`` for each ``a``.

    ``at`` numbers the lists in ascending order; ``pos`` are rows of ``x``. Lists with about as many entries and fresh ones are compared
    together, the fresh entries of each with all of it.
    """
    count, new = np.bincount(at), np.bincount(at, fresh).astype(np.int64)
    begin = np.cumsum(count) - count
    rank = np.cumsum(fresh) - fresh - (np.cumsum(new) - new)[at]
    first = np.empty_like(pos)  # the entries of each list, fresh ones before the others
    first[begin[at] + np.where(fresh, rank, new[at] + np.arange(len(at)) - begin[at] - rank)] = pos
    kind = -(-new // 4) * (int(count.max(initial=0)) + 8) + count // 8
    by_kind = np.argsort(kind, kind="stable")
    by_kind = by_kind[new[by_kind] > 0]
    x = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    limit = np.append(bound, np.float32(2))
    out: list[list[np.ndarray]] = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.float32)]]
    for lo, n in zip(*_runs(kind[by_kind])):
        alike = by_kind[lo : lo + n]
        width, few = int(count[alike].max()), int(new[alike].max())
        step, slot = max(1, min(2048, (1 << 22) // (width * few))), np.arange(width)[None, :]
        for lists in (alike[i : i + step] for i in range(0, n, step)):
            grid = np.where(slot < count[lists][:, None], first[np.minimum(begin[lists][:, None] + slot, len(first) - 1)], len(bound))
            isnew = slot < new[lists][:, None]
            v, least = x[grid], limit[grid]
            s = v[:, :few] @ v.transpose(0, 2, 1)
            own = s > least[:, :few, None]
            own &= isnew[:, :few, None]
            own[:, slot[0, :few], slot[0, :few]] = False
            other = s > least[:, None, :]
            other &= isnew[:, :few, None] & ~isnew[:, None, :]  # of two fresh entries each has a row
            for ok, back in ((own, False), (other, True)):
                i = np.flatnonzero(ok)
                row = i // width
                a, b = grid[:, :few].ravel()[row], grid.ravel()[row // few * width + (i - row * width)]
                keep = b < len(bound)
                a, b = a[keep], b[keep]
                out[0].append(b if back else a)
                out[1].append(a if back else b)
                out[2].append(s.ravel()[i[keep]])
    a, b, s = (np.concatenate(v) for v in out)
    if not len(a):
        return a, b, s
    pair = a * len(bound) + b
    order = np.argsort(pair)
    one = order[_runs(pair[order])[0]]
    a, b, s = a[one], b[one], s[one]
    one = _in_order(a, keys[b], s.astype(np.float64))
    a, b, s = a[one], b[one], s[one]
    keep = _ranks(a) < most
    return a[keep], b[keep], s[keep]


def read_edges(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for body in b.column("body"):
            e = decode(memoryview(body.as_buffer()), ("node", "nbr", "sim", "rough"))
            e = picked(e, e["sim"] >= least)
            yield pa.record_batch([*_edges(e["node"], e["nbr"], e["sim"]), pa.array(e["rough"])], names=["node", "nbr", "sim", "rough"])


def without_mass_copies(rows: DataFrame, key: str, embedding: str, k: int) -> tuple[DataFrame, DataFrame | None]:
    """``(rows, edges)``: of vectors with more than UNIT exact copies only the ``k + 1`` smallest keys stay among the rows.

    The others' neighbours follow from the tie rule: ``edges`` leads from each to the ``k`` smallest keys. There
    are at most (number of rows) / UNIT such vectors.
    """
    counts = rows.where(F.col(embedding).isNotNull()).groupBy(F.xxhash64(embedding).alias("h")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > UNIT)
    hot = [r.h for r in counts.select("h").collect()]
    if not hot:
        return rows, None
    marked = rows.withColumn("h", F.xxhash64(embedding))
    mass = marked.join(F.broadcast(rows.sparkSession.createDataFrame([(h,) for h in hot], "h long")), "h").select("h", F.col(key).alias("key")).where("key IS NOT NULL").distinct()
    lows = cut(mass.withColumn("r", F.row_number().over(W.partitionBy("h").orderBy("key"))).where(F.col("r") <= k + 1))  # a window group limit keeps k + 1 keys a task
    low = lows.where(F.col("r") <= k).select("h", F.col("key").alias("nbr"))
    rest = mass.join(F.broadcast(lows.select("h", "key")), ["h", "key"], "left_anti")  # k + 1 keys for each such vector
    edges = rest.join(F.broadcast(low), "h").select(F.col("key").alias("node"), "nbr", F.lit(1.0).alias("sim"))
    return marked.join(rest.select(F.col("key").alias(key)), key, "left_anti").select(key, embedding), edges


def descent_graph(df: DataFrame, key: str = "cell_key", embedding: str = "embedding", k: int = 10, rounds: int = 8, least: float = -1.0) -> DataFrame:
    """``(node, nbr, sim, rough)``: the best ``k + 2`` edges found for every node and the edges of mass copies.

    ``sim`` of a rough edge is in fixed point, and the two edges beyond ``k`` are room for its error. Edges below ``least`` are
    not put out; a crowd's edges below ``least`` need not be complete.
    """
    spark, width = df.sparkSession, k + 2
    rows, copies = without_mass_copies(df.select(key, embedding), key, embedding, width)
    names, sample = sample_vectors(rows, key, embedding)
    at, leaders, weights = choose_leaders(sample)
    total = rows.count()
    buckets = max(partitions(spark), -(-total // BUCKET))
    plan = plan_blocks(sample, names[at] if len(names) else at, leaders, weights, total, least, buckets)
    shared = spark.sparkContext.broadcast(plan)  # at most SAMPLE vectors
    tasks = max(buckets, plan.blocks + int(plan.sparse_of.max()) + 1)
    placed = rows.where(F.col(key).isNotNull()).mapInArrow(lambda it: place(it, shared.value, tasks), ROW)
    first = to_buckets(placed, tasks).mapInArrow(lambda it: compare_blocks(it, width, shared.value), ROW)
    graph = cut(to_buckets(first, buckets).mapInArrow(lambda it: settle(it, shared.value, width), ROW), by="kind", packed=True)
    vectors = None
    for seed in range(rounds):
        fresh, edges = graph.where(F.col("kind") == STATE).agg(F.sum("fresh"), F.sum("total")).first()
        if (fresh or 0) <= UPDATES * (edges or 0) and seed or not fresh:
            break
        if vectors is None:
            at_home = rows.where(F.col(key).isNotNull()).mapInArrow(lambda it: vectors_at_home(it, shared.value), ROW)
            vectors = cut(to_buckets(at_home, buckets), packed=True)
        state = graph.where(F.col("kind") == STATE)
        lists = cut(to_buckets(graph.where(F.col("kind").isin(STATE, BACK)), buckets).mapInArrow(lambda it, seed=seed: list_neighbours(it, shared.value, seed), ROW), by="kind", packed=True)
        discard_part(graph, "kind", BACK)
        asked = lists.where(F.col("kind") == ASK).unionByName(vectors).unionByName(state)
        answers = to_buckets(asked, buckets).mapInArrow(lambda it: answer(it, width), ROW)
        found = cut(to_buckets(lists.where(F.col("kind") == LIST).unionByName(answers), buckets).mapInArrow(lambda it: join_lists(it, shared.value, width), ROW), packed=True)
        discard(lists)
        step = cut(to_buckets(state.unionByName(found), buckets).mapInArrow(lambda it: settle(it, shared.value, width), ROW), by="kind", packed=True)
        discard(found, graph)
        graph = step
    out = cut(graph.where(F.col("kind") == STATE).select("body").mapInArrow(lambda it: read_edges(it, least - 1e-4), EDGES + ", rough boolean"))
    discard(graph, vectors)
    return out if copies is None else out.unionByName(copies.withColumn("rough", F.lit(False)))


def rescored(edges: DataFrame, df: DataFrame, key: str, embedding: str) -> DataFrame:
    """``(node, nbr, sim)`` with the similarities of rough edges computed from the full vectors."""
    vectors = unit_rows(df, key, embedding)
    rough = edges.where("rough").select("node", "nbr")
    pairs = rough.join(vectors.select(F.col("key").alias("node"), F.col("vec").alias("q")), "node").join(vectors.withColumnRenamed("key", "nbr"), "nbr")
    return edges.where("NOT rough").select("node", "nbr", "sim").unionByName(pairs.select("node", "nbr", "vec", "q").mapInArrow(_dot, EDGES))


def best(edges: DataFrame, k: int) -> DataFrame:
    """The best ``k`` distinct neighbours of every node: similarity descending, then key."""
    order = W.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    return edges.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_graph(df: DataFrame, key: str = "cell_key", embedding: str = "embedding", k: int = 10, rounds: int = 8) -> DataFrame:
    """``(node, nbr, sim, rank)``: the approximate ``k`` nearest neighbours of every usable vector."""
    return best(rescored(descent_graph(df, key, embedding, k, rounds), df, key, embedding), k)


def near_pairs(df: DataFrame, k: int = 10, least: float = 0.98, key: str = "cell_key", embedding: str = "embedding") -> DataFrame:
    """``(cell_key_a, cell_key_b)``: pairs with similarity of at least ``least`` of which one is among the other's best ``k``.

    Edges below ``least`` rank behind all others, so only the rest of the graph is put out and ranked.
    """
    near = best(rescored(descent_graph(df, key, embedding, k, least=least), df, key, embedding), k).where(F.col("sim") >= least)
    return near.select(F.least("node", "nbr").alias("cell_key_a"), F.greatest("node", "nbr").alias("cell_key_b")).distinct()


def unit_rows(df: DataFrame, key: str = "cell_key", embedding: str = "embedding") -> DataFrame:
    """``(key, vec)``: the usable vectors, one row for each key."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = usable(b.column(1))
            yield pa.record_batch([b.column(0).take(pa.array(rows)), pack(x)], names=["key", "vec"])

    return df.where(F.col(key).isNotNull()).select(key, embedding).mapInArrow(read, "key long, vec binary").dropDuplicates(["key"])


def exact_neighbours(df: DataFrame, queries: DataFrame, k: int = 10, key: str = "cell_key", embedding: str = "embedding", chunk: int = 32768) -> DataFrame:
    """``(node, nbr, sim, rank)`` of the query rows against all rows: every chunk of rows meets every query, in blocks.

    The measure for the graph's recall; its cost is the number of queries times the number of rows.
    """
    base, q = unit_rows(df, key, embedding), unit_rows(queries, key, embedding)
    chunks = max(1, -(-df.count() // chunk))
    parts = base.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int"))
    asked = q.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, m = np.asarray(left.column("key")), unpack(left.column("vec"))
        q_keys, x = np.asarray(right.column("key")), unpack(right.column("vec"))
        out = [pa.record_batch(_edges(*[np.empty(0)] * 3), names=["node", "nbr", "sim"])]
        for at in range(0, len(x) if len(m) else 0, 512):
            s = x[at : at + 512] @ m.T
            s[q_keys[at : at + 512][:, None] == keys[None, :]] = -2
            row, col, _ = top_k(s, keys, k + 2)
            out.append(pa.record_batch(_edges(q_keys[at + row], keys[col], exact(x[at + row], m[col])), names=["node", "nbr", "sim"]))
        return pa.Table.from_batches(out)

    return best(parts.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(run, EDGES), k)


BANDS = (0.5, 0.7, 0.9)


def recall_of(found: DataFrame, true: DataFrame) -> DataFrame:
    """``(band, queries, neighbours, found, recall)``: how many true neighbours ``found`` has, in all and by the similarity of a query's nearest."""
    nearest = true.groupBy("node").agg(F.max("sim").alias("top"))
    name = F.lit(f"from {BANDS[-1]}")
    for at in reversed(BANDS):
        name = F.when(F.col("top") < at, F.lit(f"below {at}")).otherwise(name)
    hits = true.select("node", "nbr").join(found.select("node", "nbr", F.lit(1).alias("hit")), ["node", "nbr"], "left").join(nearest.select("node", name.alias("band")), "node")
    n, hit = F.count(F.lit(1)), F.coalesce(F.sum("hit"), F.lit(0))
    out = hits.rollup("band").agg(F.count_distinct("node").alias("queries"), n.alias("neighbours"), hit.alias("found"), F.try_divide(hit, n).alias("recall"))
    return out.withColumn("band", F.coalesce("band", F.lit("all")))


def recall(df: DataFrame, every: int = 20, k: int = 10, key: str = "cell_key", embedding: str = "embedding") -> DataFrame:
    """The graph's ``recall_of`` for the rows whose key ``every`` divides, against brute force over all rows."""
    true = cut(exact_neighbours(df, df.where(F.col(key) % every == 0), k, key, embedding))
    return recall_of(knn_graph(df, key, embedding, k).where(F.col("node") % every == 0), true)


def search_recall(df: DataFrame, every: int = 20, k: int = 10, key: str = "cell_key", embedding: str = "embedding") -> DataFrame:
    """The ``recall_of`` greedy search for the rows whose key ``every`` divides."""
    asked = df.where(F.col(key) % every == 0)
    true = cut(exact_neighbours(df, asked, k, key, embedding))
    return recall_of(graph_search(df, asked, k, key=key, embedding=embedding), true)


def _dot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sim = exact(unpack(b.column(2)), unpack(b.column(3))) if b.num_rows else np.empty(0)
        yield pa.record_batch([b.column(0), b.column(1), pa.array(sim)], names=["node", "nbr", "sim"])


def graph_search(df: DataFrame, queries: DataFrame, k: int = 10, beam: int = 32, hops: int = 12, entries: int = 8, key: str = "cell_key", embedding: str = "embedding") -> DataFrame:
    """``(node, nbr, sim, rank)``: neighbours of the query rows by greedy search on the graph.

    A search starts at the ``entries`` leaders nearest to the query (leaders are at most SAMPLE rows, whatever the data's size) and
    holds the ``beam`` best rows it has seen; each hop looks at the graph neighbours, in either direction, of those held rows
    that it has not looked at before, and the search ends when no query has such a row, or after ``hops``. A row passes on at most
    WIDE of the nodes that it is a neighbour of.
    """
    spark = df.sparkSession
    edges = descent_graph(df, key, embedding, k).select("node", "nbr", "sim")
    few = W.partitionBy("at").orderBy(F.desc("sim"), "to")
    back = edges.select(F.col("nbr").alias("at"), F.col("node").alias("to"), "sim").withColumn("r", F.row_number().over(few)).where(F.col("r") <= WIDE)
    links = cut(edges.select(F.col("node").alias("at"), F.col("nbr").alias("to")).union(back.select("at", "to")).distinct())
    vectors, asked = unit_rows(df, key, embedding), cut(unit_rows(queries, key, embedding))
    names, sample = sample_vectors(df.select(key, embedding), key, embedding)
    at = choose_leaders(sample)[0]
    at = at[at >= 0]
    starts = spark.sparkContext.broadcast((names[at], sample[at]))  # at most SAMPLE vectors

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, leads = starts.value
        for b in batches:
            x = unpack(b.column(1))
            for at in range(0, len(x) if len(leads) else 0, 1024):
                row, col, _ = top_k(x[at : at + 1024] @ leads.T, names, entries)
                yield pa.record_batch(_edges(np.asarray(b.column(0))[at + row], names[col], exact(x[at + row], leads[col])), names=["node", "nbr", "sim"])

    order = W.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    held = cut(asked.mapInArrow(enter, EDGES).withColumn("fresh", F.lit(True)))
    for _ in range(hops):
        step = held.where("fresh").join(links, F.col("nbr") == F.col("at")).select("node", F.col("to").alias("nbr")).distinct().join(held.select("node", "nbr"), ["node", "nbr"], "left_anti")
        pairs = step.join(vectors.withColumnRenamed("key", "nbr"), "nbr").join(asked.select(F.col("key").alias("node"), F.col("vec").alias("q")), "node")
        scored = pairs.select("node", "nbr", "vec", "q").mapInArrow(_dot, EDGES).withColumn("fresh", F.lit(True))
        now = cut(held.withColumn("fresh", F.lit(False)).unionByName(scored).withColumn("r", F.row_number().over(order)).where(F.col("r") <= beam).drop("r"))
        discard(held)
        held = now
        if held.where("fresh").isEmpty():
            break
    return best(held.where("node <> nbr").select("node", "nbr", "sim"), k)
