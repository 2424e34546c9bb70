"""Neighbour graph and clusters against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tessella.llm import columns, grid_clusters, knn_graph
from tessella.llm.vectors import top_k

EMB = "cell_key long, slide_id string, embedding array<float>, vec binary, node long, grid long, home int"
SLIDES = "slide_id string, slide_name string, alt_slide_id string"


def make(seed=0, groups=12, each=15, noise=40):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(50)
        rows += [centre + rng.standard_normal(50) * 0.3 for _ in range(each)]
    rows += list(rng.standard_normal((noise, 50)))
    rows += [rows[0] + 0.01 * rng.standard_normal(50), rows[0] * 3.0, rows[0], rows[20]]
    return (np.array(rows) * rng.uniform(0.2, 9, (len(rows), 1))).astype(np.float32)


def frame(spark, x, slide=lambda i: "s" if i % 2 else " S/"):
    rows = [(i * 3 % 1009, slide(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, "s", None), (5001, "s", [1.0]), (5002, "s", [0.0] * 50), (5003, "s", [math.nan] * 50), (5004, "s", [math.inf] + [0.0] * 49), (5005, "s", [None] + [1.0] * 49), (None, "s", x[0].tolist()), rows[0]]
    return spark.createDataFrame([(*r, None, 1, 1, 1) for r in rows], EMB), {r[0]: np.array(r[2], np.float64) / np.linalg.norm(r[2]) for r in rows[: len(x)]}


def brute(vectors, k):
    keys = np.array(sorted(vectors))
    v = np.stack([vectors[i] for i in keys])
    s = np.round(v @ v.T, 9)
    np.fill_diagonal(s, -2)
    return keys, s, {int(i): [int(keys[j]) for j in sorted(range(len(keys)), key=lambda j: (-s[a, j], keys[j]))[:k]] for a, i in enumerate(keys)}


def test_graph(spark):
    df, vectors = frame(spark, make())
    keys, s, want = brute(vectors, 10)
    got = {}
    for r in knn_graph.knn_graph(df).collect():
        got.setdefault(r.node, []).append((r.rank, r.nbr))
    assert set(got) == set(want)
    assert np.mean([len({n for _, n in got[i]} & set(w)) / 10 for i, w in want.items()]) >= 0.97
    at = {int(i): a for a, i in enumerate(keys)}
    pairs = {(min(a, b), max(a, b)) for a, w in want.items() for b in w if s[at[a], at[b]] >= 0.98}
    assert {tuple(r) for r in knn_graph.near_pairs(df).collect()} == pairs
    assert knn_graph.near_pairs(df.where("false")).count() == 0
    assert knn_graph.near_pairs(df.where("cell_key >= 5000")).count() == 0
    assert knn_graph.knn_graph(df.where("cell_key IN (0, 3)")).count() == 2


def test_fixed_point():
    x = make()[:40] / np.linalg.norm(make()[:40], axis=1, keepdims=True)
    back = knn_graph.from_fixed(knn_graph.to_fixed(x))
    assert np.abs(back @ back.T - x @ x.T).max() < 5e-5


def test_rounds_find_what_blocks_miss(spark, monkeypatch):
    """Small blocks cut rows off from their neighbours; the rounds find them, whatever the similarity of the nearest."""
    monkeypatch.setattr(knn_graph, "BLOCK", 60)
    monkeypatch.setattr(knn_graph, "SPARSE", 60)
    df, vectors = frame(spark, make(seed=7, groups=40, each=12, noise=300))
    _, s, want = brute(vectors, 10)
    before, after = hits(knn_graph.knn_graph(df, rounds=0), want, want), hits(knn_graph.knn_graph(df), want, want)
    assert after >= 0.99 and after > before + 0.05
    rows = {r.band: r.recall for r in knn_graph.recall(df, every=2).collect()}
    assert rows["all"] >= 0.95 and min(rows.values()) >= 0.9
    asked = df.where("cell_key % 7 = 0")
    assert hits(knn_graph.graph_search(df, asked), want, [i for i in want if i % 7 == 0]) >= 0.9


def test_copies(spark):
    x = np.repeat(make()[:2], 100, axis=0)
    df, _ = frame(spark, x)
    got = {}
    for r in knn_graph.knn_graph(df, k=4).collect():
        got.setdefault(r.node, []).append(r.nbr)
    keys = sorted(i * 3 % 1009 for i in range(100))
    for i in keys:
        assert sorted(got[i]) == [j for j in keys if j != i][:4]


def test_blocks(spark):
    rng = np.random.default_rng(2)
    leaders = rng.standard_normal((40, 50)).astype(np.float32)
    blocks = knn_graph.group_leaders(leaders, np.ones(40), 8)
    assert blocks.max() >= 7 and np.bincount(blocks).max() <= 12
    x = make() / np.linalg.norm(make(), axis=1, keepdims=True)
    row, lead, weight = knn_graph.choose_leaders(x)
    assert np.allclose(x[row], lead) and len(lead) < 30 and weight.min() > 1


def test_top_k():
    rng = np.random.default_rng(3)
    s = np.round(rng.random((30, 700)), 2).astype(np.float32)
    s[0] = 0.5
    keys = rng.permutation(700)
    row, col, _ = top_k(s, keys, 7)
    for r in range(30):
        want = sorted(range(700), key=lambda j: (-s[r, j], keys[j]))[:7]
        assert col[row == r].tolist() == want


@pytest.mark.parametrize("block", [16384, 64])
def test_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(grid_clusters, "BLOCK", block)
    x = make(seed=4)
    slide = lambda i: ["s", " S/", "t", None, "nobody"][i % 5]
    df, vectors = frame(spark, x, slide)
    slides = spark.createDataFrame([("S", "s name", "s"), ("T", "t name", "t")], SLIDES)
    of = {i * 3 % 1009: {"s": "S", " S/": "S", "t": "T"}.get(slide(i)) for i in range(len(x))}
    want = set()
    for name in ("S", "T"):
        keys = sorted(k for k in vectors if of[k] == name)
        v = np.stack([vectors[k] for k in keys])
        near = v @ v.T >= 0.8
        left = set(range(len(keys)))
        while left:
            group, todo = set(), [min(left)]
            while todo:
                i = todo.pop()
                if i not in group:
                    group.add(i)
                    todo += np.flatnonzero(near[i]).tolist()
            left -= group
            if len(group) >= 5:
                want |= {(keys[i], min(keys[j] for j in group)) for i in group}
    got = grid_clusters.clusters(df, slides).collect()
    assert {(r.cell_key, r.first_key) for r in got} == want and len(want) > 50
    assert len(got) == len(want)
    assert grid_clusters.clusters(df.where("false"), slides).count() == 0
    assert grid_clusters.clusters(df, slides.where("false")).count() == 0


def test_chain_of_links(spark):
    step = math.acos(0.81)
    x = np.zeros((9, 50), np.float32)
    for i in range(9):
        x[i, :2] = math.cos(i * step), math.sin(i * step)
    df = spark.createDataFrame([(100 - i, "S", v.tolist(), None, 1, 1, 1) for i, v in enumerate(x)], EMB)
    slides = spark.createDataFrame([("S", "s", "s")], SLIDES)
    assert {(r.cell_key, r.first_key) for r in grid_clusters.clusters(df, slides).collect()} == {(100 - i, 92) for i in range(9)}


def test_mass_copies_and_crowds(spark, monkeypatch):
    """A third of all rows is one vector, another third one crowd; both beyond the size of a unit."""
    monkeypatch.setattr(knn_graph, "UNIT", 60)
    rng = np.random.default_rng(6)
    x = make(seed=5, groups=6, each=10, noise=0)[:60]
    centre = rng.standard_normal(50)
    crowd = np.stack([centre + 0.2 * rng.standard_normal(50) for _ in range(120)]).astype(np.float32)
    df, vectors = frame(spark, np.concatenate([x, np.repeat(x[:1], 120, axis=0), crowd]))
    keys, s, want = brute(vectors, 5)
    got = {}
    for r in knn_graph.knn_graph(df, k=5).collect():
        got.setdefault(r.node, []).append(r.nbr)
    assert set(got) == set(want)
    copies = [i * 3 % 1009 for i in [0, *range(60, 180)]]
    assert all(sorted(got[i]) == sorted(want[i]) for i in copies)
    assert np.mean([len(set(got[i]) & set(w)) / 5 for i, w in want.items()]) >= 0.9


def hits(graph, want, x_keys):
    got = {}
    for r in graph.collect():
        got.setdefault(r.node, set()).add(r.nbr)
    return np.mean([len(got.get(i, set()) & set(want[i])) / len(want[i]) for i in x_keys])


def test_crowd_rows_meet_all_parts(spark, monkeypatch):
    """One crowd without structure: its rows' neighbours lie in all of its parts, in two halls and exactly."""
    monkeypatch.setattr(knn_graph, "UNIT", 60)
    monkeypatch.setattr(knn_graph, "BLOCK", 30)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(50)
    crowd = np.stack([centre + 0.1 * rng.standard_normal(50) for _ in range(900)]).astype(np.float32)
    rows = [(i, "s", v.tolist(), None, 1, 1, 1) for i, v in enumerate(np.concatenate([make(seed=5, groups=3, each=10, noise=10), crowd]))]
    df = spark.createDataFrame(rows, EMB)
    _, s, want = brute({r[0]: np.array(r[2], np.float64) / np.linalg.norm(r[2]) for r in rows}, 10)
    keys = range(len(rows) - 900, len(rows))
    assert hits(knn_graph.knn_graph(df), want, keys) == 1
    pairs = {(min(a, b), max(a, b)) for a, w in want.items() for b in w if s[a, b] >= 0.98}
    assert len(pairs) > 4000 and {tuple(r) for r in knn_graph.near_pairs(df).collect()} == pairs


def test_broad_cluster_over_several_leaders(spark, monkeypatch):
    """A plane full of rows that many leaders cover: near rows on either side of a border meet."""
    monkeypatch.setattr(knn_graph, "BLOCK", 60)
    rng = np.random.default_rng(9)
    angle = np.stack([rng.uniform(-1.4, 1.4, 1500), rng.uniform(-1.4, 1.4, 1500)])
    x = np.zeros((1500, 50), np.float32)
    x[:, 0], x[:, 1], x[:, 2] = np.cos(angle[0]) * np.cos(angle[1]), np.sin(angle[0]) * np.cos(angle[1]), np.sin(angle[1])
    df = spark.createDataFrame([(i, "s", v.tolist(), None, 1, 1, 1) for i, v in enumerate(x)], EMB)
    _, s, want = brute({i: v.astype(np.float64) / np.linalg.norm(v.astype(np.float64)) for i, v in enumerate(x)}, 10)
    pairs = {(min(a, b), max(a, b)) for a, w in want.items() for b in w if s[a, b] >= 0.98}
    assert {tuple(r) for r in knn_graph.near_pairs(df).collect()} == pairs


def test_orders_of_candidates():
    """The nearest of each row and of each list in the plain definition's order: equal similarities by key."""
    rng = np.random.default_rng(5)
    for turn in range(20):
        s = np.round(rng.uniform(-1, 1, (9, 200)), 1 + turn % 2 * 5).astype(np.float32)
        keys = rng.permutation(10**6)[:200]
        row, col, val = top_k(s, keys, 7)
        want = [(i, j) for i in range(9) for j in np.lexsort((keys, -np.round(s[i].astype(np.float64), 7)))[:7].tolist()]
        assert list(zip(row.tolist(), col.tolist())) == want and (val == s[row, col]).all()
    x = np.eye(6, dtype=np.float32)[[0, 0, 1, 0]]
    names, bound = np.array([40, 10, 20, 30]), np.full(4, 0.5, np.float32)
    at, pos = np.repeat([0, 1], [4, 2]), np.array([0, 1, 2, 3, 0, 1])
    a, b, sim = knn_graph._local_join(at, pos, np.ones(6, bool), x, names, bound, 5)
    assert list(zip(a.tolist(), names[b].tolist())) == [(0, 10), (0, 30), (1, 30), (1, 40), (3, 10), (3, 40)] and (sim == 1).all()
    assert not len(knn_graph._local_join(at, pos, np.ones(6, bool), x, names, bound + 1, 5)[0])


def test_columns_are_packed_in_few_bytes_without_loss():
    rng = np.random.default_rng(1)
    cols = {
        "node": rng.integers(0, 10**6, 5000),
        "wide": rng.integers(-(2**62), 2**62, 5000),
        "home": rng.integers(0, 90, 5000).astype(np.int32),
        "sim": np.round(rng.uniform(-1, 1, 5000), 9),
        "fresh": rng.random(5000) < 0.5,
        "vec": rng.integers(-(2**15), 2**15, (70, 52)).astype(np.int16),
        "none": np.empty(0, np.int64),
    }
    body = columns.encode(cols)
    back = columns.decode(memoryview(body))
    assert list(back) == list(cols) and all(back[c].dtype == v.dtype and back[c].shape == v.shape and (back[c] == v).all() for c, v in cols.items())
    assert list(columns.decode(body, ("sim", "vec"))) == ["sim", "vec"]
    assert len(columns.encode({"sim": cols["sim"]})) < 5000 * 4.2  # 33 kB in double precision


def placed(x, tasks=7):
    keys = np.arange(len(x))
    at, leaders, weights = knn_graph.choose_leaders(x)
    plan = knn_graph.plan_blocks(x, keys[at], leaders, weights, len(x), -1.0, 3)
    batch = pa.record_batch([pa.array(keys), pa.array(x.tolist(), pa.list_(pa.float32()))], names=["key", "embedding"])
    return list(knn_graph.place(iter([batch]), plan, tasks))


def test_a_batch_is_sent_in_one_row_for_each_task():
    x = np.concatenate([make(seed=s) for s in range(24)])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = placed(x)
    assert len(x) > 2 * 2048 and len(rows) <= 7
    sent = [columns.decode(r.column("body")[0].as_buffer()) for r in rows]
    home = np.concatenate([s["key"][~s["guest"] & (s["block"] >= 0)] for s in sent])
    assert sorted(home.tolist()) == list(range(len(x)))
    assert all(np.allclose(s["vec"], x[s["key"]], atol=1e-6) for s in sent)


def test_fresh_entries_meet_their_list():
    """Every pair of one list with a fresh entry, in either direction, against the plain definition."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 50)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    bound = rng.uniform(-0.3, 0.1, 300).astype(np.float32)
    lists = [rng.choice(300, n, replace=False) for n in rng.integers(1, 60, 80)]
    flags = [rng.random(len(v)) < rng.choice([0.05, 0.5, 1]) for v in lists]
    at = np.repeat(np.arange(80), [len(v) for v in lists])
    want = {(a, b) for v, f in zip(lists, flags) for i, a in enumerate(v.tolist()) for j, b in enumerate(v.tolist()) if i != j and (f[i] or f[j]) and x[a] @ x[b] > bound[a]}
    a, b, s = knn_graph._local_join(at, np.concatenate(lists), np.concatenate(flags), x, np.arange(300), bound, 10**6)
    assert set(zip(a.tolist(), b.tolist())) == want and len(a) == len(want) > 5000
    assert np.abs(s - np.einsum("ij,ij->i", x[a], x[b])).max() < 1e-5
    none = knn_graph._local_join(at, np.concatenate(lists), np.zeros(len(at), bool), x, np.arange(300), bound, 9)
    assert [len(v) for v in none] == [0, 0, 0]
