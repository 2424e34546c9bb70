import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import packing

DOCS = "doc_id long, text string, size string, cls string, shard int, piece int, container string, ord long, start string"


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 6), st.integers(3, 20))
def test_nnls_is_optimal(seed, n, m):
    rng = np.random.default_rng(seed)
    a, b = rng.random((m, n)), rng.random(m)
    x = packing.nnls(a, b)
    g = a.T @ (b - a @ x)
    assert (x >= 0).all() and (g <= 1e-6).all() and abs(g[x > 0]).max(initial=0) <= 1e-6


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=16, max_size=16))
def test_plan_places_every_item_once_within_capacity(histogram):
    h = np.array(histogram)
    segments, n = packing.plan_containers(h)
    load, seen = np.zeros(n, int), [set() for _ in h]
    for s in segments:
        for o in range(s.start, s.stop):
            assert o not in seen[s.cls - 1]
            seen[s.cls - 1].add(o)
            load[s.base + (o - s.start) // s.per] += s.cls
    assert [len(v) for v in seen] == histogram
    assert (load <= 16).all() and (load > 0).all()


def test_documents(spark):
    sizes = [0, 1, 8191, 8192, 8193, 30000, None, 100, 5000, 3100, 3100]
    rows = [(i, None if s is None else "é" * (s // 2) + "x" * (s % 2), "c", "c", 1, 1, "c", 1, "c") for i, s in enumerate(sizes)]
    docs = spark.createDataFrame(rows, DOCS)
    packed = packing.pack(docs).collect()
    parts = {}
    for r in packed:
        parts.setdefault(r.doc_id, []).append((r.piece, r.piece_size))
    assert sorted(parts) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert {d: sum(p for _, p in v) for d, v in parts.items()} == {i: s for i, s in enumerate(sizes) if s is not None}
    assert sorted(parts[5]) == [(0, 8192), (1, 8192), (2, 8192), (3, 30000 - 3 * 8192)]
    load = {}
    for r in packed:
        load[r.container] = load.get(r.container, 0) + r.piece_size
    assert max(load.values()) <= 8192
    assert {r.doc_id for r in packing.split_documents(docs).collect()} == {4, 5}
    assert packing.pack(docs.where("false")).count() == 0
    assert packing.fill_report(docs.where("false")).first().containers == 0


def test_little_room_is_lost(spark, data):
    r = packing.fill_report(spark.read.parquet(f"{data}/documents.parquet")).first()
    assert r.largest <= 8192
    assert r.containers <= r.least_containers * 1.1 + 1


def test_repeats(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('a', 4000) AS text")
    r = packing.fill_report(docs).first()
    assert r.containers == 2000 and r.fill == pytest.approx(8000 / 8192)
