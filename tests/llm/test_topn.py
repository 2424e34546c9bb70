import math
import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import topn

CELL = "label_id:int,bbox:array<int>,bbox_file:string,pred_class:string,cluster_id:int,cluster_confidence:double"
RESULT = f"record_id long, slide_id string, classified_cells array<struct<{CELL}>>, key_hash long, confidence double, cluster_id string"
SLIDES = "slide_id string, slide_name string, alt_slide_id string, cluster_id int"


def cell(label, cluster, conf):
    return (label, None, None, None, cluster, conf)


def test_cells(spark):
    slides = spark.createDataFrame([("A", "a x", "A2", 1), ("B", "b", "B", 2)], SLIDES)
    cells = [cell(i, 0, 0.5) for i in range(9, 0, -1)] + [cell(20, 0, math.nan), cell(21, 0, None), cell(22, 1, math.nan), None, cell(None, 0, 1.0), cell(1, -1, 1.0), cell(2, None, 1.0), cell(30, 0, 0.9), cell(30, 0, 0.9)]
    rows = [(1, "a x/", cells), (1, " A2", cells[::-1]), (2, None, cells), (3, "nobody", cells), (None, "A", cells), (4, "b", None), (5, "b", []), (0, "A", [cell(7, 0, 0.5)])]
    df = spark.createDataFrame([(*r, 1, 1.0, "x") for r in rows], RESULT)
    got = [tuple(r) for r in topn.top_cells(df, slides, 5).select("slide_id", "cluster_id", "record_id", "label_id").collect()]
    assert sorted(got) == sorted([("A", 0, 1, 30), ("A", 0, 0, 7), ("A", 0, 1, 1), ("A", 0, 1, 2), ("A", 0, 1, 3), ("A", 1, 1, 22)])
    assert topn.top_cells(df.where("false"), slides).count() == 0
    assert topn.top_cells(df, slides, 0).count() == 0
    assert topn.top_cells(df, slides.where("false")).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 9)), max_size=80), st.integers(1, 4), st.integers(1, 20))
def test_streaming_equals_sorting(rows, n, size):
    def batches(data):
        for i in range(0, len(data), size):
            part = data[i : i + size]
            yield pa.record_batch([pa.array([r[0] for r in part]), pa.array([float(r[1]) for r in part]), pa.array([r[2] for r in part])], names=["g", "s", "i"])

    def unroll(stream):
        return [tuple(r.values()) for b in stream for r in b.to_pylist()]

    few = unroll(topn.combine(batches(rows), ["g"], "s", ["i"], n))
    few.sort(key=lambda r: (r[0], -r[1], r[2]))
    got = unroll(topn.emit(batches(few), ["g"], ["i"], n))
    want = []
    for g in {r[0] for r in rows}:
        best = {}
        for r in rows:
            if r[0] == g:
                best[r[2]] = max(best.get(r[2], -1), r[1])
        want += [(g, float(s), i) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:n]]
    assert sorted(got) == sorted(want)


def test_hot_group(spark):
    rows = [(1 if random.Random(i).random() < 0.7 else i % 50, float(i % 13), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g long, s double, i long").repartition(7)
    got = {tuple(r) for r in topn.top_n(df, ["g"], "s", ["i"], 3).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        want |= set(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:3])
    assert got == want
