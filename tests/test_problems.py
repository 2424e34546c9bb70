"""The core problems on small tables with every kind of dirt."""

import json

import pytest

from pyspark.sql import functions as F

from tessella.operators import compaction, dewey
from tessella.operators.components import minimum_labels
from tessella.operators.eager_aggregate import slide_join_totals, slide_record_counts, slides_with_share
from tessella.sources.journal import CompactedStore

RESULT = "record_id long, slide_id string, n_records int"
SLIDES = "slide_id string, slide_name string, alt_slide_id string, key_hash long, slide_key string"
BOX = "file_id long, bbox_file string, slide_id string, label_id int, bbox array<int>, n_bytes int, tile string, container string"


def slides(spark):
    return spark.createDataFrame([("A_1", "Größe A%", "A_2", 1, "x"), ("B_1", "B", "B_1", 1, "x"), (None, "C", None, 1, "x")], SLIDES)


def test_records_of_slides(spark):
    rows = [(1, " A_1 "), (1, "GRÖSSE a%/"), (2, "a_2"), (3, "B"), (4, None), (None, "B"), (5, "unknown"), (3, "b_1")]
    facts = spark.createDataFrame([(r, s, 7) for r, s in rows], RESULT)
    got = {r.slide_id: (r.n_records, r.total_records) for r in slide_record_counts(facts, slides(spark)).collect()}
    assert got == {"A_1": (2, 5), "B_1": (1, 5)}
    assert {r.slide_id for r in slides_with_share(facts, slides(spark), 40).collect()} == {"A_1"}
    none = facts.where("false")
    assert slides_with_share(none, slides(spark)).count() == 0
    assert slide_record_counts(facts, slides(spark).where("false")).count() == 0


def test_join_totals_equal_the_join(spark):
    facts = spark.createDataFrame([(i, "A_1" if i % 3 else "B", 0) for i in range(30)], RESULT)
    boxes = spark.createDataFrame([(i, "p", "a_2" if i % 2 else "b", 1, [0, 0, i, 2] if i % 4 else None, None, "t", "c") for i in range(1, 21)], BOX)
    got = {r.slide_id: (r.n_pairs, r.pair_area) for r in slide_join_totals(facts, boxes, slides(spark)).collect()}
    area = {"A_1": sum(2 * i for i in range(1, 21) if i % 2 and i % 4), "B_1": sum(2 * i for i in range(1, 21) if not i % 2 and i % 4)}
    assert got == {"A_1": (20 * 10, 20 * area["A_1"]), "B_1": (10 * 10, 10 * area["B_1"])}


def boxes(spark):
    rows = []
    for f, tile, content in (
        (1, "/a/t1_bboxes.json", [(1, [0, 0, 1, 1]), (2, None)]),
        (2, "D:\\x\\t1_bboxes (2).json", [(2, None), (1, [0, 0, 1, 1]), (1, [0, 0, 1, 1])]),
        (3, "/b/t1_bboxes.JSON", [(1, [0, 0, 1, 1])]),
        (4, "/b/t2_bboxes.json", [(1, [0, 0, 1, 1])]),
        (5, None, [(1, [0, 0, 1, 1])]),
        (6, "/b/nothing.json", [(1, [0, 0, 1, 1])]),
        (None, "/a/t1_bboxes.json", [(9, [1, 2, 3])]),
        (7, "/c/t2_bboxes_1.json", [(None, [1, 2, 3])]),
    ):
        rows += [(f, tile, "s", lab, box, None if f == 3 else 100, "clash", "clash") for lab, box in content]
    return spark.createDataFrame(rows, BOX)


def test_compaction(spark):
    journal, out = compaction.compact_small_files(boxes(spark))
    got = {(r.tile, r.label_id, tuple(r.bbox or ())): r.n_files for r in compaction.compact(out).collect()}
    assert got == {("t1", 1, (0, 0, 1, 1)): 3, ("t1", 2, ()): 2, ("t2", 1, (0, 0, 1, 1)): 1, ("t2", None, (1, 2, 3)): 1}
    assert sorted(r.file_id for r in out.where("tile = 't1' AND label_id = 1").collect()) == [1, 2, 3]
    assert [tuple(r) for r in compaction.same_content_pairs(out).collect()] == [(1, 2)]
    assert journal.agg(F.max("level")).first()[0] >= 1
    again = compaction.compact_small_files(boxes(spark))[0]
    assert sorted(map(tuple, journal.collect())) == sorted(map(tuple, again.collect()))
    empty = compaction.compact_small_files(boxes(spark).where("false"))
    assert empty[0].count() == 0 and empty[1].count() == 0


def test_levels_merge_until_few_files_are_left(spark):
    files = spark.range(1000).select(F.concat(F.lit("F"), "id").alias("node"), F.lit(300).cast("long").alias("bytes"), F.lit(8).cast("long").alias("rows"), F.lit(0).alias("bucket"))
    journal, placement = compaction.plan(files, base=1024, fan_in=10, target=200_000)
    assert placement.count() == 1000
    containers = placement.join(files, "node").groupBy("container").agg(F.sum("bytes").alias("b")).collect()
    assert len(containers) <= 4
    rows = journal.collect()
    assert {r.level for r in rows} >= {1, 2, 3}
    inputs = [r.input for r in rows]
    assert len(inputs) == len(set(inputs)) and {r.txn_id for r in rows} - set(inputs) == {c.container for c in containers}
    made = {t.txn_id: (t.bytes, t.rows) for t in compaction.transactions(journal).collect()}
    assert all(made[r.input] == (r.bytes, r.rows) for r in rows if r.input in made)


def test_store_is_idempotent(spark, tmp_path):
    store = CompactedStore(spark, f"file://{tmp_path}")
    first = boxes(spark).where("file_id <= 3")
    assert store.ingest(first)["files"] == 3
    assert store.ingest(first)["files"] == 0
    assert store.ingest(boxes(spark))["files"] == 2
    got = {(r.tile, r.label_id, tuple(r.bbox or ())): r.n_files for r in store.boxes().collect()}
    assert got[("t1", 1, (0, 0, 1, 1))] == 3 and len(got) == 4


def test_many_small_ingests_leave_few_containers(spark, tmp_path):
    """Files come one at a time: their containers are merged again and again, so their number grows with the logarithm."""
    store = CompactedStore(spark, f"file://{tmp_path}")
    schema = "file_id long, bbox_file string, label_id int, bbox array<int>, n_bytes int"
    one = lambda i: spark.createDataFrame([(i, f"/a/t{i % 5}_bboxes_{i}.json", i % 3, [0, 0, 1, 1], 700)], schema)
    for i in range(20):
        assert store.ingest(one(i), fan_in=3)["files"] == 1
    assert store.containers().count() <= 6  # 20 is 202 in base 3, with room for containers of one file that share a tier
    kept = {(r.tile, r.label_id): r.n_files for r in store.boxes().collect()}
    assert sum(kept.values()) == 20 and len(kept) == 15
    store.vacuum()
    data = [p for p in (tmp_path / "data").rglob("*.parquet") if spark.read.parquet(str(p)).count()]
    assert len(data) <= 8
    assert {(r.tile, r.label_id): r.n_files for r in store.boxes().collect()} == kept
    assert store.journal().groupBy("input").count().where("count > 1").count() == 0


def test_killed_run_is_repeated(spark, tmp_path, monkeypatch):
    """A run that dies before its commit leaves nothing that counts, and its repetition writes the same names."""
    store = CompactedStore(spark, f"file://{tmp_path}")
    store.ingest(boxes(spark).where("file_id <= 2"))
    monkeypatch.setattr(CompactedStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        store.ingest(boxes(spark), least=2)
    monkeypatch.undo()
    assert len(store.runs()) == 1 and len(store._names("data")) == 2
    before = set(store._names("data"))
    assert store.ingest(boxes(spark), least=2)["files"] == 3 and set(store._names("data")) == before
    got = {(r.tile, r.label_id, tuple(r.bbox or ())): r.n_files for r in store.boxes().collect()}
    assert got[("t1", 1, (0, 0, 1, 1))] == 3 and len(got) == 4


TILE = "slide_id string, tile_name string, tile_path string, magnification double, x int, y int, cells array<struct<cell_id:int,label_id:int,polygon:array<array<double>>,pred_class:string,cluster_id:int,cluster_confidence:double,bbox:array<int>>>"
FILES = f"label_file_id long, batch int, exported_at timestamp, tiles array<struct<{TILE.replace(' string', ':string').replace('magnification double', 'magnification:double').replace('x int', 'x:int').replace('y int', 'y:int').replace('cells array', 'cells:array')}>>, payload string, node string, parent string"


def label_files(spark):
    def cell(poly, box, cid=None):
        return (cid, 1, poly, None, None, None, box)

    def tile(cells):
        return ("s", "t", None, 1.0, 0, 0, cells)

    typed = [tile(None), tile([None, cell([[5.0, 5.0], [11.0, 5.0]], [0, 0, 10, 10])]), None, tile([cell([[10.5, 5.0], [1.0], [99.0, 99.0, 9.0], []], [0, 0, 10, 10]), cell(None, None), cell([[50.0, 50.0]], [0, 0, 10])])]
    text = json.dumps(
        {
            "batch": 3,
            "tiles": [
                {"cells": [{"polygon": [{"x": "20.5", "y": 1, "z": 0}, None, [1]], "bbox": {"xmin": "0", "ymin": 0, "xmax": 10, "ymax": 10}, "note": {"a": [1]}}]},
                {"slide_id": "s", "cells": []},
                {},
            ],
        }
    )
    rows = [(1, 1, None, typed, None, "n", "p"), (2, None, None, None, text, "n", "p"), (2, None, None, None, text[:-9], "n", "p"), (3, None, None, None, text[:-5], "n", "p"), (4, None, None, None, None, "n", "p"), (5, None, None, [], "", "n", "p"), (None, 1, None, typed, None, "n", "p")]
    return spark.createDataFrame(rows, FILES)


def test_nested_files(spark):
    f = label_files(spark)
    got = {tuple(r) for r in dewey.cells_outside_their_box(f).collect()}
    assert got == {(1, 1, 1), (2, 0, 0)}
    flat = dewey.flatten(f)
    assert {r.node for r in flat["files"].collect()} == {"1", "2", "3", "4", "5"}
    assert {r.node for r in flat["tiles"].collect()} == {"1.0", "1.1", "1.2", "1.3", "2.0", "2.1", "2.2"}
    cells = {r.node: r for r in flat["cells"].collect()}
    assert set(cells) == {"1.1.0", "1.1.1", "1.3.0", "1.3.1", "1.3.2", "2.0.0"}
    assert cells["2.0.0"].bbox == [0, 0, 10, 10] and cells["2.0.0"].parent == "2.0"
    vertices = {r.node: (r.parent, r.n_numbers, r.x) for r in flat["vertices"].collect()}
    assert vertices["2.0.0.0"] == ("2.0.0", 2, 20.5)
    assert vertices["1.3.0.2"][1] == 3 and vertices["1.3.0.3"][1] == 0
    assert dewey.cells_outside_their_box(f.where("false")).count() == 0


def test_minimum_labels(spark):
    n = 70
    edges = [(i, i + 1) for i in range(n - 1) if i != 40] + [(5, 5), (3, 2)]
    e = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.label for r in minimum_labels(spark.range(n + 1).withColumnRenamed("id", "node"), e).collect()}
    assert got == {i: (0 if i <= 40 else 41 if i < n else n) for i in range(n + 1)}
    assert minimum_labels(spark.range(2).withColumnRenamed("id", "node"), e.where("false")).count() == 2


def test_tables_by_schema_path(spark):
    """Any tree becomes tables found from its paths; unknown fields are kept, every node leads to its parent."""
    docs = [
        (1, '[{"slide_id": "s", "extra": {"note": "x", "deep": [1, null]}, "cells": [{"cell_id": 5, "odd": true}, null, {"cell_id": "6"}]}, {"cells": []}]'),
        (2, "[]"),
        (3, None),
    ]
    trees = spark.createDataFrame(docs, "label_file_id long, j string").select("label_file_id", F.try_parse_json("j").alias("tree"))
    rows = dewey.schema_nodes(trees).collect()
    by = {r.node: r for r in rows}
    assert len(by) == len(rows)
    assert all(r.parent in by or r.parent == str(r.root) for r in rows)
    assert all(r.node.rsplit(".", 1)[0] == r.parent for r in rows)
    assert {r.path for r in rows} >= {"$", "$[]", "$[].extra.deep[]", "$[].cells[].odd"}
    tables = dewey.schema_tables(dewey.schema_nodes(trees))
    cells = sorted((r.pos, r.cell_id, r.odd) for r in tables["$[].cells[]"].collect())
    assert cells == [(0, "5", "true"), (1, None, None), (2, "6", None)]
    tiles = {r.node for r in tables["$[]"].collect()}
    assert {r.parent for r in tables["$[].cells[]"].collect()} <= tiles and len(tiles) == 2
    assert tables["$[].extra"].first().note == "x"
    assert dewey.schema_nodes(trees.where("false")).count() == 0
