"""What plans of larger tables must not contain."""

import re

from tessella.plans import analytics, coverage


def test_contours_are_not_broadcast(spark, data):
    """The join of all contours with all rectangles sends neither side to the driver, however small the engine takes the table of parts to be."""
    plan = coverage.rectangle_contours(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_polygons_are_not_broadcast(spark, data):
    """The pipeline's join of all polygons with all cells sends neither side to the driver, however small the packed table of masks is."""
    plan = analytics.pipeline_cells(spark, data)._jdf.queryExecution().executedPlan().toString()
    joins = re.findall(r"(\w+) \[slide_id#\d+, tile_name#\d+, label_id#\d+\], \[[^]]*\], (\w+)", plan)
    assert ("SortMergeJoin", "Inner") in joins and ("BroadcastHashJoin", "Inner") not in joins
