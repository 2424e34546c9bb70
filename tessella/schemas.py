"""Explicit schemas of the pipeline's files; nothing is inferred."""

from __future__ import annotations

CELL = "cell_id INT, label_id INT, polygon ARRAY<ARRAY<DOUBLE>>, pred_class STRING, cluster_id INT, cluster_confidence DOUBLE, bbox ARRAY<INT>"
BOX = "label_id INT, bbox ARRAY<INT>"
ASSIGNMENT = "bbox_file STRING, label_id INT, bbox ARRAY<INT>, cluster_id INT, confidence DOUBLE"
CLASSIFIED_CELL = "label_id INT, bbox ARRAY<INT>, bbox_file STRING, pred_class STRING, cluster_id INT, cluster_confidence DOUBLE"
TILE_STATS = "mean_intensity DOUBLE, std_intensity DOUBLE, bright_pixels_ratio DOUBLE, dark_pixels_ratio DOUBLE, edge_density DOUBLE, color_variance DOUBLE, laplacian_var DOUBLE, rejection_reasons ARRAY<STRING>"
STATUS = "stage STRING, slide_id STRING, status STRING, detail STRING"
CHECKPOINT = "slide_id STRING, result STRING"


def struct_of(ddl: str) -> str:
    """A DDL column list as a STRUCT type."""
    depth, parts, part = 0, [], ""
    for ch in ddl:
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            parts.append(part.strip())
            part = ""
        else:
            part += ch
    parts.append(part.strip())
    return "STRUCT<" + ", ".join(p.replace(" ", ": ", 1) for p in parts) + ">"


CLASSIFIED_TILE = f"tile_path STRING, tile_name STRING, slide_id STRING, classified_cells ARRAY<{struct_of(CLASSIFIED_CELL)}>"
ANNOTATED_TILE = f"tile_path STRING, magnification DOUBLE, x INT, y INT, cells ARRAY<{struct_of(CELL)}>"
LABEL_FILE = f"batch INT, tiles ARRAY<STRUCT<slide_id: STRING, tile_name: STRING, tile_path: STRING, magnification: DOUBLE, x: INT, y: INT, cells: ARRAY<{struct_of(CELL)}>>>"
HUMAN_LABELS = "timestamp STRING, batch STRING, source_dir STRING, tiles ARRAY<STRUCT<tile_index: INT, slide_id: STRING, tile_name: STRING, total_cells: INT, labelled_cells: ARRAY<STRUCT<cell_id: INT, human_label: INT>>>>"
