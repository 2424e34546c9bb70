"""The library's functions under SQL names, for queries written as text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..kernels.raster import longest_contour, read_png, tile_statistics

SQL_FUNCTIONS = {
    "tess_slide_id": ("name STRING", "replace(concat(trim(substring(regexp_replace(replace(name, '%', '_pct_'), '[^\\\\p{L}\\\\p{N} _-]', ''), 1, 20)), '_', substring(md5(replace(name, '%', '_pct_')), 1, 8)), ' ', '_')"),
    "tess_confidence": ("distance DOUBLE", "1 / (1 + distance)"),
    "tess_cosine": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, v) -> s + v) / sqrt(aggregate(a, 0D, (s, v) -> s + v * v) * aggregate(b, 0D, (s, v) -> s + v * v))"),
    "tess_croppable": ("box ARRAY<INT>", "box[0] < box[2] AND box[1] < box[3]"),
}
STATS = "mean_intensity double, std_intensity double, bright_pixels_ratio double, dark_pixels_ratio double, edge_density double, color_variance double, laplacian_var double"


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to ``spark.sql`` for the session: expressions as SQL functions, kernels on Arrow batches. Returns their names."""
    for name, (args, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURN {body}")

    @F.pandas_udf(STATS)
    def image_statistics(content: pd.Series) -> pd.DataFrame:
        names = [p.split()[0] for p in STATS.split(", ")]
        rows = []
        for data in content:
            try:
                rows.append(tile_statistics(read_png(bytes(data))))
            except (ValueError, TypeError):
                rows.append(dict.fromkeys(names, np.nan))
        return pd.DataFrame(rows, columns=names)

    @F.pandas_udf("array<array<double>>")
    def contour(labels: pd.Series, width: pd.Series, label: pd.Series) -> pd.Series:
        out = []
        for v, w, lab in zip(labels, width, label):
            line = longest_contour(np.asarray(v).reshape(-1, int(w)) == lab)
            out.append([list(map(float, p)) for p in line] if line else None)
        return pd.Series(out)

    spark.udf.register("tess_image_statistics", image_statistics)
    spark.udf.register("tess_contour", contour)
    return [*SQL_FUNCTIONS, "tess_image_statistics", "tess_contour"]
