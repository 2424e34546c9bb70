"""Density clustering of embeddings per slide, as published: k-distances, radius, DBSCAN, confidence.

Links come from pairs of blocks, spread over tasks: exact copies of a vector are compared once, and for distances that no
coordinate difference exceeds only rows of neighbouring grid cells meet. Core components come from label propagation. Only the
choice of a radius looks at a whole slide at once, at one number a row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..kernels.assign import distances, radius_of
from ..session import cut
from .components import minimum_labels


def l2_normalised(vector: F.Column) -> F.Column:
    """A vector of doubles divided by its length; a zero vector stays as it is."""
    v = vector.cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: x / F.when(length == 0, F.lit(1.0)).otherwise(length))


def distance(a: F.Column, b: F.Column) -> F.Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


GRID_AXES = 2
HALF = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))


def pair_blocks(points: DataFrame, group: list[str], key: str, columns: list[str], block: int = 2048) -> DataFrame:
    """Rows ``group, lo, hi, blk, columns``: every pair of blocks of a group meets in one ``(group, lo, hi)``.

    Blocks hold about ``block`` rows by hash of the key, so any two rows of a group meet exactly once.
    """
    counts = points.groupBy(*group).agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block)).cast("int").alias("blocks"))
    rows = points.join(counts, group).withColumn("blk", F.pmod(F.xxhash64(key), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(*group, F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"), "blk", *columns)


def in_grid(points: DataFrame, vector: str, metric: str) -> DataFrame:
    """Adds ``cx, cy, guest``: each row in its own cell of a grid of step ``eps`` over the first coordinates, and as a guest in half of the
    neighbouring ones, so that any two rows within ``eps`` are in one cell exactly once with at most one of them a guest.

    A cosine distance is no bound on coordinates: all rows share one cell.
    """
    if metric == "cosine":
        return points.withColumns({"cx": F.lit(0).cast("long"), "cy": F.lit(0).cast("long"), "guest": F.lit(False)})
    at = [F.floor(F.coalesce(F.try_element_at(vector, F.lit(i + 1)), F.lit(0.0)) / F.greatest("eps", F.lit(1e-12))) for i in range(GRID_AXES)]
    step = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in HALF])).alias("step")
    moved = points.select("*", at[0].alias("__x"), at[1].alias("__y"), step)
    out = moved.withColumns({"cx": F.col("__x") + F.col("step.x"), "cy": F.col("__y") + F.col("step.y"), "guest": (F.col("step.x") != 0) | (F.col("step.y") != 0)})
    return out.drop("__x", "__y", "step")


def range_edges(points: DataFrame, group: str, key: str, vector: str, eps: float | DataFrame, metric: str = "euclidean") -> DataFrame:
    """``(group, a, b, dist)`` with both directions and a row's pair with itself, for distances up to ``eps``.

    ``eps`` is a number, or a table ``(group, eps)``; groups that it lacks have no edges.
    """
    kinds = dict(points.dtypes)
    rows = points.select(group, key, vector)
    rows = rows.join(eps, group) if isinstance(eps, DataFrame) else rows.withColumn("eps", F.lit(float(eps)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        left, right = pdf[pdf["blk"] == lo], pdf[pdf["blk"] == hi]
        out = []
        if len(left) and len(right) and not pdf["guest"].all():
            x, y = np.stack(left[vector].to_numpy()), np.stack(right[vector].to_numpy())
            a, b = left[key].to_numpy(), right[key].to_numpy()
            ga, gb = left["guest"].to_numpy(), right["guest"].to_numpy()
            for at in range(0, len(x), 1000):
                d = distances(x[at : at + 1000], y, metric)
                if metric == "euclidean":
                    d[a[at : at + 1000][:, None] == b[None, :]] = 0.0
                r, c = np.nonzero((d <= pdf["eps"].iloc[0]) & ~(ga[at : at + 1000][:, None] & gb[None, :]))
                out.append((a[at + r], b[c], d[r, c]))
                if lo != hi:
                    out.append((b[c], a[at + r], d[r, c]))
        if not out:
            none = pdf.head(0)
            return pd.DataFrame({group: none[group], "a": none[key], "b": none[key], "dist": np.empty(0)})
        a, b, d = (np.concatenate(v) for v in zip(*out))
        return pd.DataFrame({group: [pdf[group].iloc[0]] * len(a), "a": a, "b": b, "dist": d})

    cells = [group, "cx", "cy"]
    rows = pair_blocks(in_grid(rows, vector, metric), cells, key, [key, vector, "guest", "eps"])
    return rows.groupBy(*cells, "lo", "hi").applyInPandas(run, f"{group} {kinds[group]}, a {kinds[key]}, b {kinds[key]}, dist double")


def density_labels(points: DataFrame, edges: DataFrame, group: str, key: str, least: int, weight: str | None = None) -> DataFrame:
    """``(group, key, cluster_id)``: core rows have ``least`` neighbours (themselves counted); core components are
    clusters, numbered within the group by their smallest core key; other rows take the smallest adjacent cluster or -1.

    Keys are unique over all groups. ``weight`` names a column that says for how many equal rows a row stands.
    """
    heavy = edges if weight is None else edges.join(points.select(F.col(key).alias("b"), F.col(weight).alias("__w")), "b")
    core = heavy.groupBy("a").agg(F.sum(F.lit(1) if weight is None else F.col("__w")).alias("n")).where(F.col("n") >= least).select("a")
    core_edges = edges.join(core, "a").join(core.withColumnRenamed("a", "b"), "b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    labels = minimum_labels(core.select(F.col("a").alias("node")), core_edges)
    placed = points.select(group, key).join(labels, F.col(key) == F.col("node")).select(group, F.col(key).alias("node"), "label")
    number = placed.select(group, "label").distinct().withColumn("cluster_id", F.row_number().over(W.partitionBy(group).orderBy("label")) - 1)
    cores = placed.join(number, [group, "label"]).select("node", "cluster_id")
    border = edges.join(cores, F.col("b") == F.col("node")).groupBy("a").agg(F.min("cluster_id").alias("cluster_id"))
    own = cores.select(F.col("node").alias("a"), F.col("cluster_id").alias("own"))
    out = border.join(own, "a", "full").select("a", F.coalesce("own", "cluster_id").alias("cluster_id"))
    return points.select(group, key).join(out, F.col(key) == F.col("a"), "left").select(group, key, F.coalesce("cluster_id", F.lit(-1)).cast("int").alias("cluster_id"))


def density_clusters(
    points: DataFrame, group: str, key: str, vector: str, least: int = 5, eps: float | None = None, normalise: bool = False, metric: str = "euclidean", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``(group, key, keep, cluster_id, confidence, eps)``: DBSCAN within each group, for groups of any size.

    Keys are unique over all groups. A group of fewer than ``least`` rows is all noise. ``eps`` None chooses the radius of each
    group from its k-distances. Everything is worked out for distinct vectors; rows meet them once, at the end.
    """
    v = l2_normalised(F.col(vector)) if normalise else F.col(vector).cast("array<double>")
    rows = points.select(group, key, *keep, v.alias("__v"))
    place = [F.xxhash64("__v").alias("__h"), F.xxhash64(F.lit(1), "__v").alias("__i")]  # 128 bits stand for a vector: sorting by an array of doubles is slow
    placed = rows.select("*", *place)
    spots = cut(placed.groupBy(group, "__h", "__i").agg(F.min(key).alias("spot"), F.count(F.lit(1)).alias("copies"), F.min("__v").alias("__v")))
    radius = spots.groupBy(group).agg(F.sum("copies").alias("n")).where(F.col("n") >= least).select(group)
    radius = radius.withColumn("eps", F.lit(float(eps))) if eps is not None else radius.join(group_radius(rows, group, key, "__v", least), group)
    radius = cut(radius)
    edges = cut(range_edges(spots, group, "spot", "__v", radius, metric))
    labels = density_labels(spots, edges, group, "spot", least, "copies")
    conf = centroid_confidence(spots.join(labels, [group, "spot"]), group, "spot", "__v", weight="copies")
    found = cut(conf.join(radius, group, "left").select(group, "spot", "cluster_id", "confidence", "eps"))
    return placed.join(spots.select(group, "__h", "__i", "spot"), [group, "__h", "__i"]).join(found, [group, "spot"]).select(group, key, *keep, "cluster_id", "confidence", "eps")


def group_radius(points: DataFrame, group: str, key: str, vector: str, k: int) -> DataFrame:
    """``(group, eps)``: the radius that each group's k-distances suggest; a task sees one number for each row of a group."""
    kinds = dict(points.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({group: [pdf[group].iloc[0]], "eps": [radius_of(np.sort(pdf["dist"].to_numpy()))]})

    return k_distances(points, key, vector, k, group).groupBy(group).applyInPandas(run, f"{group} {kinds[group]}, eps double")


def centroid_confidence(points: DataFrame, group: str, key: str, vector: str, cluster: str = "cluster_id", weight: str | None = None) -> DataFrame:
    """``(group, key, cluster, confidence)``: ``1 / (1 + distance to the cluster's mean)``, 0 for noise.

    The mean is taken by position with map-side combining, so a cluster of any size needs no list of its members. ``weight``
    names a column that says for how many equal rows a row stands.
    """
    real = points.where(F.col(cluster) >= 0)
    mean = F.avg("v") if weight is None else F.sum(F.col("v") * F.col("__w")) / F.sum("__w")
    means = (
        real.select(group, cluster, F.lit(1).alias("__w") if weight is None else F.col(weight).alias("__w"), F.posexplode(F.col(vector).cast("array<double>")).alias("i", "v"))
        .groupBy(group, cluster, "i")
        .agg(mean.alias("v"))
        .groupBy(group, cluster)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda p: p["v"]).alias("mean"))
    )
    near = points.join(means, [group, cluster], "left")
    conf = F.when(F.col("mean").isNull(), F.lit(0.0)).otherwise(1 / (1 + distance(F.col(vector).cast("array<double>"), F.col("mean"))))
    return near.select(group, key, cluster, conf.alias("confidence"))


def k_distances(points: DataFrame, key: str, vector: str, k: int, group: str | None = None) -> DataFrame:
    """``(group, key, dist)``: distance of each row to its k-th nearest in the group, itself counted (the last, if there are fewer).

    Exact, so every two blocks of a group meet: its cost is quadratic in the size of a group.
    """
    kinds = dict(points.dtypes)
    name = group or "__g"
    kind = kinds[group] if group else "int"
    rows = pair_blocks(points.select(*([group] if group else [F.lit(0).alias(name)]), key, vector), [name], key, [key, vector])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
        left, right = pdf[pdf["blk"] == lo], pdf[pdf["blk"] == hi]
        out = []
        if len(left) and len(right):
            x, y = np.stack(left[vector].to_numpy()), np.stack(right[vector].to_numpy())
            for p, q, pk, qk in ((x, y, left, right), (y, x, right, left))[: 1 if lo == hi else 2]:
                for at in range(0, len(p), 1000):
                    d = distances(p[at : at + 1000], q)
                    own = pk[key].to_numpy()[at : at + 1000]
                    d[own[:, None] == qk[key].to_numpy()[None, :]] = 0.0
                    m = min(k, d.shape[1])
                    best = np.sort(np.partition(d, m - 1, axis=1)[:, :m], axis=1)
                    out.append((np.repeat(own, m), best.ravel()))
        if not out:
            none = pdf.head(0)
            return pd.DataFrame({name: none[name], key: none[key], "dist": np.empty(0)})
        keys, dist = (np.concatenate(v) for v in zip(*out))
        return pd.DataFrame({name: [pdf[name].iloc[0]] * len(keys), key: keys, "dist": dist})

    near = rows.groupBy(name, "lo", "hi").applyInPandas(run, f"{name} {kind}, {key} {kinds[key]}, dist double")
    order = W.partitionBy(name, key).orderBy("dist")
    few = near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    return few.groupBy(name, key).agg(F.max("dist").alias("dist")).select(*([group] if group else []), key, "dist")


def percentile_radius(dists: DataFrame, share: float = 0.95) -> DataFrame:
    """One row ``eps``: the exact percentile of the distances, repaired where it is degenerate."""
    eps = F.percentile("dist", F.lit(share))
    large = F.avg(F.when(F.col("dist") > 1e-6, F.col("dist")))
    return dists.agg(F.when(eps < 1e-6, F.coalesce(large, F.lit(0.1))).when(eps.isNull(), F.lit(0.5)).otherwise(eps).alias("eps"))


def pca_reduced(points: DataFrame, vector: str, k: int, out: str = "reduced") -> DataFrame:
    """Vectors projected on their first ``k`` principal components: a linear stand-in for manifold reduction."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    with_vector = points.withColumn("__v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(with_vector)
    return model.transform(with_vector).withColumn(out, vector_to_array("__p")).drop("__v", "__p")
