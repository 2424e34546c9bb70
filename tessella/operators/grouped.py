"""Calling a numpy function on every group of a sorted stream, without a Python call for each group's transfer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``fn`` gets each group's columns as arrays and returns columns; rows come partitioned and sorted by ``keys``.

    A partition is read batch by batch; only a group that a batch leaves unfinished is carried on. For
    groups that fit a task. Keys must not be null.
    """

    def split(pdf: pd.DataFrame) -> tuple[list[int], dict[str, np.ndarray]]:
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        change = np.zeros(len(pdf), bool)
        for k in keys:
            change[1:] |= cols[k][1:] != cols[k][:-1]
        return [0, *np.flatnonzero(change).tolist()], cols

    def call(cols: dict[str, np.ndarray], a: int, b: int) -> dict[str, np.ndarray]:
        return fn({c: v[a:b] for c, v in cols.items()})

    def frame(parts: list[dict[str, np.ndarray]]) -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([p[c] for p in parts]) for c in parts[0]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            if pdf.empty:
                continue
            starts, cols = split(pdf)
            rest = pdf.iloc[starts[-1] :]
            if len(starts) > 1:
                yield frame([call(cols, a, b) for a, b in zip(starts, starts[1:])])
        if rest is not None and len(rest):
            yield frame([call({c: rest[c].to_numpy() for c in rest.columns}, 0, len(rest))])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
