"""Optimal assignment, elbow detection and density clustering in numpy."""

from __future__ import annotations

import numpy as np


def hungarian(cost: np.ndarray) -> np.ndarray:
    """Column of each row in a square assignment of least cost (shortest augmenting paths with potentials)."""
    n = cost.shape[0]
    u, v = np.zeros(n + 1), np.zeros(n + 1)
    match = np.zeros(n + 1, np.int64)
    for row in range(1, n + 1):
        match[0], j0 = row, 0
        low, used, way = np.full(n + 1, np.inf), np.zeros(n + 1, bool), np.zeros(n + 1, np.int64)
        while True:
            used[j0] = True
            i0 = match[j0]
            free = ~used[1:]
            reduced = cost[i0 - 1] - u[i0] - v[1:]
            better = free & (reduced < low[1:])
            low[1:][better] = reduced[better]
            way[1:][better] = j0
            j1 = int(np.argmin(np.where(used, np.inf, low))) if free.any() else 0
            delta = low[j1]
            u[match[used]] += delta
            v[used] -= delta
            low[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    out = np.empty(n, np.int64)
    out[match[1:] - 1] = np.arange(n)
    return out


def align(counts: np.ndarray) -> np.ndarray:
    """For each row label the column label that an assignment of most agreement gives it, or -1."""
    rows, cols = counts.shape
    n = max(rows, cols)
    square = np.zeros((n, n))
    square[:rows, :cols] = counts
    chosen = hungarian(square.max(initial=0) - square)[:rows]
    return np.where(chosen < cols, chosen, -1)


def knee(y: np.ndarray, sensitivity: float = 1.0) -> float | None:
    """The elbow of an increasing convex curve by the kneedle method, or None."""
    n = len(y)
    if n < 3 or y[-1] == y[0]:
        return None
    x = np.linspace(0.0, 1.0, n)
    flipped = 1 - (y - y.min()) / (y.max() - y.min())
    diff = (flipped[::-1] - x)
    inner = np.arange(1, n - 1)
    peaks = inner[(diff[inner] >= diff[inner - 1]) & (diff[inner] >= diff[inner + 1])]
    valleys = set(inner[(diff[inner] <= diff[inner - 1]) & (diff[inner] <= diff[inner + 1])].tolist())
    if not len(peaks):
        return None
    fall = sensitivity * np.abs(np.diff(x).mean())
    peak_set, threshold, at = set(peaks.tolist()), None, 0
    for i in range(int(peaks[0]), n - 1):
        if i in peak_set:
            threshold, at = diff[i] - fall, i
        if i in valleys:
            threshold = 0.0
        if threshold is not None and diff[i + 1] < threshold:
            return float(y[n - 1 - at])
    return None


def distances(x: np.ndarray, y: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    x, y = x.astype(np.float64), y.astype(np.float64)
    if metric == "cosine":
        nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        return 1 - (x @ y.T) / np.maximum(nx[:, None] * ny[None, :], 1e-300)
    if metric == "manhattan":
        return np.abs(x[:, None, :] - y[None, :, :]).sum(axis=2)
    return np.sqrt(np.maximum(((x**2).sum(1)[:, None] + (y**2).sum(1)[None, :] - 2 * x @ y.T), 0.0))


def kth_distances(x: np.ndarray, k: int) -> np.ndarray:
    """Ascending distances to the k-th nearest row, the row itself counting as the first."""
    k = min(k, len(x))
    parts = [np.partition(distances(x[a : a + 1000], x), k - 1, axis=1)[:, k - 1] for a in range(0, len(x), 1000)]
    return np.sort(np.concatenate(parts)) if parts else np.empty(0)


def radius_of(d: np.ndarray, percentile: float = 95.0) -> float:
    """Neighbourhood radius from ascending k-distances: their elbow, else their percentile, repaired if degenerate."""
    eps = knee(d)
    if eps is None:
        eps = float(np.percentile(d, percentile)) if len(d) else 0.0
    if eps < 1e-6:
        large = d[d > 1e-6]
        eps = float(large.mean()) if len(large) else 0.1
    return eps if eps > 0 else 0.5


def auto_eps(x: np.ndarray, k: int, percentile: float = 95.0) -> float:
    return radius_of(kth_distances(x, k), percentile)


def dbscan(x: np.ndarray, eps: float, least: int, metric: str = "euclidean") -> np.ndarray:
    """Cluster numbers by smallest core row, -1 for noise; a border row takes the smallest adjacent cluster."""
    _, first, back, count = np.unique(x, axis=0, return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(first)  # equal rows share their fate; the rest keeps the order of rows
    if len(order) < len(x):
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        return _expand(x[first[order]], count[order], eps, least, metric)[at[back.ravel()]]
    return _expand(x, np.ones(len(x), np.int64), eps, least, metric)


def _expand(x: np.ndarray, count: np.ndarray, eps: float, least: int, metric: str) -> np.ndarray:
    """``dbscan`` of distinct rows that stand for ``count`` rows each."""
    n = len(x)
    near = [np.flatnonzero(d <= eps) for a in range(0, n, 1000) for d in distances(x[a : a + 1000], x, metric)]
    core = np.array([count[v].sum() >= least for v in near], bool)
    label = np.full(n, -1, np.int64)
    number = 0
    for i in range(n):
        if not core[i] or label[i] >= 0:
            continue
        todo = [i]
        label[i] = number
        while todo:
            for j in near[todo.pop()]:
                if label[j] < 0:
                    label[j] = number
                    if core[j]:
                        todo.append(int(j))
        number += 1
    return label
