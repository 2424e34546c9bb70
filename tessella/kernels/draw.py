"""Numpy kernels that cut, resize and paint pixel arrays."""

from __future__ import annotations

import numpy as np


def to_rgb(px: np.ndarray) -> np.ndarray:
    """Three channels out of grey, grey with alpha, RGB or RGBA; 16-bit values keep their high byte."""
    px = (px >> 8).astype(np.uint8) if px.dtype.itemsize > 1 else px
    if px.ndim == 2 or px.shape[2] < 3:
        grey = px if px.ndim == 2 else px[:, :, 0]
        return np.repeat(grey[:, :, None], 3, axis=2)
    return px[:, :, :3]


def box_crop(px: np.ndarray, box: list[int]) -> np.ndarray:
    """The pixels of ``[x0, y0, x1, y1]``, maxima exclusive; what lies outside is black, and a box without area is an error."""
    x0, y0, x1, y1 = (int(v) for v in box)
    if x1 <= x0 or y1 <= y0:
        raise ValueError("a box without area")
    h, w = px.shape[:2]
    out = np.zeros((y1 - y0, x1 - x0, *px.shape[2:]), px.dtype)
    top, left, bottom, right = max(y0, 0), max(x0, 0), min(y1, h), min(x1, w)
    if top < bottom and left < right:
        out[top - y0 : bottom - y0, left - x0 : right - x0] = px[top:bottom, left:right]
    return out


def enlarged(side: int, magnification: float) -> tuple[int, int]:
    """``(size, offset)``: the side of a tile enlarged by a magnification above 1, and where its middle window begins."""
    size = int(side * magnification)
    return size, (size - side) // 2


def centre_crop(px: np.ndarray, side: int) -> np.ndarray:
    """The middle ``side`` by ``side`` window."""
    top, left = (px.shape[0] - side) // 2, (px.shape[1] - side) // 2
    return box_crop(px, [left, top, left + side, top + side])


def _weights(n: int, m: int, kind: str) -> np.ndarray:
    """Rows of weights that turn ``n`` samples into ``m``; when shrinking, the kernel is stretched so that it averages."""
    support = {"lanczos": 3.0, "bicubic": 2.0}[kind]
    scale = max(1.0, n / m)
    x = (np.arange(n)[None, :] + 0.5 - (np.arange(m)[:, None] + 0.5) * n / m) / scale
    if kind == "lanczos":
        w = np.sinc(x) * np.sinc(x / 3)
    else:
        a, t = -0.5, np.abs(x)
        w = np.where(t < 1, ((a + 2) * t - (a + 3)) * t * t + 1, (((t - 5) * t + 8) * t - 4) * a)
    w = np.where(np.abs(x) < support, w, 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resize(px: np.ndarray, width: int, height: int, kind: str = "lanczos") -> np.ndarray:
    """Separable resampling, ``lanczos`` or ``bicubic``, rounded and clipped to bytes."""
    rows, cols = _weights(px.shape[0], height, kind), _weights(px.shape[1], width, kind)
    out = np.tensordot(rows, px.astype(np.float64), axes=(1, 0))
    out = np.moveaxis(np.tensordot(cols, out, axes=(1, 1)), 0, 1)
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def line(px: np.ndarray, a: tuple[int, int], b: tuple[int, int], colour: tuple[int, ...], thickness: int = 2) -> None:
    """A straight line from ``(x, y)`` to ``(x, y)``, painted in place; parts outside are left out."""
    steps = max(abs(b[0] - a[0]), abs(b[1] - a[1]), 1)
    x = np.round(np.linspace(a[0], b[0], steps + 1)).astype(int)
    y = np.round(np.linspace(a[1], b[1], steps + 1)).astype(int)
    for dx in range(-(thickness // 2), thickness - thickness // 2):
        for dy in range(-(thickness // 2), thickness - thickness // 2):
            ok = (x + dx >= 0) & (x + dx < px.shape[1]) & (y + dy >= 0) & (y + dy < px.shape[0])
            px[y[ok] + dy, x[ok] + dx] = colour


def outline(px: np.ndarray, points: list[tuple[int, int]], colour: tuple[int, ...], thickness: int = 2) -> None:
    """A closed line through the points."""
    for a, b in zip(points, [*points[1:], points[0]] if len(points) else []):
        line(px, a, b, colour, thickness)


def rectangle(px: np.ndarray, box: list[int], colour: tuple[int, ...], thickness: int = 2) -> None:
    x0, y0, x1, y1 = (int(v) for v in box)
    outline(px, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)], colour, thickness)
