from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.kernels import assign, raster


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.integers(0, 10**6))
def test_alignment_is_optimal(rows, cols, seed):
    c = np.random.default_rng(seed).integers(0, 9, (rows, cols))
    to = assign.align(c)
    got = sum(c[r, t] for r, t in enumerate(to) if t >= 0)
    n = max(rows, cols)
    sq = np.zeros((n, n))
    sq[:rows, :cols] = c
    assert got == max(sum(sq[i, p[i]] for i in range(n)) for p in permutations(range(n)))
    used = [t for t in to if t >= 0]
    assert len(used) == len(set(used))


def test_alignment_of_uneven_labels():
    assert assign.align(np.array([[2, 1], [0, 1]])).tolist() == [0, 1]


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6))
def test_dbscan_by_definition(n, seed):
    x = np.random.default_rng(seed).random((n, 2))
    eps, k = 0.2, 3
    lab = assign.dbscan(x, eps, k)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    core = (d <= eps).sum(1) >= k
    assert (lab[core] >= 0).all()
    for i in range(n):
        near = [j for j in range(n) if core[j] and d[i, j] <= eps]
        if core[i]:
            assert {lab[j] for j in near} == {lab[i]}
        else:
            assert lab[i] == (min(lab[j] for j in near) if near else -1)


def test_radius():
    same = np.ones((10, 3))
    assert assign.auto_eps(same, 5) == 0.1
    curve = np.concatenate([np.linspace(0, 1, 90), np.linspace(1.5, 20, 10)])
    assert 0.8 <= assign.knee(curve) <= 2.5
    assert assign.knee(np.array([1.0, 1.0])) is None


def test_contours():
    m = np.zeros((5, 6), bool)
    m[1:4, 2:5] = True
    line = raster.longest_contour(m)
    assert line[0] == line[-1]
    assert len(line) == 13
    assert min(x for x, _ in line) == 1.5 and max(y for _, y in line) == 3.5
    assert raster.longest_contour(np.ones((3, 3), bool)) is None
    diagonal = np.array([[0, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 0]], bool)
    assert len(raster.contours(diagonal)) == 2


def test_components_and_png():
    m = np.array([[1, 1, 0], [0, 0, 1], [1, 0, 1]], bool)
    assert raster.label_components(m).tolist() == [[1, 1, 0], [0, 0, 2], [3, 0, 2]]
    mask = np.arange(12, dtype=np.uint16).reshape(3, 4) * 100
    assert (raster.read_png(raster.write_png16(mask)) == mask).all()
    with pytest.raises(ValueError):
        raster.read_png(b"no image")


def test_canny():
    g = np.zeros((20, 20), np.uint8)
    g[:, 10:] = 255
    edges = raster.canny(g)
    assert edges[:, 9:11].any(axis=1).all()
    assert edges.sum() == 20
    assert not raster.canny(np.full((8, 8), 7, np.uint8)).any()


def test_statistics_of_flat_tile():
    s = raster.tile_statistics(np.full((4, 4, 3), 250, np.uint8))
    assert s["bright_pixels_ratio"] == 1 and s["edge_density"] == 0 and s["laplacian_var"] == 0 and s["color_variance"] == 0


def test_png_filters_against_a_plain_loop():
    """All five row filters, 8 and 16 bits, one to four channels, encoded and decoded pixel by pixel."""
    import struct
    import zlib

    rng = np.random.default_rng(5)
    for channels, depth in ((1, 8), (3, 8), (4, 8), (1, 16), (3, 16)):
        step, h, w = channels * depth // 8, 7, 6
        raw = rng.integers(0, 256, (h, w * step)).astype(int)
        body = b""
        for r in range(h):
            kind, line = r % 5, []
            for i in range(w * step):
                a = raw[r, i - step] if i >= step else 0
                b = raw[r - 1, i] if r else 0
                c = raw[r - 1, i - step] if r and i >= step else 0
                p = a + b - c
                near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                line.append((raw[r, i] - (0, a, b, (a + b) // 2, near)[kind]) % 256)
            body += bytes([kind, *line])
        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        head = struct.pack(">IIBBBBB", w, h, depth, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
        png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")
        got = raster.read_png(png)
        want = raw if depth == 8 else raw.reshape(h, -1, 2)[..., 0] * 256 + raw.reshape(h, -1, 2)[..., 1]
        assert (got.reshape(h, -1) == want).all()
        assert (raster.read_png(raster.write_png(got)) == got).all()


def test_stacks_equal_single_labels():
    """All labels of a stack at once give the contours and boxes that each label gives alone: open lines, diagonals, holes, ties, labels of any size."""
    rng = np.random.default_rng(7)
    for turn in range(60):
        kinds = [np.array([0, 1]), np.array([0, 0, 1, 2, 3]), np.array([-5, 0, 7, 2**31 - 1])][turn % 3]
        stack = kinds[rng.integers(0, len(kinds), (*rng.integers(1, 5, 1), *rng.integers(1, 12, 2)))]
        if turn % 2:
            stack = stack.repeat(3, axis=1).repeat(2, axis=2)
        lines, boxes = [], []
        for t, mask in enumerate(stack):
            for lab in np.unique(mask[mask != 0]).tolist():
                line = raster.longest_contour(mask == lab)
                lines += [(t, lab, line)] if line else []
                y, x = np.nonzero(mask == lab)
                boxes.append((t, lab, [x.min(), y.min(), x.max(), y.max()]))
        tile, label, start, points = raster.longest_contours(stack)
        assert [(t, lab, [tuple(p) for p in points[a:b].tolist()]) for t, lab, a, b in zip(tile.tolist(), label.tolist(), start, start[1:])] == lines
        assert [(t, lab, b) for t, lab, b in zip(*(v.tolist() for v in raster.label_boxes(stack)))] == boxes
        assert (raster.label_stack(stack > 0) == np.stack([raster.label_components(m > 0) for m in stack])).all()
