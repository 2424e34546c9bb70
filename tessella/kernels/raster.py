"""Numpy kernels on pixel arrays: edges, contours, connected components, 16-bit PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np


def _shift(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """The array moved by (dy, dx), borders reflected without repeating the edge."""
    p = np.pad(a, 1, mode="reflect" if min(a.shape) > 1 else "edge")
    return p[1 + dy : 1 + dy + a.shape[0], 1 + dx : 1 + dx + a.shape[1]]


def laplacian(gray: np.ndarray) -> np.ndarray:
    g = gray.astype(np.float64)
    return _shift(g, -1, 0) + _shift(g, 1, 0) + _shift(g, 0, -1) + _shift(g, 0, 1) - 4 * g


def canny(gray: np.ndarray, low: float = 50, high: float = 150) -> np.ndarray:
    """Edge mask: 3x3 Sobel, L1 magnitude, non-maximum suppression in four directions, hysteresis."""
    g = np.pad(gray.astype(np.int64), 1, mode="edge")
    n, m = gray.shape
    at = lambda dy, dx: g[1 + dy : 1 + dy + n, 1 + dx : 1 + dx + m]
    gx = at(-1, 1) + 2 * at(0, 1) + at(1, 1) - at(-1, -1) - 2 * at(0, -1) - at(1, -1)
    gy = at(1, -1) + 2 * at(1, 0) + at(1, 1) - at(-1, -1) - 2 * at(-1, 0) - at(-1, 1)
    mag = np.abs(gx) + np.abs(gy)
    p = np.pad(mag, 1)
    mv = lambda dy, dx: p[1 + dy : 1 + dy + n, 1 + dx : 1 + dx + m]
    flat = np.abs(gy) <= np.abs(gx) * 0.4142135623730951
    steep = np.abs(gy) >= np.abs(gx) * 2.414213562373095
    rising = (gx * gy) >= 0
    first = np.where(flat, mv(0, -1), np.where(steep, mv(-1, 0), np.where(rising, mv(-1, -1), mv(-1, 1))))
    second = np.where(flat, mv(0, 1), np.where(steep, mv(1, 0), np.where(rising, mv(1, 1), mv(1, -1))))
    peak = (mag > first) & (mag >= second)
    strong, weak = peak & (mag > high), peak & (mag > low)
    while True:
        q = np.pad(strong, 1)
        near = np.zeros_like(strong)
        for dy in (0, 1, 2):
            for dx in (0, 1, 2):
                near |= q[dy : dy + n, dx : dx + m]
        grown = near & weak
        if (grown == strong).all():
            return strong
        strong = grown


def label_components(mask: np.ndarray) -> np.ndarray:
    """4-connected components of a mask, numbered from 1 in reading order."""
    return label_stack(mask[None])[0]


def label_stack(masks: np.ndarray) -> np.ndarray:
    """``label_components`` of each mask of a stack (k, n, m), all at once."""
    k, n, m = masks.shape
    big = n * m
    own = np.arange(big, dtype=np.int32).reshape(1, n, m)
    lab = np.where(masks, own, big).astype(np.int32)
    while True:
        new = lab.copy()
        np.minimum(new[:, 1:], lab[:, :-1], out=new[:, 1:])
        np.minimum(new[:, :-1], lab[:, 1:], out=new[:, :-1])
        np.minimum(new[:, :, 1:], lab[:, :, :-1], out=new[:, :, 1:])
        np.minimum(new[:, :, :-1], lab[:, :, 1:], out=new[:, :, :-1])
        new[~masks] = big
        if (new == lab).all():
            break
        lab = new
    number = np.zeros((k, big + 1), np.int64)  # of each component's first pixel; the last column is background
    np.cumsum((lab == own).reshape(k, big), axis=1, out=number[:, :big])
    number[:, big] = 0
    return np.take_along_axis(number, lab.reshape(k, big).astype(np.int64), axis=1).reshape(k, n, m)


def _by_label(tile: np.ndarray, label: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(tile, label)`` pairs as one number in their order, with the labels in order and how many numbers a tile takes.

    ``size`` is what the number will be multiplied with: where a label's own value would not fit, its rank is taken.
    """
    low, high = int(label.min()), int(label.max())
    if (int(tile.max()) + 1) * (high - low + 1) * size < 2**62 and high - low < 2**20:
        return tile.astype(np.int64) * (high - low + 1) + (label.astype(np.int64) - low), np.arange(low, high + 1), high - low + 1
    kinds, rank = np.unique(label, return_inverse=True)
    return tile.astype(np.int64) * len(kinds) + rank.ravel(), kinds, len(kinds)


def label_boxes(stack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(tile, label, boxes)`` of every label but 0 in a stack (k, h, w) of label rasters, by tile and label; boxes are ``x0, y0, x1, y1``, inclusive."""
    _, h, w = stack.shape
    at = np.flatnonzero(stack)
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 4), np.int64)
    tile, place = np.divmod(at, h * w)
    group, kinds, span = _by_label(tile, stack.ravel()[at], 1)
    order = np.argsort(group, kind="stable")
    group, place = group[order], place[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    y, x = np.divmod(place, w)
    boxes = np.stack([np.minimum.reduceat(x, first), np.minimum.reduceat(y, first), np.maximum.reduceat(x, first), np.maximum.reduceat(y, first)], axis=1)
    return group[first] // span, kinds[group[first] % span], boxes


# Marching squares: for each code of the four corners (top left 1, top right 2, bottom right 4, bottom left 8) the segments between
# the sides top 0, right 1, bottom 2, left 3 that keep the set pixels on one side; diagonal pixels stay apart.
SEGMENTS = {1: [(0, 3)], 2: [(1, 0)], 3: [(1, 3)], 4: [(2, 1)], 5: [(0, 3), (2, 1)], 6: [(2, 0)], 7: [(2, 3)], 8: [(3, 2)], 9: [(0, 2)], 10: [(1, 0), (3, 2)], 11: [(1, 2)], 12: [(3, 1)], 13: [(0, 1)], 14: [(3, 0)]}
SIDES = np.array([(0.0, 0.5), (0.5, 1.0), (1.0, 0.5), (0.5, 0.0)])


def contours(mask: np.ndarray) -> list[list[tuple[float, float]]]:
    """Iso-lines at 0.5 of a 0/1 raster as ``(row, col)`` points: marching squares, diagonal pixels apart.

    Lines that leave the raster stay open; the others return to their first point. Only squares on a border are visited.
    """
    a = mask.astype(np.int8)
    code = a[:-1, :-1] + 2 * a[:-1, 1:] + 4 * a[1:, 1:] + 8 * a[1:, :-1]
    at = np.argwhere((code > 0) & (code < 15))
    links: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for (r, c), kind in zip(at.tolist(), code[at[:, 0], at[:, 1]].tolist()):
        for p, q in SEGMENTS[kind]:
            links.setdefault((r + SIDES[p, 0], c + SIDES[p, 1]), []).append((r + SIDES[q, 0], c + SIDES[q, 1]))
    ends = {q for qs in links.values() for q in qs}
    lines = []
    for start in sorted(links, key=lambda p: (p in ends, p)):
        while links.get(start):
            line, at = [start], start
            while links.get(at):
                at = links[at].pop(0)
                line.append(at)
                if at == start:
                    break
            lines.append(line)
    return lines


def longest_contour(mask: np.ndarray) -> list[tuple[float, float]] | None:
    """The contour with most points as ``(x, y)``, the first of equals; None if there is none."""
    found = contours(mask)
    return [(c, r) for r, c in max(found, key=len)] if found else None


FIRST = np.array([SEGMENTS.get(i, [(0, 0)])[0] for i in range(16)])
SECOND = np.array([SEGMENTS.get(i, [(0, 0)])[-1] for i in range(16)])


def longest_contours(stack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``longest_contour`` of every label but 0 in a stack (k, h, w) of label rasters, all at once.

    Gives ``(tile, label, start, points)`` by tile and label; ``points[start[i] : start[i + 1]]`` are the ``(x, y)`` of line ``i``. Labels without contour are
    left out. In one label's lines a point begins at most one segment and ends at most one, so lines are chains whose places come
    from doubling the steps; a chain begins where nothing leads to, a ring at its smallest point.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.int64), np.empty((0, 2))
    k, h, w = stack.shape
    if k == 0 or h < 2 or w < 2:
        return none
    views = [stack[:, :-1, :-1], stack[:, :-1, 1:], stack[:, 1:, 1:], stack[:, 1:, :-1]]
    at = np.flatnonzero((views[0] != views[1]) | (views[1] != views[2]) | (views[2] != views[3]))
    tile, place = np.divmod(at, (h - 1) * (w - 1))
    row, col = np.divmod(place, w - 1)
    corner = [v.ravel() for v in (stack[tile, row, col], stack[tile, row, col + 1], stack[tile, row + 1, col + 1], stack[tile, row + 1, col])]
    found = []
    for i in range(4):
        new = corner[i] != 0
        for j in range(i):
            new &= corner[j] != corner[i]
        sq = np.flatnonzero(new)
        label = corner[i][sq]
        code = sum((corner[j][sq] == label).astype(np.int64) << j for j in range(4))
        found.append((sq, label, FIRST[code]))
        two = (code == 5) | (code == 10)
        found.append((sq[two], label[two], SECOND[code[two]]))
    sq, label, sides = (np.concatenate(v) for v in zip(*found))
    if not len(sq):
        return none
    wide = 2 * w - 1
    size = (2 * h - 1) * wide
    group, kinds, span = _by_label(tile[sq], label, size)
    side = np.array([1, wide + 2, 2 * wide + 1, wide])  # places of the sides' middles in a raster of half pixels
    base = group * size + (2 * row[sq] * wide + 2 * col[sq])
    start, end = base + side[sides[:, 0]], base + side[sides[:, 1]]
    order = np.argsort(start, kind="stable")
    start, end = start[order], end[order]

    n = len(start)
    own = np.arange(n)
    after = np.searchsorted(start, end)
    after[start[np.minimum(after, n - 1)] != end] = n
    before = np.full(n + 1, n)
    before[after[after < n]] = own[after < n]
    before = before[:n]
    low, step = np.append(own, n), np.append(after, n)  # the smallest of a ring
    while True:
        lower, further = np.minimum(low, low[step]), step[step]
        same = (lower == low).all() and ((further == n) == (step == n)).all()
        low, step = lower, further
        if same:
            break
    ring = step[:n] < n
    before[ring & (low[:n] == own)] = n
    head = np.where(before == n, own, before)
    rank = (before < n).astype(np.int64)
    while True:
        further = head[head]
        if (further == head).all():
            break
        rank, head = rank + rank[head], further

    heads = np.flatnonzero(head == own)
    count = np.bincount(head, minlength=n)[heads]
    of = start[heads] // size
    best = np.lexsort((heads, ring[heads], -count, of))  # of equal lines the open ones come first, then the smaller start
    best = best[np.r_[True, of[best][1:] != of[best][:-1]]]
    heads, count, of = heads[best], count[best], of[best]
    begin = np.r_[0, np.cumsum(count + 1)]
    slot = np.full(n, -1)
    slot[heads] = np.arange(len(heads))
    line = slot[head]
    kept = line >= 0
    line, rank, start, end = line[kept], rank[kept], start[kept], end[kept]
    spot = np.empty(begin[-1], np.int64)
    spot[begin[line] + rank] = start
    last = rank == count[line] - 1
    spot[begin[line[last] + 1] - 1] = end[last]
    y, x = np.divmod(spot % size, wide)
    return of // span, kinds[of % span], begin, np.stack([x / 2, y / 2], axis=1)


def tile_statistics(rgb: np.ndarray) -> dict[str, float]:
    """The seven quality figures of a tile, colour or grey (channels beyond the third are left out); a grey one has no colour variance."""
    if rgb.ndim == 3 and rgb.shape[2] >= 3:
        rgb = rgb[:, :, :3]
        gray = ((rgb.astype(np.int64) @ np.array([4899, 9617, 1868]) + 8192) >> 14).astype(np.uint8)
        colour = float(np.var(rgb.reshape(-1, 3).mean(axis=0)))
    else:
        gray, colour = rgb.reshape(rgb.shape[:2] + (-1,))[:, :, 0], float("nan")
    return {
        "mean_intensity": float(gray.mean()),
        "std_intensity": float(gray.std()),
        "bright_pixels_ratio": float((gray > 240).mean()),
        "dark_pixels_ratio": float((gray < 15).mean()),
        "edge_density": float(canny(gray).mean()),
        "color_variance": colour,
        "laplacian_var": float(laplacian(gray).var()),
    }


def write_png(pixels: np.ndarray) -> bytes:
    """A grey (h, w), grey with alpha, RGB or RGBA (h, w, channels) raster of 8 or 16 bits as PNG."""
    channels = 1 if pixels.ndim == 2 else pixels.shape[2]
    depth = 16 if pixels.dtype.itemsize > 1 else 8
    raw = b"".join(b"\0" + line.astype(">u2" if depth == 16 else np.uint8).tobytes() for line in pixels)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", pixels.shape[1], pixels.shape[0], depth, {1: 0, 2: 4, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write_png16(mask: np.ndarray) -> bytes:
    """A label raster as 16-bit grey PNG."""
    return write_png(mask.astype(np.uint16))


def _unfilter(raw: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """Undoes the row filters of PNG on rows of ``step``-byte pixels.

    Rows without a left neighbour's part (0, 2) and with nothing else (1) are whole-row sums; if any row has the mean or
    Paeth filter (3, 4), pixels are resolved along diagonals, each of which depends on the two before it only.
    """
    h, size = raw.shape
    px = raw.reshape(h, size // step, step).astype(np.int32)
    if not np.isin(kinds, (3, 4)).any():
        for r in range(h):
            if kinds[r] == 1:
                px[r] = np.cumsum(px[r], axis=0) & 255
            elif kinds[r] == 2 and r:
                px[r] = (px[r] + px[r - 1]) & 255
        return px.reshape(h, size)
    w = px.shape[1]
    out = np.zeros((h + 1, w + 1, step), np.int32)  # a row above and a column to the left of zeros
    for d in range(h + w - 1):
        r = np.arange(max(0, d - w + 1), min(h, d + 1))
        c = d - r
        left, up, corner = out[r + 1, c], out[r, c + 1], out[r, c]
        p = left + up - corner
        far = [np.abs(p - v) for v in (left, up, corner)]
        paeth = np.where((far[0] <= far[1]) & (far[0] <= far[2]), left, np.where(far[1] <= far[2], up, corner))
        kind = kinds[r][:, None]
        out[r + 1, c + 1] = (px[r, c] + np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) // 2, paeth], 0)) & 255
    return out[1:, 1:].reshape(h, size)


def read_png(data: bytes) -> np.ndarray:
    """Pixels of a non-interlaced grey or RGB(A) PNG of 8 or 16 bits; shape (h, w) or (h, w, channels)."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body, head = 8, [], b""
    while at + 8 <= len(data):
        (size,) = struct.unpack(">I", data[at : at + 4])
        kind, part = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        head = part if kind == b"IHDR" else head
        body += [part] if kind == b"IDAT" else []
        at += 12 + size
    if len(head) != 13:
        raise ValueError("broken PNG")
    w, h, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", head)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if channels is None or depth not in (8, 16) or interlace:
        raise ValueError("unsupported PNG")
    step = channels * depth // 8
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * step)
    except zlib.error as e:
        raise ValueError("broken PNG") from e
    out = _unfilter(raw[:, 1:], raw[:, 0], step)
    pixels = out.reshape(h, w * channels, depth // 8)
    values = pixels[..., 0].astype(np.uint8) if depth == 8 else (pixels[..., 0] * 256 + pixels[..., 1]).astype(np.uint16)
    return values.reshape(h, w) if channels == 1 else values.reshape(h, w, channels)
