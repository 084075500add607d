"""Numeric kernels of pages and probability maps in NumPy, called in Arrow batches: masks, components, rectangles, growing, sizes and normalisation."""

from __future__ import annotations

import numpy as np

# Mean and standard deviation of the three channels that models are trained on.
MEAN, STD = np.array([0.485, 0.456, 0.406]), np.array([0.229, 0.224, 0.225])
#: Growth of outlines beyond that of boxes.
OUTLINE = 1.45


def decode_pixmap(content: bytes | None) -> np.ndarray | None:
    """Height, width, channels of a binary portable grey or pixel map; null if it isn't one, or is cut."""
    head = (content or b"").split(None, 4)
    if len(head) < 4 or head[0] not in (b"P5", b"P6") or not all(x.isdigit() for x in head[1:4]) or int(head[3]) > 255:
        return None
    w, h, c = int(head[1]), int(head[2]), 1 if head[0] == b"P5" else 3
    size = w * h * c
    raw = content[len(content) - size :] if size and len(content) >= size + 9 else b""
    return np.frombuffer(raw, np.uint8).reshape(h, w, c) if len(raw) == size else None


def swap_channels(img: np.ndarray) -> np.ndarray:
    """Red, green, blue to blue, green, red, and back."""
    return img[..., ::-1]


def binarise(prob: np.ndarray, thresh: float = 0.3) -> np.ndarray:
    return prob > thresh


def dilate(mask: np.ndarray) -> np.ndarray:
    """Growth by a two by two square: each pixel, its left, upper and upper left neighbours."""
    p = np.pad(mask, ((1, 0), (1, 0)))
    return p[1:, 1:] | p[:-1, 1:] | p[1:, :-1] | p[:-1, :-1]


def components(mask: np.ndarray) -> np.ndarray:
    """Numbers from 1 of the eight-connected components, 0 outside; runs of a row are united with those they touch above."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    parent = np.arange(len(row))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first = np.searchsorted(row, np.arange(h + 1))
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if begin[i] <= end[j] and begin[j] <= end[i]:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
            if end[i] < end[j]:
                i += 1
            else:
                j += 1
    roots = np.array([root(i) for i in range(len(row))], np.int64)
    number = np.unique(roots, return_inverse=True)[1] + 1
    out = np.zeros((h, w), np.int32)
    for y, a, b, k in zip(row, begin, end, number, strict=True):
        out[y, a:b] = k
    return out


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, in order."""
    p = np.unique(np.asarray(points, np.float64).reshape(-1, 2), axis=0)
    if len(p) < 3:
        return p

    def half(seq):
        out: list[np.ndarray] = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def min_area_rect(points: np.ndarray) -> tuple[np.ndarray, tuple[float, float], float]:
    """The smallest rectangle around points: corners, sides, and the angle of a side in (0, 90] degrees.

    One side lies on an edge of the hull; the first of equal ones wins.
    """
    k = hull(points)
    if len(k) == 1:
        return np.repeat(k, 4, axis=0), (0.0, 0.0), 90.0
    edges = np.roll(k, -1, axis=0) - k
    u = edges / np.hypot(edges[:, 0], edges[:, 1])[:, None]
    v = np.stack([-u[:, 1], u[:, 0]], 1)
    a, b = k @ u.T, k @ v.T
    w, h = np.ptp(a, axis=0), np.ptp(b, axis=0)
    i = int(np.argmin(np.round(w * h, 9)))
    lo, hi, bot, top = a[:, i].min(), a[:, i].max(), b[:, i].min(), b[:, i].max()
    corners = np.array([x * u[i] + y * v[i] for x, y in ((lo, bot), (hi, bot), (hi, top), (lo, top))])
    angle = float(np.degrees(np.arctan2(u[i, 1], u[i, 0])) % 90)
    return corners, (float(w[i]), float(h[i])), angle if angle > 1e-9 else 90.0


def mini_box(points: np.ndarray) -> tuple[np.ndarray, float]:
    """Corners of the smallest rectangle (top left, top right, bottom right, bottom left; left and right pair by x, each by y) and its short side."""
    corners, sides, _ = min_area_rect(points)
    by_x = corners[np.argsort(corners[:, 0], kind="stable")]
    left, right = (p[np.argsort(p[:, 1], kind="stable")] for p in (by_x[:2], by_x[2:]))
    return np.array([left[0], right[0], right[1], left[1]]), min(sides)


def corners_by_height(quad: np.ndarray) -> np.ndarray:
    """Four points as top left, top right, bottom right, bottom left, both sides ordered by y."""
    by_x = np.asarray(quad, np.float64)[np.argsort(np.asarray(quad)[:, 0], kind="stable")]
    left, right = (p[np.argsort(p[:, 1], kind="stable")] for p in (by_x[:2], by_x[2:]))
    return np.array([left[0], right[0], right[1], left[1]])


def deskew(points: np.ndarray) -> float:
    """Degrees by which a page is turned to lay a line level: the smaller turn, within 45 degrees."""
    angle = min_area_rect(points)[2]
    return 90 - angle if angle > 45 else -angle


def inside(points: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether grid places are within a polygon (even-odd) or on its outline."""
    p = np.asarray(points, np.float64)
    q = np.roll(p, -1, axis=0)
    odd, on = np.zeros(x.shape, bool), np.zeros(x.shape, bool)
    for (ax, ay), (bx, by) in zip(p, q, strict=True):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        on |= (cross == 0) & (x >= min(ax, bx)) & (x <= max(ax, bx)) & (y >= min(ay, by)) & (y <= max(ay, by))
        odd ^= ((ay > y) != (by > y)) & ((cross > 0) == (by > ay))
    return odd | on


def contour_score(prob: np.ndarray, points: np.ndarray) -> float:
    """Mean probability within an outline, clipped to the map."""
    p = np.asarray(points, np.int64)
    h, w = prob.shape
    x0, x1 = np.clip([p[:, 0].min(), p[:, 0].max()], 0, w - 1)
    y0, y1 = np.clip([p[:, 1].min(), p[:, 1].max()], 0, h - 1)
    y, x = np.mgrid[y0 : y1 + 1, x0 : x1 + 1]
    m = inside(p, x, y)
    return float(prob[y0 : y1 + 1, x0 : x1 + 1][m].mean()) if m.any() else 0.0


def area(points: np.ndarray) -> float:
    p = np.asarray(points, np.float64)
    q = np.roll(p, -1, axis=0)
    return float(abs((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum()) / 2)


def perimeter(points: np.ndarray) -> float:
    p = np.asarray(points, np.float64)
    return float(np.hypot(*(np.roll(p, -1, axis=0) - p).T).sum())


_AROUND = [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]


def outline(mask: np.ndarray) -> np.ndarray:
    """The outer outline of a mask's only component, from its first pixel, without the inner points of straight runs."""
    y, x = np.nonzero(mask)
    if not len(x):
        return np.zeros((0, 2), np.int64)
    p = np.pad(mask, 1)
    start = at = (int(x[0]) + 1, int(y[0]) + 1)
    out, facing, first = [at], 0, None
    while True:
        for k in range(8):
            d = (facing + 5 + k) % 8
            step = at[0] + _AROUND[d][0], at[1] + _AROUND[d][1]
            if p[step[1], step[0]]:
                break
        else:
            break  # a single pixel
        if at == start and first == d:
            break
        first = d if first is None else first
        at, facing = step, d
        out.append(at)
    pts = np.array(out[:-1] if len(out) > 1 else out) - 1
    if len(pts) < 3:
        return pts
    before, after = pts - np.roll(pts, 1, axis=0), np.roll(pts, -1, axis=0) - pts
    return pts[(before != after).any(1)]


def grow(points: np.ndarray, distance: float) -> np.ndarray:
    """The outline of all pixels within ``distance`` of a polygon: round at the corners, and one piece, as what it grows from is."""
    p = np.asarray(points, np.float64)
    pad = int(np.ceil(distance)) + 1
    x0, y0 = np.floor(p.min(0)).astype(int) - pad
    x1, y1 = np.ceil(p.max(0)).astype(int) + pad
    y, x = np.mgrid[y0 : y1 + 1, x0 : x1 + 1].astype(np.float64)
    near = np.full(x.shape, np.inf)
    for (ax, ay), (bx, by) in zip(p, np.roll(p, -1, axis=0), strict=True):
        dx, dy = bx - ax, by - ay
        t = np.clip(((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy or 1.0), 0, 1)
        near = np.minimum(near, np.hypot(x - ax - t * dx, y - ay - t * dy))
    return outline((near <= distance) | inside(p, x, y)) + [x0, y0]


def unclip(points: np.ndarray, ratio: float = 1.6, is_outline: bool = False) -> np.ndarray:
    """A polygon grown by area x ratio / perimeter, outlines by ``OUTLINE`` times that."""
    length = perimeter(points)
    return grow(points, area(points) * ratio / length * (OUTLINE if is_outline else 1.0)) if length else np.asarray(points)


def to_destination(points: np.ndarray, size: tuple[int, int], dest: tuple[int, int]) -> np.ndarray:
    """Points of a map as whole points of a page: half-even rounding, clipped to the last pixel."""
    scaled = np.round(np.asarray(points, np.float64) / size * dest)
    return np.clip(scaled, 0, np.array(dest) - 1).astype(np.int64)


def detect(prob: np.ndarray, dest: tuple[int, int] | None = None, thresh: float = 0.3, box: float = 0.4, ratio: float = 1.6, raw: bool = True, use_dilation: bool = False, most: int = 1000, least: float = 3.0) -> list[tuple[list[tuple[int, int]], float]]:
    """Polygons and scores of the text lines of a probability map.

    Outer outlines of components, the first ``most`` in reading order; those
    too narrow, too unsure, or too narrow when grown are left out; ``raw``
    keeps outlines, else smallest rectangles come out.
    """
    mask = binarise(prob, thresh)
    number = components(dilate(mask) if use_dilation else mask)
    size, out = (prob.shape[1], prob.shape[0]), []
    for k in range(1, min(int(number.max(initial=0)), most) + 1):
        contour = outline(number == k)
        rect, short = mini_box(contour)
        if short < least:
            continue
        score = contour_score(prob, contour)
        if score < box:
            continue
        grown = unclip(contour if raw else rect, ratio, raw)
        rect, short = mini_box(grown)
        if short < least + 2:
            continue
        points = to_destination(grown if raw else rect, size, dest or size)
        out.append(([(int(x), int(y)) for x, y in points], score))
    return out


def normalise(img: np.ndarray) -> np.ndarray:
    """Channels first, scaled to 0..1, with the models' mean and deviation taken out."""
    return ((img / 255.0 - MEAN) / STD).transpose(2, 0, 1).astype(np.float32)


def resize(img: np.ndarray, w: int, h: int) -> np.ndarray:
    """Bilinear resampling at pixel centres."""
    def places(n: int, m: int):
        x = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        i = np.floor(x).astype(int)
        return i, np.minimum(i + 1, n - 1), x - i

    (a, b, s), (c, d, t) = places(img.shape[0], h), places(img.shape[1], w)
    rows = img[a] * (1 - s)[:, None, None] + img[b] * s[:, None, None]
    return rows[:, c] * (1 - t)[None, :, None] + rows[:, d] * t[None, :, None]


def line_width(w: int, h: int, height: int = 48, least: int = 32, most: int = 1024) -> int:
    return min(max(-(-int(height * w / h) // 10) * 10, least), most)


def line_batch(images: list[np.ndarray], height: int = 48, least: int = 32, most: int = 1024) -> np.ndarray:
    """Line pictures as one tensor: fixed height, channels first, scaled to 0..1, zeros to the right up to the widest."""
    done = [resize(i, line_width(i.shape[1], i.shape[0], height, least, most), height).transpose(2, 0, 1) / 255 for i in images]
    out = np.zeros((len(done), done[0].shape[0], height, max(d.shape[2] for d in done)), np.float32)
    for k, d in enumerate(done):
        out[k, :, :, : d.shape[2]] = d
    return out


def upright(img: np.ndarray) -> np.ndarray:
    """A crop far higher than wide, turned by 90 degrees; others as they are."""
    h, w = img.shape[:2]
    return np.rot90(img) if min(h, w) > 10 and h > 4 * w else img


def laplacian_variance(img: np.ndarray) -> float:
    """Variance of the second difference over all pixels and channels, edges mirrored: low for blurred pictures."""
    p = np.pad(img.astype(np.float64), ((1, 1), (1, 1), *[(0, 0)] * (img.ndim - 2)), mode="reflect")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def canvas(w: int, h: int, angle: float) -> tuple[int, int]:
    """Size of a page turned by ``angle`` degrees."""
    c, s = abs(np.cos(np.radians(angle))), abs(np.sin(np.radians(angle)))
    return int(h * s + w * c), int(h * c + w * s)


def turn(points, angle: float, size: tuple[int, int], offset: tuple[float, float] = (0, 0)) -> list[tuple[int, int]]:
    """Points turned about the whole-number centre of a page of ``size``, less an offset, truncated; fewer than three points give their box."""
    p = np.asarray(points, np.float64)
    if len(p) < 3:
        (x0, y0), (x1, y1) = p.min(0), p.max(0)
        p = np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
    c, s = np.cos(np.radians(angle)), np.sin(np.radians(angle))
    q = p - (size[0] // 2, size[1] // 2)
    out = np.stack([q[:, 0] * c - q[:, 1] * s, q[:, 0] * s + q[:, 1] * c], 1) + (size[0] // 2, size[1] // 2) - offset
    return [(int(x), int(y)) for x, y in np.round(out, 9)]


#: Padding of a line's crop: left and right in widths, above in heights, and below for low, middle and high lines.
LIVE, TOOL = (0.01, 4 * 0.01, 0.1 * 0.08, (0.3, 0.2, 0.12)), (0.0005, 2 * 0.0005, 0.1, (0.28, 0.17, 0.15))


def line_crop(points, size: tuple[int, int], rule: tuple = LIVE, before: float = 0.0) -> tuple[float, tuple[int, int], tuple[int, int, int, int]] | None:
    """Turn, canvas and box of a line's crop on the turned page; null for a crop without extent.

    ``before``: a turn of the page that comes first.
    """
    for angle in [before, None] if before else [None]:
        angle = deskew(points) if angle is None else angle
        new = canvas(*size, angle)
        page = turn([(0, 0), (size[0], 0), size, (0, size[1])], angle, new)
        corner = min(x for x, _ in page), min(y for _, y in page)
        points, size = turn(points, angle, new, corner), new
    (x1, y1), (x2, y2) = np.min(points, 0), np.max(points, 0)
    w, h = x2 - x1, y2 - y1
    left, right, above, below = rule
    low = below[0] if h < 25 else below[2] if h > 100 else below[1]
    box = max(0, int(x1 - left * w)), max(0, int(y1 - above * h)), min(size[0], int(x2 + right * w)), min(size[1], int(y2 + low * h))
    return (angle, size, box) if box[2] > box[0] and box[3] > box[1] else None
