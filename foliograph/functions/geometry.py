"""Geometry of boxes and polygons, and the sizes that image steps use; expressions in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def rectangle(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Corners of a rectangle, clockwise from the top left."""
    return F.array(point(x, y), point(x + w, y), point(x + w, y + h), point(x, y + h))


def bounds(poly: Column) -> Column:
    """The box of a polygon as x1, y1, x2, y2."""
    xs, ys = F.transform(poly, lambda p: p["x"]), F.transform(poly, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _edges(poly: Column, fn) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(poly)), lambda i: fn(F.element_at(poly, i), F.element_at(poly, (i % F.size(poly)) + 1)))


def area(poly: Column) -> Column:
    """Shoelace area; polygons of under three points have none."""
    twice = _sum(_edges(poly, lambda p, q: (p["x"] * q["y"] - q["x"] * p["y"]).cast("double")))
    return F.when(F.size(poly) < 3, F.lit(0.0)).otherwise(F.abs(twice) / 2)


def perimeter(poly: Column) -> Column:
    return _sum(_edges(poly, lambda p, q: F.sqrt(F.pow((p["x"] - q["x"]).cast("double"), F.lit(2.0)) + F.pow((p["y"] - q["y"]).cast("double"), F.lit(2.0)))))


def roundness(poly: Column) -> Column:
    """4 pi A / P^2; 0 for a polygon without extent."""
    p = perimeter(poly)
    return F.when(p == 0, F.lit(0.0)).otherwise(4 * F.pi() * area(poly) / (p * p))


def unclip_distance(poly: Column, ratio: float = 1.6) -> Column:
    """How far a detected polygon is grown: area * ratio / perimeter."""
    p = perimeter(poly)
    return F.when(p == 0, F.lit(0.0)).otherwise(area(poly) * ratio / p)


def rotate(poly: Column, angle: Column, width: Column, height: Column, off_x: Column | None = None, off_y: Column | None = None) -> Column:
    """Points turned by ``angle`` degrees about the whole-number centre, less the offsets, truncated to whole numbers."""
    c, s = F.cos(F.radians(angle)), F.sin(F.radians(angle))
    cx, cy = F.floor(width / 2), F.floor(height / 2)
    x0, y0 = (F.lit(0) if o is None else o for o in (off_x, off_y))
    return F.transform(poly, lambda p: point(((p["x"] - cx) * c - (p["y"] - cy) * s + cx - x0).cast("int"), ((p["x"] - cx) * s + (p["y"] - cy) * c + cy - y0).cast("int")))


def corners_by_height(quad: Column) -> Column:
    """Four points as top left, top right, bottom right, bottom left: left and right pair by x, each by y; null unless four points."""
    by_x = F.array_sort(F.transform(quad, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    by_y = lambda part: F.array_sort(F.transform(part, lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x"))))
    left, right = by_y(F.slice(by_x, 1, 2)), by_y(F.slice(by_x, 3, 2))
    at = lambda pair, k: point(F.get(pair, F.lit(k))["x"], F.get(pair, F.lit(k))["y"])
    return F.when(F.size(quad) == 4, F.array(at(left, 0), at(right, 0), at(right, 1), at(left, 1)))


def has_extent(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether a crop has height and width; what has none is left out before recognition."""
    return F.coalesce((x2 > x1) & (y2 > y1), F.lit(False))


def vote(poly: Column, angle: Column) -> Column:
    """The angle for which a line votes: none (0) if it is tiny or too round."""
    return F.when((area(poly) < 25) | (roundness(poly) >= 0.8), F.lit(0.0)).otherwise(angle)


def outline_distance(poly: Column, ratio: float = 1.6) -> Column:
    """How far an outline is grown: 1.45 times as far as a box."""
    return unclip_distance(poly, ratio) * 1.45


def repaired(poly: Column) -> Column:
    """A polygon of three points at least; fewer give the box around them."""
    b = bounds(poly)
    return F.when(F.size(poly) < 3, rectangle(b["x1"], b["y1"], b["x2"] - b["x1"], b["y2"] - b["y1"])).otherwise(poly)


def order_corners(quad: Column) -> Column:
    """Four points as top left, top right, bottom right, bottom left: the right point farthest from the top left is bottom right; null unless four points."""
    by_x = F.array_sort(F.transform(quad, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    left = F.array_sort(F.transform(F.slice(by_x, 1, 2), lambda p: F.struct(p["y"].alias("y"), p["x"].alias("x"))))
    tl, bl = F.get(left, F.lit(0)), F.get(left, F.lit(1))
    far = lambda p: F.pow((p["x"] - tl["x"]).cast("double"), F.lit(2.0)) + F.pow((p["y"] - tl["y"]).cast("double"), F.lit(2.0))
    r = F.slice(by_x, 3, 2)
    a, b = F.get(r, F.lit(0)), F.get(r, F.lit(1))
    first = far(a) > far(b)
    br, tr = F.when(first, a).otherwise(b), F.when(first, b).otherwise(a)
    at = lambda p: point(p["x"], p["y"])
    return F.when(F.size(quad) == 4, F.array(at(tl), at(tr), at(br), at(bl)))


def pad_line(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, fx: float = 0.01, fy: float = 0.08) -> Column:
    """The crop of a text line: little space to the left, more to the right and below, clipped to the page."""
    w, h = x2 - x1, y2 - y1
    below = F.when(h < 25, 0.3).when(h > 100, 0.12).otherwise(0.2)
    clip = lambda v, m: F.greatest(F.least(v.cast("int"), m), F.lit(0))
    return F.struct(
        clip(x1 - fx * w, width).alias("x1"), clip(y1 - 0.1 * fy * h, height).alias("y1"), clip(x2 + 4 * fx * w, width).alias("x2"), clip(y2 + below * h, height).alias("y2")
    )


def rescale(v: Column, size: Column, dest: Column) -> Column:
    """A coordinate in a picture of another size: half-even rounding, clipped to the last pixel."""
    return F.greatest(F.least(F.bround(v / size * dest, 0), dest - 1), F.lit(0)).cast("int")


def scale_back(v: Column, ratio: Column) -> Column:
    """A coordinate of the resized page on the original page, truncated."""
    return (v * (1 / ratio)).cast("int")


def ocr_width(w: Column, h: Column, height: int = 48, least: int = 32, most: int = 1024) -> Column:
    """Width of a line picture of fixed height, up to the next ten, within limits; null without extent."""
    new = (F.try_divide(F.lit(height) * w, h)).cast("int")
    return F.least(F.greatest((F.ceil(new / 10) * 10).cast("int"), F.lit(least)), F.lit(most))


def line_width_64(w: Column, h: Column) -> Column:
    """Width for a picture of height 64: whole fours, four at least."""
    return F.greatest(((F.try_divide(w * 64, h) / 4).cast("int") * 4), F.lit(4))


def square_size(w: Column, h: Column, square: int = 1024, mag: float = 1.49) -> Column:
    """Scaled and padded size of a page for detection: longest side at most ``square``, padded to whole 32s."""
    longest = F.greatest(w, h)
    target = F.least((mag * longest).cast("int"), F.lit(square))
    ratio = target / longest
    sw, sh = (w * ratio).cast("int"), (h * ratio).cast("int")
    up = lambda v: (F.ceil(v / 32) * 32).cast("int")
    return F.struct(sw.alias("w"), sh.alias("h"), up(sw).alias("pw"), up(sh).alias("ph"))


def multiple_of_32(w: Column, h: Column, limit: int = 960, side: str = "max") -> Column:
    """Size with the longer ('max') or shorter ('min') side at ``limit``, both sides whole 32s; null if a side vanishes."""
    if side not in ("max", "min"):
        raise ValueError(f"unknown side {side!r}")
    ratio = limit / (F.greatest(w, h) if side == "max" else F.least(w, h))
    fit = lambda v: (F.bround((v * ratio).cast("int") / 32, 0) * 32).cast("int")
    rw, rh = fit(w), fit(h)
    return F.when((rw > 0) & (rh > 0), F.struct(rw.alias("w"), rh.alias("h")))


def shrink(w: Column, h: Column, most: int = 1024) -> Column:
    """Size with the longer side at most ``most``; never grows."""
    r = F.least(F.lit(1.0), most / F.greatest(w, h))
    return F.struct((w * r).cast("int").alias("w"), (h * r).cast("int").alias("h"))


def is_portrait(w: Column, h: Column) -> Column:
    """A crop to be turned by 90 degrees: more than four times as high as wide."""
    return (F.least(w, h) > 10) & (h > 4 * w)
