"""Polygon predicates over arrays of (x, y), all inside code generation or higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def _indices(points: Column) -> Column:
    return F.when(F.size(points) > 0, F.sequence(F.lit(0), F.size(points) - 1)).otherwise(F.array().cast("array<int>"))


def _at(points: Column, i: Column) -> Column:
    return F.get(points, F.pmod(i, F.size(points)))


def signed_area(points: Column) -> Column:
    """Shoelace formula; 0 for under three points."""
    cross = F.transform(_indices(points), lambda i: _at(points, i)["x"] * _at(points, i + 1)["y"] - _at(points, i + 1)["x"] * _at(points, i)["y"])
    return F.when(F.size(points) < 3, 0.0).otherwise(F.aggregate(cross, F.lit(0.0), lambda s, x: s + x) / 2)


def area(points: Column) -> Column:
    return F.abs(signed_area(points))


def orientation(a: Column, b: Column, c: Column) -> Column:
    cross = (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])
    return F.when(F.abs(cross) <= EPS, 0).when(cross > 0, 1).otherwise(-1)


def on_segment(a: Column, b: Column, p: Column) -> Column:
    """Whether p lies within the box of a and b (for collinear points: on the segment)."""
    inside = lambda k: (p[k] >= F.least(a[k], b[k]) - EPS) & (p[k] <= F.greatest(a[k], b[k]) + EPS)
    return inside("x") & inside("y")


def segments_intersect(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Crossing or touching, collinear overlap included."""
    o1, o2, o3, o4 = orientation(a, b, c), orientation(a, b, d), orientation(c, d, a), orientation(c, d, b)
    touch = ((o1 == 0) & on_segment(a, b, c)) | ((o2 == 0) & on_segment(a, b, d)) | ((o3 == 0) & on_segment(c, d, a)) | ((o4 == 0) & on_segment(c, d, b))
    return ((o1 != o2) & (o3 != o4)) | touch


def is_self_intersecting(points: Column) -> Column:
    """Whether two edges that aren't neighbours meet; false for under four points."""
    n = F.size(points)

    def meets(i: Column) -> Column:
        later = F.filter(_indices(points), lambda j: (j > i + 1) & ~((i == 0) & (j == n - 1)))
        return F.exists(later, lambda j: segments_intersect(_at(points, i), _at(points, i + 1), _at(points, j), _at(points, j + 1)))

    return (n >= 4) & F.exists(_indices(points), meets)


def is_concave(points: Column) -> Column:
    """Whether turns of both signs occur; false for under four points."""
    turns = F.transform(_indices(points), lambda i: orientation(_at(points, i - 1), _at(points, i), _at(points, i + 1)))
    return (F.size(points) >= 4) & F.array_contains(turns, 1) & F.array_contains(turns, -1)


def has_duplicate_vertices(points: Column, eps: float = 1e-6) -> Column:
    """Whether any two vertices lie within eps."""
    near = lambda p, q: F.hypot(p["x"] - q["x"], p["y"] - q["y"]) <= eps
    return F.exists(_indices(points), lambda i: F.exists(F.filter(_indices(points), lambda j: j < i), lambda j: near(F.get(points, i), F.get(points, j))))


def touches_frame(points: Column, width: Column, height: Column, tolerance: float) -> Column:
    return F.exists(points, lambda p: (p["x"] <= tolerance) | (p["y"] <= tolerance) | (p["x"] >= width - 1 - tolerance) | (p["y"] >= height - 1 - tolerance))


def has_out_of_bounds_vertex(points: Column, width: Column, height: Column, tolerance: float = 1e-6) -> Column:
    """Beyond the frame; its border is legal."""
    return F.exists(points, lambda p: (p["x"] < -tolerance) | (p["y"] < -tolerance) | (p["x"] > width + tolerance) | (p["y"] > height + tolerance))


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes (x1, y1, x2, y2); 0 where the union is empty."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    size = lambda r: F.greatest(F.lit(0.0), r["x2"] - r["x1"]) * F.greatest(F.lit(0.0), r["y2"] - r["y1"])
    union = size(a) + size(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)
