"""Annotation review: signals of polygons, priorities, overlap of instances, summaries."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions import geometry as g

#: Signals of the review.
UNVERIFIED, TRIANGULAR, MULTISIDED, CONCAVE = "UNVERIFIED_HUMAN_ANNOTATION", "TRIANGULAR_VISIBLE_REGION_REVIEW", "MULTISIDED_VISIBLE_REGION_REVIEW", "CONCAVE_VISIBLE_REGION_REVIEW"
FRAME, DUPLICATE_VERTEX, SELF_INTERSECTION, OUT_OF_BOUNDS = "FRAME_BOUNDARY_TRUNCATION_REVIEW", "DUPLICATE_VERTEX", "SELF_INTERSECTION", "OUT_OF_BOUNDS_VERTEX"
SMALL, CLASS, MISSING = "VERY_SMALL_MASK_REVIEW", "UNEXPECTED_CLASS", "MISSING_SOURCE_IMAGE"
DUPLICATE, OVERLAP = "LIKELY_DUPLICATE_INSTANCE", "POLYGON_OVERLAP_REVIEW"

#: The issue and the decision that each rung of the ladder asks for.
GUIDANCE = {
    "missing": ("P0", "The source image is missing, so the mask can't be judged.", "Restore the source image, then review."),
    "structure": ("P1", "The polygon's structure may be invalid.", "Check the vertices and mend repeated or crossing ones."),
    "small": ("P1", "The mask is unusually small.", "Decide whether there is a region that can be told apart."),
    "overlap": ("P1", "Two masks overlap much, or stand for one object.", "Review both; keep both only if they are apart."),
    "shape": ("P2", "The shape, or its cut at the frame, must be judged.", "Confirm that the polygon follows what is visible only."),
    "other": ("P3", "The polygon hasn't been confirmed yet.", "Check coverage, borders and precision."),
}


def signals(points: Column, width: Column, height: Column, label: Column, target: str, tolerance: float, small_ratio: float, accepted: bool = False) -> Column:
    """The signals of one polygon, in their fixed order."""
    n = F.size(points)
    found = [
        F.lit(None if accepted else UNVERIFIED).cast("string"),
        F.when(n == 3, TRIANGULAR).when(n > 4, MULTISIDED),
        F.when(g.is_concave(points), CONCAVE),
        F.when(g.touches_frame(points, width, height, tolerance), FRAME),
        F.when(g.has_duplicate_vertices(points), DUPLICATE_VERTEX),
        F.when(g.is_self_intersecting(points), SELF_INTERSECTION),
        F.when(g.has_out_of_bounds_vertex(points, width, height), OUT_OF_BOUNDS),
        F.when(g.area(points) / (width * height) < small_ratio, SMALL),
        F.when(label != target, CLASS),
    ]
    return F.array_compact(F.array(*found))


def rung(found: Column) -> Column:
    """The first rung of the ladder that a polygon's signals reach."""
    has = lambda *names: F.arrays_overlap(found, F.array(*map(F.lit, names)))
    paired = F.exists(found, lambda s: s.startswith(DUPLICATE) | s.startswith(OVERLAP))
    return (
        F.when(has(MISSING), "missing")
        .when(has(SELF_INTERSECTION, DUPLICATE_VERTEX, OUT_OF_BOUNDS), "structure")
        .when(has(SMALL), "small")
        .when(paired, "overlap")
        .when(has(TRIANGULAR, MULTISIDED, CONCAVE, FRAME), "shape")
        .otherwise("other")
    )


def guidance(found: Column, texts: dict[str, tuple[str, str, str]] | None = None) -> Column:
    """(priority, issue, decision) of a polygon's signals."""
    texts = texts or GUIDANCE
    at = rung(found)
    pick = lambda i: F.create_map(*[F.lit(x) for k, v in texts.items() for x in (k, v[i])])[at]
    return F.struct(pick(0).alias("priority"), pick(1).alias("issue"), pick(2).alias("decision"))


def image_decision(source_exists: Column, instances: Column) -> Column:
    return F.when(~source_exists, "RESTORE_SOURCE").when(instances == 0, "CONFIRM_EMPTY").otherwise("REVIEW_INSTANCES")


def signal_counts(polygons: DataFrame, signals_col: str, order: str) -> DataFrame:
    """(signal, n) by count; of equal counts, the signal that is seen first (by `order` and place) comes first."""
    # the outer form, as Spark puts a filter on the array's size before the plain one, and so evaluates the signals twice
    rows = polygons.select(F.col(order).alias("o"), F.posexplode_outer(signals_col).alias("i", "signal")).where("signal IS NOT NULL")
    counts = rows.groupBy("signal").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("o", "i")).alias("seen"))
    return counts.orderBy(F.desc("n"), "seen").select("signal", "n")


def fill_polygon(points: np.ndarray, width: int, height: int) -> np.ndarray:
    """A boolean mask of a polygon with integer vertices: interior by even-odd scan lines, and its outline."""
    mask = np.zeros((height, width), bool)
    x0, y0 = points[:, 0].astype(float), points[:, 1].astype(float)
    x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
    for y in range(max(0, int(y0.min())), min(height - 1, int(y0.max())) + 1):
        cut = (np.minimum(y0, y1) <= y) & (y < np.maximum(y0, y1))
        xs = np.sort(x0[cut] + (y - y0[cut]) * (x1[cut] - x0[cut]) / (y1[cut] - y0[cut]))
        for a, b in zip(xs[::2], xs[1::2], strict=False):
            mask[y, max(0, int(np.ceil(a))) : max(0, int(np.floor(b)) + 1)] = True
    for a, b, c, d in zip(x0, y0, x1, y1, strict=True):
        n = int(max(abs(c - a), abs(d - b))) + 1
        xs, ys = np.rint(np.linspace(a, c, n)).astype(int), np.rint(np.linspace(b, d, n)).astype(int)
        inside = (xs >= 0) & (xs < width) & (ys >= 0) & (ys < height)
        mask[ys[inside], xs[inside]] = True
    return mask


def overlap_signals(polygons: DataFrame, scale: float = 0.25, overlap: float = 0.5, duplicate: float = 0.85) -> DataFrame:
    """(image_id, instance_index, signals) of instances that overlap another of their image on a scaled raster.

    polygons: image_id, instance_index, width, height, points. An image's polygons are rasterised
    together, one at a time against those whose boxes meet it.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("instance_index")
        width, height = (max(1, round(float(rows[c].iloc[0]) * scale)) for c in ("width", "height"))
        shapes, found = [], {int(i): [] for i in rows["instance_index"]}
        for index, points in zip(rows["instance_index"], rows["points"], strict=True):
            p = np.rint(np.array([[q["x"], q["y"]] for q in points], np.float32).reshape(-1, 2) * scale).astype(int)
            mask = fill_polygon(p, width, height) if len(p) else np.zeros((height, width), bool)
            shapes.append((int(index), mask, int(mask.sum()), p.min(0) if len(p) else None, p.max(0) if len(p) else None))
        for i, (left, a, na, alo, ahi) in enumerate(shapes):
            for right, b, nb, blo, bhi in shapes[i + 1 :]:
                if alo is None or blo is None or (alo > bhi).any() or (blo > ahi).any() or not (both := int((a & b).sum())):
                    continue
                kind = DUPLICATE if both / (na + nb - both) >= duplicate else OVERLAP if both / min(na, nb) >= overlap else None
                if kind:
                    found[left].append(f"{kind}:{right}")
                    found[right].append(f"{kind}:{left}")
        return pd.DataFrame([(key[0], i, s) for i, s in found.items() if s], columns=["image_id", "instance_index", "signals"])

    return polygons.select("image_id", "instance_index", "width", "height", "points").groupBy("image_id").applyInPandas(run, "image_id long, instance_index int, signals array<string>")


def merge_signals(own: Column, paired: Column, source_exists: Column) -> Column:
    """All signals of an instance, sorted and distinct."""
    missing = F.when(~source_exists, F.array(F.lit(MISSING))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(own, F.coalesce(paired, F.array().cast("array<string>")), missing)))


def pages(df: DataFrame, order: list[str], size: int, keys: list[str]) -> DataFrame:
    """df with `number` (1-based within keys) and `page` of `size` rows."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("number", number).withColumn("page", F.floor((F.col("number") - 1) / size) + 1)


