"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch


def _stars(pairs: DataFrame, scope: DataFrame, scratch: Scratch, name: str, rows: int) -> DataFrame:
    """Link every v of a pair (u, v) to the smallest of u and u's neighbours in scope.

    The minimum is pre-aggregated, written and joined back: between two plain tables, adaptive
    execution can split the rows of a vertex of high degree, so that no task gathers them.
    """
    least = scope.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(scratch.save(least, name, rows), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame, a: str, b: str, scratch: Scratch, label: str = "cc") -> DataFrame:
    """One row (node, component) for each end of an edge; component is the smallest node it reaches.

    Edges with a null end are ignored. Any orderable type serves as node. Each round is
    written to the shared folder, and the rounds before it are deleted.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    e = scratch.save(e.distinct(), f"{label}0")
    n, seen, k = e.count(), None, 0
    while True:
        flipped = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        both = e.unionByName(flipped)
        large = _stars(both.where("v > u"), both, scratch, f"{label}-large{k}", 2 * n).where("u <> v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        large = scratch.save(large, f"{label}-pairs{k}", 2 * n)
        small = _stars(large, large, scratch, f"{label}-small{k}", 2 * n)
        root = large.groupBy("u").agg(F.min("v").alias("v"))
        e2 = small.unionByName(root).where("u <> v").distinct()
        e2 = e2.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        e2 = scratch.save(e2, f"{label}{k + 1}", 2 * n)
        now = e2.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))).first()
        for name in (f"{label}{k}", f"{label}-large{k}", f"{label}-pairs{k}", f"{label}-small{k}"):
            scratch.drop(name)
        e, n, k = e2, now[0], k + 1
        if now == seen:
            break
        seen = now
    top = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return top.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
