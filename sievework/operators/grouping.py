"""Groups by time gaps and by links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.ranks import numbered as numbered_rows
from sievework.functions.scratch import Scratch
from sievework.operators.components import connected_components
from sievework.operators.dedup import members


def gap_islands(events: DataFrame, keys: list[str], ts: str, gap: str) -> DataFrame:
    """(keys, island_start, island_end, n): maximal runs in which each event follows within the gap (inclusive)."""
    w = F.session_window(ts, gap)
    return events.groupBy(*keys, w.alias("w")).agg(F.min(ts).alias("island_start"), F.max(ts).alias("island_end"), F.count(F.lit(1)).alias("n")).drop("w")


def chain_edges(items: DataFrame, id_col: str, ts: str, seconds: float, keys: list[str] | None = None) -> DataFrame:
    """(a, b): each item and the one before it in time, where they lie at most `seconds` apart.

    Without keys, items are numbered over range partitions, and meet by their numbers.
    """
    rows = items.where(F.col(ts).isNotNull())
    if keys:
        w = Window.partitionBy(*keys).orderBy(ts, id_col)
        before = rows.select(F.col(id_col).alias("b"), F.lag(id_col).over(w).alias("a"), F.col(ts).alias("t"), F.lag(ts).over(w).alias("p"))
    else:
        placed = numbered_rows(rows.select(F.col(id_col).alias("b"), F.col(ts).alias("t")), ["t", "b"])
        placed = Scratch(items.sparkSession, "chain").save(placed, "placed")
        before = placed.join(placed.select((F.col("number") + 1).alias("number"), F.col("b").alias("a"), F.col("t").alias("p")), "number")
    return before.where("a IS NOT NULL").where(F.expr("timestampdiff(MICROSECOND, p, t)") <= seconds * 1e6).select("a", "b")


def star_edges(items: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(a, b): the first item of each group of equal contents with each other one."""
    return members(items, id_col, hash_col).where(F.col(id_col) != F.col("first")).select(F.col("first").alias("a"), F.col(id_col).alias("b"))


def scene_edges(stars: DataFrame, near: DataFrame, chain: DataFrame) -> DataFrame:
    """(a, b, kind): the links of scenes by equal contents (a, b), near pairs (left, right) and time (a, b)."""
    kind = lambda df, a, b, name: df.select(F.col(a).alias("a"), F.col(b).alias("b"), F.lit(name).alias("kind"))
    return kind(stars, "a", "b", "exact").unionByName(kind(near, "left", "right", "near")).unionByName(kind(chain, "a", "b", "time"))


def numbered(components: DataFrame, prefix: str = "scene") -> DataFrame:
    """(component, group): components by their smallest member, as prefix-0001 and so on.

    Numbers are given within range partitions and shifted by the sizes of those before, so no
    task sees all components.
    """
    tops = components.select("component").distinct().repartitionByRange("component").sortWithinPartitions("component")
    tops = tops.select("component", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    tops = Scratch(components.sparkSession, "numbered").save(tops, "tops")
    sizes = tops.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("from"))
    shifts = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))  # one row a partition
    number = F.col("at") - F.col("from") + F.col("before") + 1
    return tops.join(F.broadcast(shifts.select("part", "from", "before")), "part").select("component", F.format_string(f"{prefix}-%04d", number).alias("group"))


def scene_groups(items: DataFrame, id_col: str, edges: DataFrame, prefix: str = "scene") -> DataFrame:
    """(id, component, group) of every item, items without a link included; edges have (a, b)."""
    scratch = Scratch(items.sparkSession, "groups")
    linked = connected_components(edges, "a", "b", scratch)
    named = items.select(F.col(id_col).alias("node")).distinct().join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = scratch.save(named, "named")
    return named.join(numbered(named, prefix), "component").select(F.col("node").alias(id_col), "component", "group")


