"""Leakage-safe splits of groups, and their extension without disturbing holdouts."""

from __future__ import annotations

import heapq
import random
from array import array
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.ranks import numbered
from sievework.functions.scratch import Scratch

#: Groups whose splits are sent back to Spark at once.
SENT = 1_000_000


def _choices(sizes: Sequence[int], ratios: dict[str, float], seed: int) -> bytearray:
    """For each group its split, as a number: groups ask for a place from the largest on, equal ones
    in an order drawn with the seed, and the split with the largest unmet share of its target takes each.
    """
    drawn = array("q", range(len(sizes)))
    random.Random(seed).shuffle(drawn)
    everything, out = sum(sizes), bytearray(len(sizes))
    goals = [everything * r for r in ratios.values()]
    unmet = [(-goal / max(goal, 1.0), k, 0) for k, goal in enumerate(goals)]
    heapq.heapify(unmet)
    for group in sorted(drawn, key=lambda g: -sizes[g]):
        _, k, held = unmet[0]
        out[group] = k
        held += sizes[group]
        heapq.heapreplace(unmet, (-(goals[k] - held) / max(goals[k], 1.0), k, held))
    return out


def assign_groups(sizes: dict[str, int], ratios: dict[str, float], seed: int) -> dict[str, str]:
    """Each group's split; `sizes` is in order of first appearance, and ties go to the split that `ratios` names first."""
    names = list(ratios)
    return {group: names[k] for group, k in zip(sizes, _choices(list(sizes.values()), ratios, seed), strict=True)}


def split_groups(items: DataFrame, group_col: str, ratios: dict[str, float], seed: int) -> DataFrame:
    """(group, split) for every group, taken in order of its name.

    Sizes are aggregated and numbered by Spark. One choice depends on all before, so the driver
    makes them: it holds 17 bytes for each group (its size, its place in the draw, its split), no names.
    """
    spark, names = items.sparkSession, list(ratios)
    scratch = Scratch(spark, "splits")
    sizes = items.where(F.col(group_col).isNotNull()).groupBy(group_col).agg(F.count(F.lit(1)).alias("size"))
    sizes = scratch.save(numbered(sizes, [group_col]), "sizes")
    choices = _choices(array("q", (r[0] for r in sizes.orderBy("number").select("size").toLocalIterator())), ratios, seed)
    path = f"{scratch.base}/choices"
    for at in range(0, len(choices) or 1, SENT):
        part = [(at + n, names[k]) for n, k in enumerate(choices[at : at + SENT])]
        spark.createDataFrame(part, "number long, split string").write.mode("append").parquet(path)
    return sizes.join(spark.read.schema("number long, split string").parquet(path), "number").select(group_col, "split")


def leaking_groups(rows: DataFrame, group_col: str, split_col: str) -> DataFrame:
    """(left, right, group): groups found in two splits, left < right."""
    pairs = rows.where(F.col(group_col).isNotNull()).select(F.col(group_col).alias("group"), F.col(split_col).alias("split")).distinct()
    both = pairs.groupBy("group").agg(F.sort_array(F.collect_set("split")).alias("s")).where(F.size("s") > 1)  # as many as there are splits
    left = both.select("group", "s", F.posexplode("s").alias("i", "left"))
    return left.select("left", F.explode(F.slice("s", F.col("i") + 2, F.size("s"))).alias("right"), "group")


def default_split(split, readable):
    """An item's split: assigned, else unlabeled_pool if readable, else excluded_unreadable (fixed values)."""
    return F.coalesce(split, F.when(readable, "unlabeled_pool").otherwise("excluded_unreadable"))


def extend_manifest(base: DataFrame, new: DataFrame, new_split: str = "train") -> DataFrame:
    """The base rows (name, group, split) as they are, and the new rows (name, group) in one split."""
    return base.select("name", "group", "split").unionByName(new.select("name", "group", F.lit(new_split).alias("split")))


def manifest_violations(base: DataFrame, new: DataFrame, inventory: DataFrame, annotated: DataFrame, actual: DataFrame, holdouts: tuple[str, ...] = ("validation", "test")) -> DataFrame:
    """(gate, name) of whatever breaks a gate of an incremental manifest; none means it may be built.

    Names and groups are those of base (name, group, split) and new (name, group); inventory and
    actual have (name, sha256), annotated has (name).
    """
    every = base.select("name").unionByName(new.select("name")).distinct()
    gate = lambda name, df: df.select(F.lit(name).alias("gate"), F.col(df.columns[0]).cast("string").alias("name"))
    held = base.where(F.col("split").isin(*holdouts)).select("group").distinct()
    changed = inventory.join(actual.withColumnRenamed("sha256", "actual"), "name").join(every, "name", "left_semi").where("sha256 <> actual").select("name")
    return (
        gate("already_in_base", new.select("name").intersect(base.select("name")))
        .unionByName(gate("not_annotated", every.join(annotated, "name", "left_anti")))
        .unionByName(gate("not_in_inventory", every.join(inventory, "name", "left_anti")))
        .unionByName(gate("group_in_holdout", new.select("group").intersect(held)))
        .unionByName(gate("group_in_two_splits", leaking_groups(extend_manifest(base, new), "group", "split").select("group")))
        .unionByName(gate("content_changed", changed))
    )
