"""Gates: each is a frame of violations, and passes if that is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(ValueError):
    """Rows that break a gate."""


def assert_empty(violations: DataFrame, gate: str, show: int = 5) -> None:
    if rows := violations.limit(show).collect():
        raise GateError(f"{gate}: " + "; ".join(str(r.asDict()) for r in rows))


def missing_in(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Keys of left without a row in right."""
    return left.select(on).distinct().join(right.select(on).distinct(), on, "left_anti")


def unequal_names(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """(name, in_left, in_right) of names that only one side has."""
    a = left.select(F.col(on).alias("name")).distinct().withColumn("in_left", F.lit(True))
    b = right.select(F.col(on).alias("name")).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, "name", "full_outer").na.fill(False, ["in_left", "in_right"])
    return both.where("NOT (in_left AND in_right)")


def repeated_names(df: DataFrame, on: str) -> DataFrame:
    return df.groupBy(on).count().where("count > 1").select(on, F.col("count").alias("n"))


def hash_mismatches(expected: DataFrame, actual: DataFrame, on: str, hash_col: str) -> DataFrame:
    both = expected.select(on, F.col(hash_col).alias("expected")).join(actual.select(on, F.col(hash_col).alias("actual")), on)
    return both.where("expected <> actual")


def not_one_to_one(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """(key, n): keys of left that right doesn't have exactly once."""
    n = left.select(on).distinct().join(right.groupBy(on).count(), on, "left").select(on, F.coalesce("count", F.lit(0)).alias("n"))
    return n.where("n <> 1")


def unexpected_labels(df: DataFrame, label_col: str, allowed: set[str]) -> DataFrame:
    """Labels that are found but not allowed, or allowed but not found."""
    found = df.select(F.col(label_col).alias("label")).distinct().withColumn("found", F.lit(True))
    known = df.sparkSession.createDataFrame([(x,) for x in sorted(allowed)], "label string").withColumn("allowed", F.lit(True))
    both = found.join(F.broadcast(known), "label", "full_outer").na.fill(False, ["found", "allowed"])
    return both.where("found <> allowed")


def unequal_sums(left: DataFrame, right: DataFrame, value: Column) -> DataFrame:
    """One row (left, right) if a total isn't preserved, else none."""
    a, b = left.agg(F.coalesce(F.sum(value), F.lit(0)).alias("left")), right.agg(F.coalesce(F.sum(value), F.lit(0)).alias("right"))
    return a.join(b, F.col("left") != F.col("right"))


def policy_violations(config: dict, required: dict) -> list[str]:
    """Settings of a run that differ from the required ones."""
    return [f"{k}: {config.get(k)!r}, not {v!r}" for k, v in required.items() if config.get(k) != v]


def selection_violations(selected: DataFrame, inventory: DataFrame, cache: DataFrame, holdout_groups: DataFrame, size: int) -> DataFrame:
    """(gate, name) of whatever forbids a selection: a name that is not in the inventory or not
    UNLABELED there, a group of the candidate cache that is held out, another number than `size`.

    selected has (name), inventory (name, status), cache (name, group), holdout_groups (group).
    """
    gate = lambda name, df: df.select(F.lit(name).alias("gate"), F.col(df.columns[0]).cast("string").alias("name"))
    known = selected.join(inventory, "name", "left")
    count = selected.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != size)
    return (
        gate("not_unlabeled", known.where(~F.coalesce(F.col("status") == "UNLABELED", F.lit(False))).select("name"))
        .unionByName(gate("holdout_in_cache", cache.join(holdout_groups.distinct(), "group", "left_semi").select("name")))
        .unionByName(gate("not_the_number", count))
    )


def tallies(rows: DataFrame, method: str, expected: list[str]) -> DataFrame:
    """(method, n): how often each method was used, 0 for expected ones that weren't."""
    known = rows.sparkSession.createDataFrame([(m,) for m in expected], f"{method} string")
    counts = rows.where(F.col(method).isNotNull()).groupBy(method).agg(F.count(F.lit(1)).alias("n"))
    return known.distinct().join(counts, method, "full").select(method, F.coalesce("n", F.lit(0)).alias("n"))


def package_report(expected: DataFrame, actual: DataFrame, key: str, hash_col: str) -> DataFrame:
    """One row: files expected and found, missing, unexpected and changed ones, and whether all is well."""
    both = expected.select(key, F.col(hash_col).alias("_e"), F.lit(True).alias("_left")).join(actual.select(key, F.col(hash_col).alias("_a"), F.lit(True).alias("_right")), key, "full")
    counts = both.agg(
        F.count_if(F.col("_left")).alias("n_expected"),
        F.count_if(F.col("_right")).alias("n_found"),
        F.count_if(F.col("_right").isNull()).alias("n_missing"),
        F.count_if(F.col("_left").isNull()).alias("n_unexpected"),
        F.count_if(F.col("_left") & F.col("_right") & ~F.col("_e").eqNullSafe(F.col("_a"))).alias("n_changed"),
    )
    return counts.withColumn("ok", F.expr("n_missing + n_unexpected + n_changed = 0"))


def group_flags(items: DataFrame, group: str, accepted: Column) -> DataFrame:
    """(group, size, any_accepted) of each group."""
    return items.groupBy(group).agg(F.count(F.lit(1)).alias("size"), F.coalesce(F.bool_or(accepted), F.lit(False)).alias("any_accepted"))
