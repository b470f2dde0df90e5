"""Global row numbers and medians without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.scratch import Scratch


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """df with the place of each row in an order, from 0: numbers within range partitions, shifted by the rows of those before."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    rows = Scratch(df.sparkSession, "numbered").save(rows, "rows")
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    before = sizes.select("_part", "_from", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row for each partition
    return rows.join(F.broadcast(before), "_part").select(*df.columns, (F.col("_at") - F.col("_from") + F.col("_before")).alias(name))


def medians(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One row with the median of each of several values, null where there is none.

    Values are counted, the counts range-partitioned, and the middle is looked up in the
    partition that holds it.
    """
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(n).alias("of"), v.cast("double").alias("v")) for n, v in values.items()))).alias("x")).select("x.of", "x.v")
    counts = pairs.where("v IS NOT NULL").groupBy("of", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.repartitionByRange("of", "v").select("*", F.spark_partition_id().alias("part"))
    counts = Scratch(df.sparkSession, "medians").save(counts, "counts")
    parts = counts.groupBy("of", "part").agg(F.sum("n").alias("rows"))  # about a row for each partition
    own = Window.partitionBy("of")
    parts = parts.select("of", "part", (F.sum("rows").over(own.orderBy("part")) - F.col("rows")).alias("before"), F.sum("rows").over(own).alias("total"), "rows")
    low, high = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    parts = parts.where((F.col("before") <= high) & (F.col("before") + F.col("rows") > low)).drop("rows")
    near = counts.join(F.broadcast(parts), ["of", "part"])
    end = F.col("before") + F.sum("n").over(Window.partitionBy("of", "part").orderBy("v"))
    middle = near.withColumn("end", end).where((F.col("end") > low) & (F.col("end") - F.col("n") <= high))
    found = middle.groupBy("of").agg(((F.min("v") + F.max("v")) / 2).alias("median"))
    return found.agg(*(F.max(F.when(F.col("of") == n, F.col("median"))).alias(n) for n in values))
