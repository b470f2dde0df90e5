"""Streaming extension: the batch gap islands, over an unbounded source with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_islands(events: DataFrame, keys: list[str], ts: str, gap: str, late: str) -> DataFrame:
    """Islands as operators.grouping.gap_islands gives them, once no event within `late` can extend them."""
    w = F.session_window(ts, gap)
    rows = events.withWatermark(ts, late).groupBy(*keys, w.alias("w"))
    return rows.agg(F.min(ts).alias("island_start"), F.max(ts).alias("island_end"), F.count(F.lit(1)).alias("n")).drop("w")


def stream_new_contents(items: DataFrame, hash_col: str, ts: str, late: str) -> DataFrame:
    """The first item of each content within the watermark."""
    return items.withWatermark(ts, late).dropDuplicatesWithinWatermark([hash_col])
