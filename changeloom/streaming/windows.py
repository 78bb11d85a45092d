"""Analytics over a stream of changes, by the time of their commits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changes_per_window(changes: DataFrame, time: str, by: list[str], width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """n changes in each tumbling or sliding window; changes later than late are dropped, and so is their state."""
    return changes.withWatermark(time, late).groupBy(F.window(time, width, slide).alias("window"), *by).agg(F.count("*").alias("n"))


def sessions(changes: DataFrame, time: str, by: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """n changes in each session, which ends after a gap without any."""
    return changes.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("window"), *by).agg(F.count("*").alias("n"))


def once_each(records: DataFrame, time: str, key: list[str], late: str = "1 hour") -> DataFrame:
    """Records whose key hasn't come within the watermark: a producer's repeats go."""
    return records.withWatermark(time, late).dropDuplicatesWithinWatermark(key)
