"""Streams of events: stability, windows, sessions, newest states."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stable_counts(events: DataFrame, time: str, kind: str, lateness: str = "10 minutes", length: str = "1 hour") -> DataFrame:
    """Counts by kind and tumbling window; what is later than ``lateness`` is left out."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, length), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def sessions(events: DataFrame, time: str, user: str, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Sessions of each user that a gap ends."""
    grouped = events.withWatermark(time, lateness).groupBy(F.session_window(time, gap), user).agg(F.count("*").alias("n"))
    return grouped.select(user, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def newest_states(key: str, order: str, target: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes the newest row of each key of a batch, once for each batch id."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rest = [c for c in batch.columns if c != key]
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, *[F.col("r")[c].alias(c) for c in rest])
        newest.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return run
