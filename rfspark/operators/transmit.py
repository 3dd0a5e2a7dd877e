"""When each burst of a transmit stream starts and ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rfspark.operators.scan import DEFAULT_BLOCK, ordered_scan, peak, total_before
from rfspark.session import cut


def schedule_bursts(bursts: DataFrame, block=DEFAULT_BLOCK) -> DataFrame:
    """Start a burst when wanted, or right after the one before it.

    ``bursts`` have ``stream_id, seq, desired, duration, guard``: a burst may
    start one ``guard`` (a sample) after the previous end. With ``busy`` the time
    all earlier bursts take, a start is ``busy`` plus the largest ``desired -
    busy`` so far, so the recurrence becomes a running sum and a running maximum.
    """
    busy = ordered_scan(
        bursts, "stream_id", "seq", {"__busy": total_before(F.col("duration") + F.col("guard"))}, block
    )
    placed = ordered_scan(
        cut(busy, "bursts"), "stream_id", "seq", {"__slack": peak(F.col("desired") - F.col("__busy"))}, block
    )
    start = F.col("__busy") + F.col("__slack")
    return placed.withColumn("start", start).withColumn("end", start + F.col("duration")).drop("__busy", "__slack")


def with_range(bursts: DataFrame) -> DataFrame:
    """Frequency range of a burst: its centre, half the rate to each side."""
    half = F.col("rate_hz") / 2
    return bursts.withColumns({"start_hz": F.col("center_hz") - half, "end_hz": F.col("center_hz") + half})
