"""Profile windows over a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from sentrail.operators.profiles import windowed_profiles


def stream_profiles(
    events: DataFrame, ts: str, keys: Sequence[str], length: str, aggregates: Mapping[str, Column], delay: str = "1 hour"
) -> DataFrame:
    """Tumbling-window profiles of a stream. A window is emitted once the watermark, ``delay``
    behind the latest event, has passed its end; events later than that are dropped."""
    return windowed_profiles(events.withWatermark(ts, delay), ts, keys, length, aggregates)
