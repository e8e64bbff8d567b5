"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def backfill_days(df: DataFrame, last_day: Column, days: int) -> DataFrame:
    """One row per calendar day, ``days`` of them up to ``last_day``: y, m, d and yyyy-MM-dd."""
    last = last_day.cast("date")
    every = F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("_day")
    day = F.col("_day")
    return (
        df.select("*", every)
        .withColumns({"y": F.year(day), "m": F.month(day), "d": F.day(day), "day": F.date_format(day, "yyyy-MM-dd")})
        .drop("_day")
    )
