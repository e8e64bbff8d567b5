"""Column expressions that turn raw numbers into scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def sed(features: Sequence[Column], centroids: Sequence[Sequence[float]]) -> Column:
    """Sum of the Euclidean distances from a point to every centroid.

    Written out as plain arithmetic on columns, which stays inside generated code.
    """

    def distance(centre: Sequence[float]) -> Column:
        squares = [(f - F.lit(float(c))) * (f - F.lit(float(c))) for f, c in zip(features, centre, strict=True)]
        return F.sqrt(reduce(lambda a, b: a + b, squares))

    return reduce(lambda a, b: a + b, [distance(centre) for centre in centroids])


def sed_array(features: Column, centroids: Column) -> Column:
    """Same for an array column against an array-of-arrays column (one centroid set per row)."""

    def distance(centre: Column) -> Column:
        squares = F.zip_with(features, centre, lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))

    return F.aggregate(centroids, F.lit(0.0), lambda acc, centre: acc + distance(centre))


def nearest_centroid(features: Sequence[Column], centroids: Sequence[Sequence[float]]) -> Column:
    """Number of the centroid closest to the features; of equally close ones the first."""
    squared = [sum(((f - F.lit(float(c))) * (f - F.lit(float(c))) for f, c in zip(features, centre, strict=True)), F.lit(0.0)) for centre in centroids]
    return F.array_position(F.array(*squared), F.array_min(F.array(*squared))).cast("int") - 1


def minmax(value: Column, low: Column, high: Column, constant_value: float = 0.0) -> Column:
    """Scale to 0-100 by the fitted range and clamp. ``constant_value`` is the score where the
    fitted range is a single point (50 for the distance model, 0 for the others)."""
    # the span divides first: this is the order the fitted scalers use
    span = high - low
    scaled = F.when(span == 0, F.lit(float(constant_value))).otherwise((value - low) / span * 100.0)
    return F.when(value.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled)))


def anomaly_label(score: Column, threshold: float = 60.0) -> Column:
    """1 above the threshold, 0 otherwise, null for a missing score."""
    return (score > F.lit(float(threshold))).cast("int")


def anomaly_level(score: Column, cuts: Sequence[float], names: Sequence[str]) -> Column:
    """The name of the interval a score falls in; ``cuts`` ascend and belong to the lower side."""
    if len(names) != len(cuts) + 1:
        raise ValueError("one more name than cut points is needed")
    level = F.lit(names[-1])
    for cut, name in reversed(list(zip(cuts, names))):
        level = F.when(score <= F.lit(float(cut)), F.lit(name)).otherwise(level)
    return F.when(score.isNotNull(), level)


def ensemble(scores: Sequence[Column], places: int = 4) -> Column:
    """Mean of the scores that are present; null when none is."""
    count = reduce(lambda a, b: a + b, [s.isNotNull().cast("int") for s in scores])
    total = reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0.0)) for s in scores])
    return F.when(count > 0, F.round(total / count, places))


def zscore(value: Column, mean: Column, sd: Column, places: int = 4) -> Column:
    """Rounded z-score; null where the deviation is zero or undefined."""
    return F.when(sd > 0, F.round((value - mean) / sd, places))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """part/whole in percent; null where the whole is zero."""
    return F.round(F.when(whole != 0, part.cast("double") / whole) * 100.0, places)


def guarded_percent(part: Column, whole: Column, places: int = 2) -> Column:
    """part/whole in percent; 0 where the whole is zero."""
    return F.when(whole == 0, 0.0).otherwise(percent(part, whole, places))


def weighted_sum(scores: Sequence[Column], weights: Sequence[float], places: int = 2) -> Column:
    """Weighted sum of the scores; null as soon as one is missing."""
    terms = [s * F.lit(float(w)) for s, w in zip(scores, weights, strict=True)]
    return F.round(reduce(lambda a, b: a + b, terms), places)
