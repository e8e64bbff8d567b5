"""Numbers behind the usual exploratory plots, per group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrail.operators.grouped import join_small
from sentrail.operators.quantiles import exact_quantiles
from sentrail.session import materialise

# Bins of the histogram and of the density plot, whisker reach in quartile ranges.
HISTOGRAM_BINS = 20
DENSITY_BINS = 10
WHISKER_REACH = 1.5


def _grouped(df: DataFrame, group_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(group_cols)) if group_cols else (df.withColumn("_all", F.lit(0)), ["_all"])


def box_stats(df: DataFrame, column: str, group_cols: Sequence[str] = (), places: int = 6) -> DataFrame:
    """Quartiles, whiskers and outlier count. Whiskers are the outermost values within 1.5
    quartile ranges of the box and never lie inside it."""
    rows, group = _grouped(df, group_cols)
    q = F.col("quantiles")
    fences = materialise(
        exact_quantiles(rows, column, [0.25, 0.5, 0.75], group).select(
            *group, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")
        ),
        "box-fences",
    )
    reach = (F.col("q3") - F.col("q1")) * WHISKER_REACH
    value = F.col(column).cast("double")
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    stats = (
        join_small(rows.where(F.col(column).isNotNull()), fences, group)
        .groupBy(*group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("_low"),
            F.max(F.when(inside, value)).alias("_high"),
            F.count(F.when(~inside, 1)).alias("outliers"),
        )
    )
    return stats.select(
        *group_cols,
        *[F.round(c, places).alias(c) for c in ("q1", "median", "q3")],
        F.round(F.least("_low", "q1"), places).alias("whisker_low"),
        F.round(F.greatest("_high", "q3"), places).alias("whisker_high"),
        "outliers",
    )


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS, group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the smallest and largest value, empty bins included.

    The last bin is closed on the right. ``density`` integrates to one over the bins. A column
    with a single value gets a range of one around it.
    """
    rows, group = _grouped(df, group_cols)
    rows = rows.where(F.col(column).isNotNull()).withColumn("_x", F.col(column).cast("double"))
    span = rows.groupBy(*group).agg(
        F.min("_x").alias("_min"), F.max("_x").alias("_max"), F.count(F.lit(1)).alias("_n")
    )
    flat = F.col("_min") == F.col("_max")
    low = F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min"))
    high = F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max"))
    ranges = materialise(
        span.select(*group, "_n", low.alias("_low"), ((high - low) / F.lit(float(bins))).alias("_width")),
        "histogram-ranges",
    )
    bin_of = F.least(F.floor((F.col("_x") - F.col("_low")) / F.col("_width")), F.lit(bins - 1)).cast("int")
    counts = (
        join_small(rows, ranges, group).withColumn("bin", bin_of).groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("_c"))
    )
    every_bin = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    count = F.coalesce(F.col("_c"), F.lit(0))
    return every_bin.join(counts, [*group, "bin"], "left").select(
        *group_cols,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        count.alias("count"),
        (count / (F.col("_n") * F.col("_width"))).alias("density"),
    )


def density_histogram(df: DataFrame, column: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """The coarser histogram that a density curve is drawn over."""
    return histogram(df, column, DENSITY_BINS, group_cols)


def normal_density(df: DataFrame, column: str, group_cols: Sequence[str] = (), out: str = "density") -> DataFrame:
    """Density of a normal curve with the column's mean and population deviation at each value."""
    rows, group = _grouped(df, group_cols)
    fit = materialise(
        rows.groupBy(*group).agg(F.avg(column).alias("_mean"), F.stddev_pop(column).alias("_sd")), "normal-fit"
    )
    z = (F.col(column) - F.col("_mean")) / F.col("_sd")
    density = F.exp(z * z * -0.5) / (F.col("_sd") * math.sqrt(2.0 * math.pi))
    fitted = join_small(rows, fit, group).withColumn(out, F.when(F.col("_sd") > 0, density))
    return fitted.select(*df.columns, out)


def score_summary(df: DataFrame, column: str, group_cols: Sequence[str] = (), places: int = 6) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value of a score."""
    return df.groupBy(*group_cols).agg(
        F.count(column).alias("count"),
        F.round(F.avg(column), places).alias("mean"),
        F.round(F.stddev_samp(column), places).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
