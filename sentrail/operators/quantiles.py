"""Exact quantiles per group by rank narrowing: no task orders more than a bounded number of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentrail.operators.grouped import join_small
from sentrail.session import materialise

#: buckets that a bucket is cut into, and distinct values that one task orders
BUCKETS = 256
TASK_VALUES = 200_000


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], group_cols: Sequence[str] = (), task_values: int = TASK_VALUES
) -> DataFrame:
    """Linearly interpolated quantiles: one row per group with an array ``quantiles``.

    Equal values are first counted together. While a bucket (at first a whole group) holds more than
    ``task_values`` distinct values, all buckets are cut at approximate quantiles, the parts' totals
    tell which of them hold the wanted ranks, and only those go on. What is left is ordered,
    each bucket in its own task. Null values are left out.
    """
    group = list(group_cols) or ["_all"]
    source = df if group_cols else df.withColumn("_all", F.lit(0))
    live = materialise(
        source.where(F.col(column).isNotNull())
        .groupBy(*group, F.col(column).cast("double").alias("_x"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_b", F.lit(0).cast("long")),
        "quantile-values",
    )
    zero = F.lit(0).cast("long")
    spans = materialise(live.groupBy(*group, "_b").agg(F.sum("_c").alias("_n"), zero.alias("_before"), F.count(F.lit(1)).alias("_values")), "quantile-spans")
    points = [i / BUCKETS for i in range(1, BUCKETS)]
    # positions of the lower and upper neighbours of every quantile
    ranks = F.array(*[f(F.lit(float(p)) * (F.col("_n") - 1)) for p in probabilities for f in (F.floor, F.ceil)])
    while (spans.agg(F.max("_values")).first()[0] or 0) > task_values:
        edges = live.groupBy(*group, "_b").agg(F.array_distinct(F.percentile_approx("_x", points, 10_000)).alias("_edges"))
        placed = join_small(live, materialise(edges, "quantile-edges"), [*group, "_b"], row_bytes=8 * BUCKETS + 64)
        part = F.aggregate("_edges", F.lit(0), lambda n, edge: n + (edge < F.col("_x")).cast("int"))
        placed = placed.withColumn("_part", F.col("_b") * BUCKETS + part).drop("_edges")
        running = Window.partitionBy(*group, "_b").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        totals = placed.groupBy(*group, "_b", "_part").agg(F.sum("_c").alias("_in"), F.count(F.lit(1)).alias("_inner"))
        cut = totals.join(spans, [*group, "_b"]).withColumn("_low", F.col("_before") + F.coalesce(F.sum("_in").over(running), zero))
        wanted = cut.where(F.exists(ranks, lambda r: (r >= F.col("_low")) & (r < F.col("_low") + F.col("_in"))))
        spans = materialise(wanted.select(*group, F.col("_part").alias("_b"), "_n", F.col("_low").alias("_before"), F.col("_inner").alias("_values")), "quantile-spans")
        live = materialise(placed.drop("_b").withColumnRenamed("_part", "_b").join(spans.select(*group, "_b"), [*group, "_b"]), "quantile-values")

    inside = Window.partitionBy(*group, "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    ordered = live.join(spans, [*group, "_b"]).withColumn("_from", F.col("_before") + F.coalesce(F.sum("_c").over(inside), zero))

    def at(rank):
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_c")), F.col("_x")))

    aggregates = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        aggregates += [at(F.floor(position)).alias(f"_lo{i}"), at(F.ceil(position)).alias(f"_hi{i}")]
    found = ordered.groupBy(*group, "_n").agg(*aggregates)

    def blend(i: int, p: float):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (position - F.floor(position))

    return found.select(*group_cols, F.array(*[blend(i, p) for i, p in enumerate(probabilities)]).alias("quantiles"))
