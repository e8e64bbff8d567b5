"""Building blocks for work keyed by a model group, where one group may hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentrail.session import materialise, row_count, written_bytes

BROADCAST_BYTES = 64 << 20
SALTS = 64
PACKED = 4
#: files have headers: a table below this is small whatever it is allowed
LEAST_BYTES = 1 << 20


def join_small(
    left: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    row_bytes: int = 256,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join a per-group table to the rows it describes.

    ``small`` should come from ``materialise``, which knows its bytes and makes counting it cheap. It is
    broadcast only where its rows and its written bytes allow. Beyond that each of its rows is repeated once
    per salt and the join runs on (keys, salt), so a hot group still spreads over many tasks.
    """
    if fits_broadcast(small, row_bytes, max_bytes):
        return left.join(F.broadcast(small), list(on), how)
    return salted_join(left, small, on, how, salts)


def fits_broadcast(small: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to send to every executor: by its rows, and by its bytes as written,
    which take about ``PACKED`` times as much in memory."""
    return row_count(small) <= max(1, max_bytes // row_bytes) and PACKED * (written_bytes(small) or 0) <= max(max_bytes, LEAST_BYTES)


def salted_join(left: DataFrame, small: DataFrame, on: Sequence[str], how: str, salts: int = SALTS) -> DataFrame:
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # hashed over whole rows: rows of one group land on different salts
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    # the planner would size the repeated side by what it was before repeating
    return salted.join(spread.hint("merge"), [*on, "_salt"], how).drop("_salt")


def dense_index(
    df: DataFrame,
    sizes: DataFrame,
    group_cols: Sequence[str],
    key_cols: Sequence[str],
    out: str = "_idx",
    bucket_rows: int = 50_000,
) -> DataFrame:
    """Number the rows of every group 0..n-1 without sorting a whole group in one task.

    Keys must be unique within a group. Rows fall into about n/``bucket_rows`` hash buckets of
    their key, are numbered inside their bucket, and the buckets' running totals are added. The
    numbering depends on the data alone, not on partitions. ``sizes`` has a row per group with
    its row count ``_n``.
    """
    group = list(group_cols)
    buckets = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(float(bucket_rows))))
    others = [c for c in sizes.columns if c not in group]
    bucketed = join_small(df, sizes, group).withColumn("_bucket", F.pmod(F.xxhash64(*key_cols), buckets)).drop(*others)
    inside = Window.partitionBy(*group, "_bucket").orderBy(*key_cols)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    numbered = bucketed.withColumn("_local", F.row_number().over(inside) - 1)
    # the offsets share the numbered rows' distribution on (group, bucket)
    return (
        numbered.join(offsets, [*group, "_bucket"])
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop("_bucket", "_local", "_offset")
    )


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "_rank") -> DataFrame:
    """0-based rank of every row within ``by`` (which may be empty), in ``order``, without a window over a whole group.

    Rows are dealt by ranges of (by, order) and numbered inside a range; a group's earlier ranges, of which there
    are no more than tasks, tell where its numbers go on. Ties in ``order`` are numbered in any order.
    """
    sorting = [*[F.col(c) for c in by], *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *sorting).sortWithinPartitions(*sorting).withColumn("_part", F.spark_partition_id())
    dealt = materialise(dealt, "ranges")
    local = Window.partitionBy(*by, "_part").orderBy(*order)
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_in"))
    starts = starts.withColumn("_from", F.coalesce(F.sum("_in").over(before), F.lit(0))).drop("_in")
    named = starts.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("_part").alias("_of_part"), "_from")
    same = F.col("_part") == F.col("_of_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    numbered = dealt.withColumn("_local", F.row_number().over(local) - 1).join(named, same)
    return numbered.select(*df.columns, (F.col("_from") + F.col("_local")).alias(out))


def salt_groups(
    rows: DataFrame,
    model: DataFrame,
    sizes: DataFrame,
    group_cols: Sequence[str],
    key_cols: Sequence[str],
    rows_per_task: int,
) -> tuple[DataFrame, DataFrame]:
    """Split every group's rows into slices of about ``rows_per_task`` and repeat the group's
    model once per slice, so that both can be co-grouped on (group, ``_slice``). Rows whose group
    columns hold a null match no model; they are kept, and sliced like any other group."""
    group = list(group_cols)
    slices = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(float(rows_per_task)))).cast("int")
    if fits_broadcast(sizes, 128):
        named = sizes.select(*[F.col(c).alias(f"_of_{c}") for c in group], "_n")
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in group]
        sized = rows.join(F.broadcast(named), same, "left").drop(*[f"_of_{c}" for c in group])
    else:
        sized = salted_join(rows, sizes, group, "left")
    split = sized.withColumn("_slice", F.pmod(F.xxhash64(*key_cols), F.coalesce(slices, F.lit(4 * SALTS))).cast("int"))
    spread = model.join(sizes, group).withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    return split.drop("_n"), spread.drop("_n")
