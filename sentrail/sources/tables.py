"""Batch inputs: daily tables, JSON lines, JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile_day(profiles: DataFrame, year: int, month: int, day: int, actor_type: str | None = None) -> DataFrame:
    """One day of a profile table; on a table partitioned by y, m, d only that day is read."""
    sliced = profiles.where((F.col("y") == year) & (F.col("m") == month) & (F.col("d") == day))
    return sliced if actor_type is None else sliced.where(F.col("type") == actor_type)


def profile_days(profiles: DataFrame, last_day: str, days: int) -> DataFrame:
    """``days`` calendar days up to ``last_day`` (yyyy-MM-dd), still pruned by partition."""
    end = F.to_date(F.lit(last_day))
    on = F.make_date(F.col("y"), F.col("m"), F.col("d"))
    return profiles.where((on <= end) & (on > F.date_sub(end, days)))


def integer_projection(
    df: DataFrame, columns: Sequence[str], key_cols: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """Chosen columns as integers (unreadable values null), of all rows or of the first ``limit`` by key."""
    picked = df if limit is None else df.orderBy(*key_cols).limit(limit)
    return picked.select(*[F.col(c).try_cast("int").alias(c) for c in columns])


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Profile rows from JSON-lines files; the schema is given, so nothing is read to infer it."""
    return spark.read.schema(schema).json(path)


def payload_rows(payloads: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """One row per object of a JSON list held in a text column."""
    items = F.from_json(F.col(column), T.ArrayType(schema))
    return payloads.select(*keep, F.inline(items))


def payload_pairs(payloads: DataFrame, column: str, attribute: str, actor: str = "actor") -> DataFrame:
    """``{actor: value, ...}`` payloads, one per attribute, as long (actor, attribute, value) rows."""
    pairs = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    return payloads.select(F.explode(pairs).alias(actor, "value"), F.col(attribute).alias("attribute")).select(
        actor, "attribute", "value"
    )
