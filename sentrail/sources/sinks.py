"""Score tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrail.functions.rules import DAY_COLS, PROFILE_COUNTERS

SCORE_COLUMNS = ("pas_kmeans", "pas_isolation", "pas_svm", "pas")

# Columns and types of the two score tables, written by name.
PROFILE_SCORE_SCHEMA = ", ".join(
    ["name string", "type string", "time_window string", "execution_timestamp bigint"]
    + [f"{c} bigint" for c in PROFILE_COUNTERS]
    + ["zscore string", "pas_kmeans double", "pas_isolation double", "pas_svm double", "pas double"]
    + [f"{c} int" for c in DAY_COLS]
)
EVENT_SCORE_SCHEMA = ", ".join(
    ["guid string", "timestamp bigint", "user_name string", "entity_name string", "source_type string"]
    + ["alerts string", "zscore string", "alert_score double", "event_score double"]
    + [f"{c} int" for c in DAY_COLS]
)


def create_score_table(
    spark: SparkSession, table: str, schema: str = PROFILE_SCORE_SCHEMA, fmt: str = "orc", location: str | None = None
) -> None:
    """A score table (of profiles, or of events with ``EVENT_SCORE_SCHEMA``), partitioned by day, unless it exists.
    With ``location`` its files lie there and outlive the table."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING {fmt} PARTITIONED BY ({', '.join(DAY_COLS)}){place}")


def score_rows(scores: DataFrame, execution_ms: int, schema: str = PROFILE_SCORE_SCHEMA) -> DataFrame:
    """Rows as the score table wants them: stamped, null scores 0, columns and types by name.

    The time of the run is an argument, so a repeated run writes the same rows.
    """
    stamped = scores.withColumn("execution_timestamp", F.lit(execution_ms).cast("bigint"))
    filled = stamped.na.fill(0.0, subset=[c for c in SCORE_COLUMNS if c in stamped.columns])
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return filled.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])


def by_day(rows: DataFrame, day_cols: Sequence[str] = DAY_COLS) -> DataFrame:
    """Rows laid out for a write partitioned by day: few files per day, and a day that is larger
    than the advisory partition size is split rather than written by one task."""
    return rows.hint("rebalance", *day_cols)


def write_scores_path(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the days present in ``rows`` and leave other days alone: a rerun is idempotent."""
    writer = by_day(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*DAY_COLS).format(fmt).save(path)


def write_scores_table(rows: DataFrame, table: str) -> None:
    """Same for a catalog table; columns are matched by name, not by position."""
    spark = rows.sparkSession
    writer = by_day(rows.select(*spark.table(table).columns)).write.mode("overwrite")
    # an insert into a table takes this from the session, not from the writer's options
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        writer.insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def export_json(df: DataFrame, key_cols: Sequence[str], count: int, path: str) -> None:
    """The first ``count`` rows by key as one JSON-lines file; for small extracts."""
    df.orderBy(*key_cols).limit(count).coalesce(1).write.mode("overwrite").json(path)
