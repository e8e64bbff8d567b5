"""Event scoring: one transform for batch and stream, and the stream's writer."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sentrail.functions import scores as S
from sentrail.functions.rules import DAY_COLS
from sentrail.functions.text import alert_weight_score
from sentrail.operators.kmeans import CentroidScorer, DistanceModel
from sentrail.sources import commits as log
from sentrail.sources.sinks import EVENT_SCORE_SCHEMA, by_day
from sentrail.sources.topic import parse_events

# Fixed value: seconds between micro-batches.
STREAM_SECONDS = 180

# Message fields beside the model's columns.
EVENT_FIELDS = {
    "guid": T.StringType(),
    "user_name": T.StringType(),
    "src_ip": T.StringType(),
    "alerts": T.StringType(),
    "y": T.IntegerType(),
    "m": T.IntegerType(),
    "d": T.IntegerType(),
}


def epoch_millis(df: DataFrame, column: str) -> Column:
    """Milliseconds since 1970 in UTC, the same in every session zone: an instant counts as it is,
    a wall time without a zone counts as UTC."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    return F.unix_millis(F.col(column).cast("timestamp"))


def score_events(
    messages: DataFrame,
    source: str,
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    model: CentroidScorer | DistanceModel | None,
    weights: Mapping[str, float],
    moments: Mapping[str, tuple[float, float]] | None = None,
    event_time: str = "event_ts",
) -> DataFrame:
    """Messages of one source as rows of the event score table.

    Stateless throughout, so streams need no shuffle. Without a model every event scores 0.
    ``moments`` (mean and deviation per number) adds z-scores as JSON text.
    """
    events = parse_events(messages, source, num_cols, cat_cols, EVENT_FIELDS, keep=[event_time])
    scored = model.score(events, "event_score") if model is not None else events.withColumn("event_score", F.lit(0.0))
    cells = [
        x
        for c, (mean, sd) in (moments or {}).items()
        for x in (F.lit(c), S.zscore(F.col(c), F.lit(float(mean)), F.lit(float(sd))))
    ]
    text = F.to_json(F.create_map(*cells), {"ignoreNullFields": "false"}) if cells else F.lit(None).cast("string")
    rows = scored.withColumns(
        {
            "timestamp": epoch_millis(scored, event_time),
            "entity_name": F.col("src_ip"),
            "source_type": F.lit(source),
            "zscore": text,
            "alert_score": alert_weight_score(F.col("alerts"), weights),
        }
    )
    fields = [f.strip().split(" ") for f in EVENT_SCORE_SCHEMA.split(",")]
    return rows.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])


def write_stream(
    rows: DataFrame, path: str, checkpoint: str, once: bool = False, seconds: int = STREAM_SECONDS, partition_cols: Sequence[str] = DAY_COLS
) -> StreamingQuery:
    """Append a stream to a partitioned Parquet table, exactly once per the checkpoint.
    ``once`` takes what has arrived and stops; otherwise a micro-batch runs every ``seconds``."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append").partitionBy(*partition_cols)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def write_batches(
    messages: DataFrame,
    score: Callable[[DataFrame, object], DataFrame],
    path: str,
    checkpoint: str,
    version: Callable[[], str | None] = lambda: None,
    load: Callable[[], object] = lambda: None,
    once: bool = False,
    seconds: int = STREAM_SECONDS,
) -> StreamingQuery:
    """Score a stream of messages batch by batch into a store that ``read_batches`` reads.

    Before each batch ``version`` is asked, and ``load`` brings the model anew where the answer has changed. A
    batch is written under a name of its own and counts once its commit, which carries the stream's and the batch's
    number, is made: a batch that is repeated after a failure finds its commit and writes nothing.
    """
    spark = messages.sparkSession
    held: dict[str, object] = {}

    def one(batch: DataFrame, number: int) -> None:
        stream = json.loads(log.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
        name = f"{stream}-{number:012d}"
        if name in log.commits(spark, path):
            return
        now = version()
        if "model" not in held or held["version"] != now:
            held["version"], held["model"] = now, load()
        data = f"{path.rstrip('/')}/data/part={uuid.uuid4().hex}"
        by_day(score(batch, held["model"])).write.partitionBy(*DAY_COLS).parquet(data)
        log.commit(spark, path, name, {"data": data, "model": now})

    writer = messages.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that committed batches have written."""
    # a batch without rows wrote no folder of a day
    folders = [content["data"] for content in log.live(spark, path).values() if log.exists(spark, content["data"])]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/data")
    return reader.parquet(*folders).select(*schema.names)


def compact_batches(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Write what is there as a few files a day, in place of the batches' own. Batches that arrive meanwhile stay."""
    covered = log.live(spark, path)
    if len(covered) < 2:
        return
    data = f"{path.rstrip('/')}/data/part={uuid.uuid4().hex}"
    by_day(read_batches(spark, path, schema)).write.partitionBy(*DAY_COLS).parquet(data)
    log.commit(spark, path, f"compact-{uuid.uuid4().hex}", {"data": data, "covers": list(covered)})
