"""Event messages from a topic, or from files that hold the same messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.functions.text import ascii_text

SOURCE_FIELD = "source.type"
#: what a micro-batch takes at most, unless told otherwise
MESSAGES_PER_BATCH = 1_000_000
FILES_PER_BATCH = 1_000


def read_topic(spark: SparkSession, brokers: str, topic: str, **options: str) -> DataFrame:
    """All messages a topic holds now (needs the kafka connector on the class path)."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").options(**options).load()


def stream_topic(
    spark: SparkSession, brokers: str, topic: str, group_id: str, per_batch: int | None = MESSAGES_PER_BATCH, **options: str
) -> DataFrame:
    """The topic as a stream; progress lives in the checkpoint, the group id names the reader. A micro-batch takes
    up to ``per_batch`` messages, the first one too, however much the topic already holds."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
    reader = reader.option("kafka.group.id", group_id).option("startingOffsets", "earliest")
    reader = reader.option("maxOffsetsPerTrigger", per_batch) if per_batch else reader
    return reader.options(**options).load()


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", per_batch: int | None = FILES_PER_BATCH, **options: str
) -> DataFrame:
    """Files that arrive in a folder as a stream, up to ``per_batch`` of them to a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    reader = reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader
    return reader.options(**options).load(path)


def message_schema(num_cols: Sequence[str], cat_cols: Sequence[str], extra: Mapping[str, str] | None = None) -> T.StructType:
    """Fields to read from a message. Numbers are read as text first: producers quote freely."""
    schema = T.StructType([T.StructField(SOURCE_FIELD, T.StringType())])
    for name in [*num_cols, *cat_cols]:
        schema = schema.add(name, T.StringType())
    for name, kind in (extra or {}).items():
        schema = schema.add(name, kind)
    return schema


def parse_events(
    messages: DataFrame,
    source: str,
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    extra: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    value: str = "value",
) -> DataFrame:
    """Messages of one source as columns: numbers default to 0.0, texts to "".

    Stateless, so the same call serves batch and streaming frames. ``extra`` names more fields
    with their types; they stay null when missing. ``keep`` passes message columns through.
    """
    schema = message_schema(num_cols, cat_cols, extra)
    parsed = messages.select(*keep, F.from_json(ascii_text(F.col(value)), schema).alias("_e"))

    def field(name: str) -> Column:
        return F.col(f"_e.`{name}`")

    numbers = [F.coalesce(field(c).try_cast("double"), F.lit(0.0)).alias(c) for c in num_cols]
    texts = [F.coalesce(field(c), F.lit("")).alias(c) for c in cat_cols]
    return parsed.where(field(SOURCE_FIELD) == source).select(
        *keep, *numbers, *texts, *[field(c).alias(c) for c in extra or {}]
    )


def event_intake(
    messages: DataFrame,
    source: str,
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    offset_cols: Sequence[str] = ("partition", "offset"),
    limit: int | None = None,
) -> DataFrame:
    """The matching messages, e.g. to train an event model on: all, or the first ``limit`` in offset order."""
    events = parse_events(messages, source, num_cols, cat_cols, keep=offset_cols)
    if limit is not None:
        events = events.orderBy(*offset_cols).limit(limit)
    return events.select(*num_cols, *cat_cols)
