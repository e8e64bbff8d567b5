"""Streams give what the batch gives, restart where they stopped, and drop late events."""

import glob
import os

from pyspark.sql import functions as F

from registry import inputs as I
from registry.queries import ALERT_WEIGHTS, EVENT_SCORER
from sentrail.sources import commits, topic
from sentrail.streaming.events import compact_batches, epoch_millis, read_batches, score_events, write_batches, write_stream
from sentrail.streaming.windows import stream_profiles


def run(rows, folder, partition_cols=("y", "m", "d")):
    write_stream(rows, folder + "/out", folder + "/mark", once=True, partition_cols=partition_cols).awaitTermination()


def test_stream_equals_batch_and_resumes(spark, sf, folder):
    messages = I.messages(spark, sf)
    half = F.col("offset") < 500

    def scored(rows):
        return score_events(rows, "demo_traffic", ["num1", "num2"], ["cat1"], EVENT_SCORER, ALERT_WEIGHTS, {"num1": (50.0, 10.0)})

    def stream():
        return scored(topic.stream_files(spark, folder + "/in", messages.schema))

    for part in (messages.where(half), messages.where(~half)):
        part.write.mode("append").parquet(folder + "/in")
        run(stream(), folder)
    run(stream(), folder)  # nothing new arrived
    batch = scored(messages)
    out = spark.read.schema(batch.schema).parquet(folder + "/out")
    assert out.count() == batch.count() and out.exceptAll(batch).isEmpty()


def test_batches_a_retry_and_a_newer_model(spark, sf, folder):
    messages = I.messages(spark, sf).where("offset < 900")
    for low in (0, 300, 600):
        messages.where(F.col("offset").between(low, low + 299)).coalesce(1).write.mode("append").parquet(folder + "/in")
    asked = []

    def version():
        asked.append(None)
        return "one" if len(asked) < 2 else "two"

    def score(rows, model):
        return score_events(rows, "demo_traffic", ["num1", "num2"], ["cat1"], model, ALERT_WEIGHTS)

    def run_batches(load=lambda: EVENT_SCORER if len(asked) > 1 else None):
        stream = topic.stream_files(spark, folder + "/in", messages.schema, per_batch=1)
        write_batches(stream, score, folder + "/out", folder + "/mark", version, load, once=True).awaitTermination()

    run_batches()
    made = commits.commits(spark, folder + "/out")
    assert [content["model"] for content in made.values()] == ["one", "two", "two"]
    batch = score(messages, EVENT_SCORER)
    found = read_batches(spark, folder + "/out", batch.schema)
    assert found.count() == batch.count()
    # the first batch was scored without a model, those after the change with the new one
    assert found.drop("event_score").exceptAll(batch.drop("event_score")).isEmpty()
    first = found.where("event_score = 0").count()
    assert 0 < first < found.count() and found.where("event_score > 0").exceptAll(batch).isEmpty()
    # the last batch did not come to its end in the checkpoint: it is run again and writes nothing
    last = max(int(os.path.basename(p)) for p in glob.glob(folder + "/mark/commits/[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{folder}/mark/commits/{name}"):
            os.remove(f"{folder}/mark/commits/{name}")
    run_batches()
    assert len(asked) == 3 and read_batches(spark, folder + "/out", batch.schema).count() == batch.count()
    compact_batches(spark, folder + "/out", batch.schema)
    assert len(commits.live(spark, folder + "/out")) == 1
    again = read_batches(spark, folder + "/out", batch.schema)
    assert again.count() == batch.count() and again.exceptAll(found).isEmpty()


def test_without_a_model_events_score_zero(spark, sf):
    rows = score_events(I.messages(spark, sf), "demo_traffic", ["num1"], [], None, ALERT_WEIGHTS)
    assert {r.event_score for r in rows.select("event_score").distinct().collect()} == {0.0}


def test_milliseconds_do_not_depend_on_the_session_zone(spark):
    for zone, instant in (("UTC", 1704067200000), ("America/New_York", 1704085200000)):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' wall, timestamp'2024-01-01 00:00:00' at, timestamp'2024-01-01 00:00:00Z' fixed")
            row = df.select(epoch_millis(df, "wall"), epoch_millis(df, "at"), epoch_millis(df, "fixed")).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(row) == (1704067200000, instant, 1704067200000)


def test_late_events_are_dropped(spark, folder):
    schema = "ts timestamp, k int"

    def arrive(*times):
        spark.sql(" union all ".join(f"select timestamp'{t}' ts, 1 k" for t in times)).coalesce(1).write.mode("append").parquet(folder + "/in")

    def windows():
        from pyspark.sql.types import _parse_datatype_string

        stream = topic.stream_files(spark, folder + "/in", _parse_datatype_string(schema))
        return stream_profiles(stream, "ts", ["k"], "day", {"events": F.count(F.lit(1))}, delay="1 hour")

    arrive("2024-01-01 10:00:00", "2024-01-02 10:00:00")
    run(windows(), folder, ())
    arrive("2024-01-01 11:00:00", "2024-01-03 10:00:00")  # the first is behind the watermark
    run(windows(), folder, ())
    found = {(str(r.window_start), r.events) for r in spark.read.parquet(folder + "/out").collect()}
    assert found == {("2024-01-01 00:00:00", 1), ("2024-01-02 00:00:00", 1)}
