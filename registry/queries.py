"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import inputs as I
from sentrail.functions import scores as S
from sentrail.functions.dates import backfill_days
from sentrail.functions.rules import DAY_COLS, GROUP_COLS, OS_LOG_RULES, PROFILE_COUNTERS
from sentrail.functions.text import alert_weight_score, received_bytes, sent_bytes
from sentrail.operators import alerts, classify, eda, features, modelstore, profiles, scoring
from sentrail.operators.iforest import TREE_FIELDS, ForestModel, fit_forest
from sentrail.operators.kmeans import CentroidScorer, fit_distance_model
from sentrail.operators.ocsvm import MODEL_FIELDS, OneClassModel, fit_one_class
from sentrail.plans import daily, overall, requests
from sentrail.session import materialise, scratch_path
from sentrail.sources import sinks, tables, topic
from sentrail.streaming.events import compact_batches, epoch_millis, read_batches, score_events, write_batches, write_stream
from sentrail.streaming.windows import stream_profiles

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEYS = ["name", *GROUP_COLS]
PARTS = ("pas_kmeans", "pas_isolation", "pas_svm")
# example weights; a deployment brings its own
ALERT_WEIGHTS = {"is_nu": 3.0, "is_ne": 2.0, "is_nwpu": 1.0}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def activity(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.daily_activity(I.win(spark, sf))


def written_activity(spark: SparkSession, sf: str) -> DataFrame:
    """The daily aggregate as a written table, for operators that read it more than once."""
    return materialise(activity(spark, sf), "activity")


def blended(scores: DataFrame) -> DataFrame:
    return scores.withColumn("pas", S.ensemble([F.col(c) for c in PARTS]))


def epoch_seconds(column: str):
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({column} as timestamp_ntz))")


# ------------------------------------------------------------ sources and sinks


@query
def profile_day_slice(spark, sf):
    path = scratch_path(spark, "profiles")
    sinks.write_scores_path(activity(spark, sf), path)
    return tables.profile_day(spark.read.parquet(path), 2024, 1, 15)


@query
def capped_projection(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return tables.integer_projection(I.table(spark, sf, "lineitem"), columns, columns, limit=50_000)


@query
def integer_projection(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return tables.integer_projection(I.table(spark, sf, "lineitem"), columns)


@query
def json_profile_scan(spark, sf):
    def flag(condition):
        return F.when(condition, "True").otherwise("False")

    rows = activity(spark, sf).select(
        F.col("name").alias("user_name"),
        "type",
        *DAY_COLS,
        flag(F.col("total_events") > 3).alias("increase_activity"),
        flag(F.col("pri_count") > 0).alias("lateral_movement"),
        F.col("logins_count").alias("logon_count"),
        F.col("fileactivity_count").alias("inbound_conn_count"),
        F.col("pri_count").alias("outbound_conn_count"),
    )
    path = scratch_path(spark, "json-profiles")
    rows.write.json(path)
    return tables.json_lines(spark, path, rows.schema)


@query
def json_payload_rows(spark, sf):
    def entry(prefix, count):
        return F.struct(
            F.concat(F.lit(prefix), F.col("o_custkey").cast("string")).alias("username"), count.alias("logins_count")
        )

    payloads = I.table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_json(F.array(entry("U", F.col("o_orderkey") % 7), entry("V", F.col("o_custkey") % 5))).alias("payload"),
    )
    item = T.StructType().add("username", "string").add("logins_count", "long")
    return tables.payload_rows(payloads, "payload", item, keep=["o_orderkey"])


@query
def attribute_assembly(spark, sf):
    orders = I.table(spark, sf, "orders")
    attribute = F.lower(F.regexp_replace(F.substring("o_orderpriority", 3, 20), " ", "_"))
    values = orders.groupBy(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("actor"), attribute.alias("attribute")
    ).agg(F.count(F.lit(1)).cast("string").alias("value"))
    return profiles.assemble_attributes(values, ["urgent", "high", "medium", "low"], ["not_specified"])


@query
def event_intake(spark, sf):
    return topic.event_intake(I.messages(spark, sf), "demo_traffic", ["num1", "num2"], ["cat1"], limit=1_500)


@query
def event_intake_all(spark, sf):
    return topic.event_intake(I.messages(spark, sf), "demo_traffic", ["num1", "num2"], ["cat1"])


@query
def event_timestamps(spark, sf):
    """Instants and wall times, each as milliseconds."""
    events = I.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("wall"))
    zoned = events.withColumn("instant", F.concat(F.col("wall").cast("string"), F.lit("+09:00")).cast("timestamp"))
    return zoned.select(
        "event_id", epoch_millis(zoned, "wall").alias("wall_ms"), epoch_millis(zoned, "instant").alias("instant_ms")
    )


@query
def attribute_assembly_repeats(spark, sf):
    """One row per order and combination of its lines by return flag; some numbers can't be read."""
    number = F.when(F.col("l_linenumber") == 3, "?").otherwise(F.col("l_quantity").cast("int").cast("string"))
    values = I.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("actor"), F.lower("l_returnflag").alias("attribute"), number.alias("value")
    )
    return profiles.assemble_attributes(values, ["a", "r"], ["n"])


@query
def score_sink_roundtrip(spark, sf):
    scores = blended(I.frozen_scores(activity(spark, sf)))
    path = scratch_path(spark, "scores")
    sinks.write_scores_path(sinks.score_rows(scores, execution_ms=1_700_000_000_000), path, fmt="orc")
    return spark.read.orc(path)


def _through_table(spark, rows, schema):
    """Rows written by name into a partitioned table of its own, some of them twice, and what the table then holds."""
    table, path = f"scores_{uuid.uuid4().hex}", scratch_path(spark, "table")
    sinks.create_score_table(spark, table, schema, location=path)
    sinks.write_scores_table(rows, table)
    sinks.write_scores_table(rows.where("d % 2 = 0"), table)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(", ".join(schema.split(", "))).orc(path)


@query
def profile_score_table(spark, sf):
    scores = blended(I.frozen_scores(activity(spark, sf)))
    return _through_table(spark, sinks.score_rows(scores, execution_ms=1_700_000_000_000), sinks.PROFILE_SCORE_SCHEMA)


@query
def event_alert_table(spark, sf):
    scored = materialise(_event_scores(I.messages(spark, sf)), "event-scores")
    return _rounded(_through_table(spark, scored, sinks.EVENT_SCORE_SCHEMA))


@query
def export_capped_json(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "export")
    sinks.export_json(orders, ["o_orderkey"], 1_000, path)
    return tables.json_lines(spark, path, orders.schema)


ADHOC = """
    SELECT c_mktsegment, count(*) AS orders, cast(count(DISTINCT o_custkey) AS bigint) AS customers,
           max(o_totalprice) AS largest
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey
    GROUP BY c_mktsegment
"""


@query
def adhoc_sql(spark, sf):
    return spark.sql(ADHOC, **{name: I.table(spark, sf, name) for name in ("orders", "customer")})


# ------------------------------------------------------------ profiles and alerts


@query
def script_activity_filter(spark, sf):
    return I.win(spark, sf).where(OS_LOG_RULES.script_activity()).select(
        "event_id", "windowseventid", "windowsprocessname", "windowslogontype"
    )


@query
def win_daily_aggregation(spark, sf):
    return activity(spark, sf)


@query
def alert_score_normalised(spark, sf):
    return overall.daily_alert_scores(I.win(spark, sf))


@query
def alert_score_rescaled(spark, sf):
    return overall.daily_alert_scores(I.win(spark, sf), rescale=True)


@query
def final_anomaly_view(spark, sf):
    day_rows = written_activity(spark, sf)
    return alerts.overall_score(blended(I.frozen_scores(day_rows)), alerts.alert_scores(day_rows))


@query
def final_anomaly_view_trained(spark, sf):
    """From raw events through trained detectors and the score table to the overall score."""
    events, path = I.win(spark, sf), scratch_path(spark, "trained-scores")
    scored = daily.train_and_score(activity(spark, sf))
    sinks.write_scores_path(sinks.score_rows(scored, execution_ms=1_700_000_000_000), path, fmt="orc")
    return overall.overall(events, spark.read.orc(path))


@query
def final_anomaly_view_by_type(spark, sf):
    day_rows = written_activity(spark, sf)
    scores = blended(I.frozen_scores(day_rows))
    return alerts.overall_score(scores, alerts.alert_scores(day_rows), match_type=True)


@query
def overall_score_views(spark, sf):
    """Views over an event table and a score table, read back by name."""
    mark = uuid.uuid4().hex
    events, stored, day_view, final = (f"{name}_{mark}" for name in ("events", "scores", "daily_activity", "overall_scores"))
    path = scratch_path(spark, "view-scores")
    sinks.write_scores_path(sinks.score_rows(blended(I.frozen_scores(activity(spark, sf))), execution_ms=1_700_000_000_000), path)
    I.win(spark, sf).createOrReplaceTempView(events)
    spark.read.parquet(path).createOrReplaceTempView(stored)
    overall.create_views(spark, events, stored, day_view, final)
    rows = spark.table(final).select("name", "type", *DAY_COLS, "win_total_events", "overall_anomaly_score")
    for view in (events, stored, day_view, final):
        spark.catalog.dropTempView(view)
    return rows


@query
def user_counter_rollup(spark, sf):
    users = activity(spark, sf).where(F.col("type") == "user")
    spelled = F.when(F.col("d") % 2 == 0, F.upper("name")).otherwise(F.col("name"))
    return profiles.counter_rollup(users.withColumn("username", spelled), "username", lower=True)


@query
def address_counter_rollup(spark, sf):
    addresses = activity(spark, sf).where(F.col("type") == "entity")
    return profiles.counter_rollup(addresses.withColumnRenamed("name", "ip_src_addr"), "ip_src_addr")


@query
def mail_profile(spark, sf):
    return profiles.mail_profile(I.mail(spark, sf))


@query
def alert_weight_scores(spark, sf):
    flags = F.get_json_object("value", "$.alerts")
    return I.messages(spark, sf).select(
        F.col("offset").alias("event_id"), alert_weight_score(flags, ALERT_WEIGHTS).alias("alert_score")
    )


@query
def traffic_bytes_parse(spark, sf):
    return I.traffic(spark, sf).select(
        "l_orderkey", "l_linenumber", "dst_port", "src_port",
        received_bytes(F.col("info_1")).alias("rcvd_bytes"), sent_bytes(F.col("info_2")).alias("sent_bytes"),
    )


@query
def backfill_dates(spark, sf):
    last = I.table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    return backfill_days(last, F.col("last_ts"), 7).drop("last_ts")


@query
def profile_windows(spark, sf):
    events = I.table(spark, sf, "events").withColumn("k", I.k())
    rolled = profiles.all_windows(events, "ts", ["user_id"], {"total_k": F.col("k")})
    return rolled.withColumn("window_start", epoch_seconds("window_start"))


@query
def profile_windows_stream(spark, sf):
    # watermarks need an instant; the same one in any session time zone
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    events = I.table(spark, sf, "events").select(F.timestamp_micros(micros).alias("ts"), "user_id", I.k().alias("k"))
    incoming, out, mark = (scratch_path(spark, n) for n in ("arriving", "windows", "windows-checkpoint"))
    events.write.parquet(incoming)
    stream = topic.stream_files(spark, incoming, events.schema)
    sums = {"events": F.count(F.lit(1)), "total_k": F.sum("k")}
    closed = stream_profiles(stream, "ts", ["user_id"], "day", sums, delay="1 hour")
    closed = closed.withColumn("window_start", F.col("window_start").cast("long"))
    write_stream(closed, out, mark, once=True, partition_cols=()).awaitTermination()
    return spark.read.schema(closed.schema).parquet(out)


# ------------------------------------------------------------ scores without training


@query
def ensemble_pas(spark, sf):
    return blended(I.frozen_scores(activity(spark, sf))).select(*KEYS, *PARTS, "pas")


@query
def anomaly_label(spark, sf):
    pas = F.col("pas")
    return blended(I.frozen_scores(activity(spark, sf))).select(
        *KEYS, "pas", S.anomaly_label(pas).alias("anomaly"), S.anomaly_label(pas, 50).alias("anomaly_50"),
        S.anomaly_level(pas, [30, 60], ["low", "medium", "high"]).alias("level"),
    )


@query
def label_split_counts(spark, sf):
    labelled = blended(I.frozen_scores(activity(spark, sf))).withColumn("anomaly", S.anomaly_label(F.col("pas")))
    return scoring.label_counts(labelled, group_cols=["type"])


@query
def score_summary(spark, sf):
    return eda.score_summary(blended(I.frozen_scores(activity(spark, sf))), "pas", ["type"])


@query
def zscore_profile(spark, sf):
    scored = scoring.zscores(written_activity(spark, sf), PROFILE_COUNTERS)
    return scored.select(*KEYS, *[F.col("zscore")[c].alias(f"z_{c}") for c in PROFILE_COUNTERS])


@query
def minmax_score(spark, sf):
    events = I.table(spark, sf, "events")
    scored = scoring.minmax_scores(events, "value", "score", ["event_type"])
    return scored.select("event_id", "event_type", F.round("score", 6).alias("score"))


@query
def missing_model_fallback(spark, sf):
    day_rows = written_activity(spark, sf)
    users_only = scoring.fit_minmax(day_rows.where(F.col("type") == "user"), "total_events", GROUP_COLS)
    scored = scoring.minmax_scores(day_rows, "total_events", "pas", GROUP_COLS, materialise(users_only, "ranges"))
    return scored.select(*KEYS, F.round("pas", 6).alias("pas"), "model_found")


@query
def empty_group_policy(spark, sf):
    """Three actor types are asked for, two have rows: the third simply does not appear."""
    scored = scoring.minmax_scores(written_activity(spark, sf), "total_events", "pas", GROUP_COLS)
    asked = scored.where(F.col("type").isin("user", "entity", "service"))
    return asked.groupBy(*GROUP_COLS).agg(F.count(F.lit(1)).alias("scored"), F.max("pas").alias("highest"))


@query
def sed_frozen_centroids(spark, sf):
    scored = FROZEN_CENTROIDS.score(FROZEN_CENTROIDS.raw(activity(spark, sf)), "pas")
    return scored.select(*KEYS, F.round("sed", 6).alias("sed"), F.round("pas", 6).alias("pas"))


# centroids over the six counters, unscaled
FROZEN_CENTROIDS = CentroidScorer(
    PROFILE_COUNTERS, [0.0] * 6, [1.0] * 6, [[0, 0, 0, 0, 0, 0], [1, 2, 1, 0, 3, 1], [4, 1, 0, 2, 2, 0]], 5.0, 60.0
)


def _identity_scaling(spark):
    rows = [(kind, 1, [0.0] * 6, [1.0] * 6) for kind in ("user", "entity")]
    return spark.createDataFrame(rows, "type string, _n bigint, _means array<double>, _sds array<double>")


CENTRES = [[0, 0, 0, 0, 0, 0], [1, 2, 1, 0, 3, 1], [4, 1, 0, 2, 2, 0]]


@query
def cluster_ids(spark, sf):
    """The clusters that each actor type's profiles fall into, under given centroids."""
    nearest = S.nearest_centroid([F.col(c) for c in PROFILE_COUNTERS], CENTRES)
    return activity(spark, sf).select("type", nearest.alias("cluster_id")).distinct()


@query
def label_coordinates(spark, sf):
    scored = blended(I.frozen_scores(activity(spark, sf))).withColumn("anomaly", S.anomaly_label(F.col("pas")))
    return scoring.label_coordinates(scored, [*KEYS, *PROFILE_COUNTERS])


@query
def iforest_frozen_score(spark, sf):
    # three trees over (logins, pri), (failedlogin, fileactivity) and (other_scripts, ps)
    trees = [
        (0, 256, 2, None, None, 4, None, None, [0, 1, -1, -1, -1], [1.5, 0.5, 1.9, 3.7, 2.0], [1, 3, 0, 0, 0]),
        (1, 256, 0, None, None, 1, None, None, [1, -1, 0, -1, -1], [2.5, 5.25, 0.5, 3.0, 2.5], [1, 0, 3, 0, 0]),
        (2, 256, 3, None, None, 5, None, None, [0, -1, -1], [0.5, 6.5, 4.25], [1, 0, 0]),
    ]
    rows = [(kind, *tree) for kind in ("user", "entity") for tree in trees]
    forest = ForestModel(
        spark.createDataFrame(rows, f"type string, {TREE_FIELDS}"), _identity_scaling(spark), ("type",), PROFILE_COUNTERS, ()
    )
    scored = forest.raw(written_activity(spark, sf), KEYS, rows_per_task=1_000)
    return scored.select(*KEYS, F.round("score", 6).alias("score"))


@query
def ocsvm_frozen_score(spark, sf):
    points = [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 2.0, 0.0, 1.0, 0.0, 1.0]
    rows = [(kind, 1.25, 0.0, [1.5, 0.5], points, []) for kind in ("user", "entity")]
    model = OneClassModel(
        spark.createDataFrame(rows, f"type string, {MODEL_FIELDS}"), _identity_scaling(spark), ("type",), PROFILE_COUNTERS, (), 0.1
    )
    scored = model.raw(written_activity(spark, sf), KEYS, rows_per_task=1_000)
    return scored.select(*KEYS, F.round("score", 6).alias("score"))


# ------------------------------------------------------------ features and statistics


@query
def string_index(spark, sf):
    events = I.table(spark, sf, "events")
    ranks = features.category_ranks(events, "event_type")
    return features.index_categories(events, ranks, "event_type").select("event_id", "event_type", "event_type_index")


@query
def string_index_of_many(spark, sf):
    """A column with nearly as many categories as rows."""
    lines = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long").cast("string").alias("price"))
    ranks = features.category_ranks(lines, "price")
    return features.index_categories(lines, ranks, "price").select("l_orderkey", "l_linenumber", "price_index")


@query
def onehot_standardise(spark, sf):
    events = I.table(spark, sf, "events")
    model = features.feature_pipeline(["value"], ["event_type"], one_hot=True).fit(events)
    mean, sd = features.fit_moments(events, ["value"])["value"]
    parts = vector_to_array("features")
    return model.transform(events).select(
        "event_id",
        *[parts[i].cast("int").alias(f"slot{i}") for i in range(5)],
        F.round(parts[5], 6).alias("z_sample"),
        F.round(features.standardise(F.col("value"), mean, sd), 6).alias("z_population"),
    )


@query
def onehot_drop_last(spark, sf):
    """One-hot vectors without the rarest category's slot."""
    events = I.table(spark, sf, "events")
    model = features.feature_pipeline([], ["event_type"], one_hot=True, handle_invalid="error").fit(events)
    parts = vector_to_array("features")
    return model.transform(events).select("event_id", F.size(parts).alias("slots"), *[parts[i].cast("int").alias(f"slot{i}") for i in range(4)])


@query
def interaction_features(spark, sf):
    counters = ["logins_count", "pri_count", "ps_count"]
    products = features.interactions(counters)
    return activity(spark, sf).select(*KEYS, *[column.alias(name) for name, column in products.items()])


@query
def quantile_bins(spark, sf):
    events = I.table(spark, sf, "events").withColumn("k", I.k())
    edges = features.fit_quantile_edges(events, ["value", "k"], 4)
    return features.quantile_bins(events, edges).select("event_id", "value_bin", "k_bin")


@query
def box_stats(spark, sf):
    return eda.box_stats(I.table(spark, sf, "events"), "value", ["event_type"])


@query
def histogram_bins(spark, sf):
    bins = eda.histogram(I.table(spark, sf, "events"), "value")
    return bins.select("bin", "count", *[F.round(c, 6).alias(c) for c in ("bin_start", "bin_end", "density")])


@query
def density_histogram(spark, sf):
    bins = eda.density_histogram(I.table(spark, sf, "events"), "value", ["event_type"])
    return bins.select("event_type", "bin", "count", *[F.round(c, 6).alias(c) for c in ("bin_start", "bin_end", "density")])


@query
def normal_density(spark, sf):
    density = eda.normal_density(I.table(spark, sf, "events"), "value")
    return density.select("event_id", F.round("density", 9).alias("density"))


# ------------------------------------------------------------ event scoring

EVENT_SCORER = CentroidScorer(["num1", "num2"], [50.0, 49.5], [48.0, 29.0], [[0, 0], [1, 1], [-1, 0.5], [2, -1]], 4.0, 30.0)


def _event_scores(rows: DataFrame) -> DataFrame:
    return score_events(rows, "demo_traffic", ["num1", "num2"], ["cat1"], EVENT_SCORER, ALERT_WEIGHTS)


def _rounded(rows: DataFrame) -> DataFrame:
    kept = ["guid", "timestamp", "user_name", "entity_name", "source_type", "alerts", "alert_score", *DAY_COLS]
    return rows.select(*kept, F.round("event_score", 6).alias("event_score"))


@query
def event_batch_scoring(spark, sf):
    return _rounded(_event_scores(I.messages(spark, sf)))


@query
def event_stream_scoring(spark, sf):
    arriving = I.messages(spark, sf)
    incoming, out, mark = (scratch_path(spark, n) for n in ("messages", "event-scores", "event-checkpoint"))
    arriving.write.parquet(incoming)
    scored = _event_scores(topic.stream_files(spark, incoming, arriving.schema))
    write_stream(scored, out, mark, once=True).awaitTermination()
    return _rounded(spark.read.schema(scored.schema).parquet(out))


@query
def event_stream_batches(spark, sf):
    """The same through batches of a file each, whose small files are then written together."""
    arriving = I.messages(spark, sf)
    incoming, out, mark = (scratch_path(spark, n) for n in ("messages", "event-batches", "event-checkpoint"))
    arriving.repartition(3, "offset").write.parquet(incoming)
    schema = _event_scores(arriving).schema
    stream = topic.stream_files(spark, incoming, arriving.schema, per_batch=1)
    write_batches(stream, lambda rows, _model: _event_scores(rows), out, mark, once=True).awaitTermination()
    compact_batches(spark, out, schema)
    return _rounded(read_batches(spark, out, schema))


# ------------------------------------------------------------ trained models


@query
def kmeans_profile_pas(spark, sf):
    day_rows = written_activity(spark, sf)
    model = fit_distance_model(day_rows, PROFILE_COUNTERS, ["type"], KEYS)
    return model.score(day_rows).select(*KEYS, "cluster_id", F.round("PAS", 4).alias("PAS"))


def _traffic_numbers(spark, sf):
    parsed = I.traffic(spark, sf).withColumns(
        {"rcvd_bytes": received_bytes(F.col("info_1")), "sent_bytes": sent_bytes(F.col("info_2"))}
    )
    return materialise(parsed.withColumn("source", F.lit("traffic")).drop("info_1", "info_2"), "traffic")


TRAFFIC_KEYS = ["l_orderkey", "l_linenumber"]


@query
def kmeans_event_eas(spark, sf):
    events = _traffic_numbers(spark, sf)
    model = fit_distance_model(events, ["rcvd_bytes", "sent_bytes"], ["dst_port"], TRAFFIC_KEYS)
    return model.score(events, "EAS").select(*TRAFFIC_KEYS, F.round("EAS", 4).alias("EAS"))


@query
def iforest_profile_pas(spark, sf):
    day_rows = written_activity(spark, sf)
    forest = fit_forest(day_rows, PROFILE_COUNTERS)
    raw = materialise(forest.raw(day_rows, ["name"]), "raw")
    return scoring.minmax_scores(raw, "score", "PAS", GROUP_COLS).select(*KEYS, F.round("PAS", 4).alias("PAS"))


@query
def iforest_event_eas(spark, sf):
    events = _traffic_numbers(spark, sf)
    forest = fit_forest(events, ["sent_bytes", "rcvd_bytes"], ["dst_port", "src_port"], ["source"], TRAFFIC_KEYS, max_samples=0.3)
    raw = materialise(forest.raw(events, TRAFFIC_KEYS, rows_per_task=20_000), "raw")
    scored = scoring.minmax_scores(raw, "score", "EAS", ["source"])
    return scored.select(*TRAFFIC_KEYS, F.round("EAS", 4).alias("EAS"))


@query
def ocsvm_profile_pas(spark, sf):
    day_rows = written_activity(spark, sf)
    model = fit_one_class(day_rows, PROFILE_COUNTERS)
    raw = materialise(model.raw(day_rows, ["name"]), "raw")
    return scoring.minmax_scores(raw, "score", "PAS", GROUP_COLS).select(*KEYS, F.round("PAS", 4).alias("PAS"))


@query
def daily_train_and_score(spark, sf):
    scored = daily.train_and_score(activity(spark, sf))
    return sinks.score_rows(scored, execution_ms=1_700_000_000_000)


@query
def model_store_roundtrip(spark, sf):
    day_rows = written_activity(spark, sf)
    models = daily.train(day_rows, group_cols=["type"], key_cols=KEYS)
    path = modelstore.model_path(scratch_path(spark, "models"), "os_log", "profile", "detectors", "all")
    daily.save(spark, models, path)
    kept = daily.score(day_rows, models, KEYS).select(*KEYS, F.col("pas").alias("pas_before"))
    again = daily.score(day_rows, daily.load(spark, path), KEYS).select(*KEYS, F.col("pas").alias("pas_after"))
    both = materialise(kept, "before").join(materialise(again, "after"), KEYS)
    return both.select(*KEYS, (F.col("pas_before") == F.col("pas_after")).alias("same"))


#: saves that the days of the table are dealt over
SAVES = 3


def _stored_by_day(spark, sf):
    """All days trained and saved in turns into one store, then scored from it and from models of all days at once."""
    day_rows = written_activity(spark, sf)
    number = F.datediff(F.make_date(*DAY_COLS), F.lit("1970-01-01").cast("date"))
    dealt = day_rows.withColumn("_save", F.coalesce(F.pmod(number, F.lit(SAVES)), F.lit(0)))
    path = modelstore.model_path(scratch_path(spark, "models"), "os_log", "profile", "detectors", "day")
    for (save,) in sorted(dealt.select("_save").distinct().collect()):
        daily.save(spark, daily.train(materialise(dealt.where(F.col("_save") == save).drop("_save"), "days")), path)
    scored = daily.score(day_rows, daily.load(spark, path), ["name"])
    at_once = daily.score(day_rows, daily.train(day_rows), ["name"])
    both = materialise(scored, "scored").join(materialise(at_once.select(*KEYS, F.col("pas").alias("_pas")), "at-once"), KEYS)
    return both.select(*KEYS, "model_found", (F.abs(F.col("pas") - F.col("_pas")) <= 0.01).alias("same"))


@query
def model_store_every_day(spark, sf):
    return _stored_by_day(spark, sf)


@query
def event_model_stream(spark, sf):
    """A model trained on the intake, saved, loaded, and scoring the same messages as a batch and as a stream."""
    arriving = I.messages(spark, sf)
    training = materialise(topic.event_intake(arriving, "demo_traffic", ["num1", "num2"], ["cat1"]), "intake")
    path = modelstore.model_path(scratch_path(spark, "models"), "demo_traffic", "event", "kmeans")
    modelstore.save_distance(spark, fit_distance_model(training, ["num1", "num2"], ["cat1"], ["num1", "num2", "cat1"]), path)
    model = modelstore.load_distance(spark, path)

    def scored(rows):
        return score_events(rows, "demo_traffic", ["num1", "num2"], ["cat1"], model, ALERT_WEIGHTS)

    incoming, out, mark = (scratch_path(spark, n) for n in ("messages", "event-scores", "event-checkpoint"))
    arriving.write.parquet(incoming)
    batch = scored(arriving)
    write_stream(scored(topic.stream_files(spark, incoming, arriving.schema)), out, mark, once=True).awaitTermination()
    stream = spark.read.schema(batch.schema).parquet(out).select("guid", F.col("event_score").alias("_stream"))
    both = batch.join(stream, "guid")
    inside = F.col("event_score").between(0, 100)
    return both.select("guid", inside.alias("in_range"), (F.col("event_score") == F.col("_stream")).alias("same"))


def _requests(spark, sf):
    key = F.col("c_custkey")
    return I.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("request_id"),
        F.when(key % 5 != 0, "os_log").otherwise("other_log").alias("source"),
        F.when(key % 2 == 0, F.concat(F.lit("10.0.0."), (key % 40).cast("string"))).alias("src_ip"),
        F.when(key % 3 != 0, F.concat(F.lit("host"), (key % 150).cast("string"))).alias("user_name"),
        *[F.pmod(F.floor(F.col("c_acctbal")) + i * key, F.lit(7)).alias(c) for i, c in enumerate(PROFILE_COUNTERS)],
    )


@query
def request_routing(spark, sf):
    return requests.route(_requests(spark, sf)).select("request_id", "source", "type", "name")


@query
def request_scoring(spark, sf):
    training = materialise(activity(spark, sf).withColumn("source", F.lit("os_log")), "training")
    path = modelstore.model_path(scratch_path(spark, "models"), "os_log", "profile", "detectors", "requests")
    daily.save(spark, daily.train(training, group_cols=["source", "type"], key_cols=KEYS), path)
    scored = requests.score_stored(_requests(spark, sf), path, ["source", "type"], ["request_id"])
    return scored.select("request_id", "source", "type", "name", "pas", "model_found")


@query
def classifier_cv_accuracy(spark, sf):
    words = F.split("text", r"\s+")
    documents = I.table(spark, sf, "documents").select(
        "doc_id",
        "n_chars",
        F.size(words).alias("words"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct_share"),
    )
    study = I.table(spark, sf, "labels").join(documents, "doc_id")
    return classify.cross_validated_accuracy(study, ["n_chars", "words", "distinct_share"], "quality", ["doc_id"])
