"""Readers, text formats, filters and windows on small hand-made inputs."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.functions import scores as S
from sentrail.functions.rules import OS_LOG_RULES
from sentrail.functions.text import alert_weight_score, ascii_text, received_bytes, sent_bytes
from sentrail.operators import classify, eda, features, profiles, scoring
from sentrail.sources import sinks, tables, topic


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "v string").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("text,expected", [("rcvd_bytes=12; app_id=0", 12), ("", 0), (None, 0), ("rubbish", 0)])
def test_received_bytes(spark, text, expected):
    assert one(spark, text, received_bytes) == expected


def test_sent_bytes(spark):
    assert one(spark, "sent_bytes=77", sent_bytes) == 77


def test_ascii_text(spark):
    assert one(spark, "aé{b}", ascii_text) == "a{b}"


@pytest.mark.parametrize("text,expected", [("is_nu=true,is_ne=false", 75.0), ("is_ne=TRUE", 25.0), ("", 0.0), (None, None)])
def test_alert_weight_score(spark, text, expected):
    assert one(spark, text, lambda c: alert_weight_score(c, {"is_nu": 3, "is_ne": 1})) == expected


def test_script_rule_needs_the_trailing_dot(spark):
    rows = [("4688", "C:/powershell.exe", "x"), ("4656", "a.ps1", "File"), ("4656", "a.ps1.bak", "File"), ("4656", "a.ps1.bak", "Network"), ("4688", "cmd.exe", "x")]
    df = spark.createDataFrame(rows, "windowseventid string, windowsprocessname string, windowslogontype string")
    assert [r.r for r in df.select(OS_LOG_RULES.script_activity().alias("r")).collect()] == [True, False, True, False, False]


def test_mail_profile_by_hand(spark):
    rows = [("m", ",10,20", "1"), ("m", "5, 6", "2"), ("m", "  ", "9"), ("n", "7,x", None)]
    found = {r.mail_id: tuple(r)[1:] for r in profiles.mail_profile(spark.createDataFrame(rows, "mail_id string, mail_size string, ext_sndrs string")).collect()}
    assert found == {"m": (3, 31, 3, 10.3333), "n": (2, 7, None, 3.5)}


def test_counter_rollup_merges_case(spark):
    df = spark.createDataFrame([("A", 1), ("a", 2), ("b", None)], "username string, n long")
    found = {r.username: r.n for r in profiles.counter_rollup(df, "username", lower=True, num_cols=["n"]).collect()}
    assert found == {"a": 3, "b": None}


def test_daily_activity_skips_incomplete_events_and_counts_both_actors(spark):
    columns = "devicehostname string, deviceaddress string, windowseventid string, windowsprocessname string, windowslogontype string, is_alert boolean, alerts_nu string, alerts_ne string, y int, m int, d int"
    rows = [("h", "1.1.1.1", "4634", "p", "File", True, "x", "", 2024, 1, 1), ("h", "", "4634", "p", "File", True, "x", "x", 2024, 1, 1), (None, "1.1.1.1", "4634", "p", "File", True, "x", "x", 2024, 1, 1)]
    found = {(r.name, r.type): r for r in profiles.daily_activity(spark.createDataFrame(rows, columns)).collect()}
    assert set(found) == {("h", "user"), ("1.1.1.1", "entity")}
    row = found["h", "user"]
    # one id feeds two counters
    assert (row.total_events, row.logins_count, row.failedlogin_count, row.is_nu_alert_count, row.is_ne_alert_count) == (1, 1, 1, 1, 0)


def test_assembly_keeps_actors_with_every_attribute(spark):
    rows = [("a", "x", "1"), ("a", "c", "red"), ("b", "x", "2"), ("c", "x", None), ("c", "c", "blue")]
    df = spark.createDataFrame(rows, "actor string, attribute string, value string")
    assert {tuple(r) for r in profiles.assemble_attributes(df, ["x"], ["c"]).collect()} == {("a", 1.0, "red"), ("c", None, "blue")}


def test_assembly_joins_repeated_attributes_and_survives_bad_numbers(spark):
    rows = [("a", "x", "1"), ("a", "x", "9"), ("a", "c", "red"), ("a", "c", "blue"), ("b", "x", "?"), ("b", "c", "red"), (None, "x", "1"), (None, "c", "red"), ("d", "x", "1"), ("d", "x", "2")]
    df = spark.createDataFrame(rows, "actor string, attribute string, value string")
    found = sorted((tuple(r) for r in profiles.assemble_attributes(df, ["x"], ["c"]).collect()), key=str)
    assert found == [("a", 1.0, "blue"), ("a", 1.0, "red"), ("a", 9.0, "blue"), ("a", 9.0, "red"), ("b", None, "red")]


def test_payload_pairs(spark):
    df = spark.createDataFrame([("x", '{"a": 1, "b": "2"}')], "attribute string, payload string")
    assert {tuple(r) for r in tables.payload_pairs(df, "payload", "attribute").collect()} == {("a", "x", "1"), ("b", "x", "2")}


def test_event_intake_defaults_and_order(spark):
    rows = [(0, 2, '{"source.type": "t_s", "n": "2.5"}'), (0, 1, '{"source.type": "t_s", "c": "é1"}'), (0, 0, '{"source.type": "other"}'), (0, 3, "not json")]
    df = spark.createDataFrame(rows, "partition int, offset long, value string")
    assert [tuple(r) for r in topic.event_intake(df, "t_s", ["n"], ["c"], limit=5).collect()] == [(0.0, "1"), (2.5, "")]
    assert topic.event_intake(df, "t_s", ["n"], ["c"]).count() == 2
    assert topic.event_intake(df, "t_s", ["n"], ["c"], limit=1).count() == 1


def test_day_slices_are_pruned(spark, activity, folder):
    sinks.write_scores_path(activity, folder + "/p")
    stored = spark.read.parquet(folder + "/p")
    day = tables.profile_day(stored, 2024, 1, 2, "user")
    assert day.count() == activity.where("y = 2024 and m = 1 and d = 2 and type = 'user'").count() > 0
    assert "PartitionFilters: [isnotnull(y" in day._jdf.queryExecution().executedPlan().toString()
    days = tables.profile_days(stored, "2024-01-03", 2)
    assert {r.d for r in days.select("d").distinct().collect()} == {2, 3}


def test_integer_projection(spark):
    df = spark.createDataFrame([("3", "x"), ("1", "7"), ("2", "8")], "k string, v string")
    assert [tuple(r) for r in tables.integer_projection(df, ["k", "v"], ["k"], limit=2).collect()] == [(1, 7), (2, 8)]
    assert tables.integer_projection(df, ["k", "v"]).count() == 3


def test_box_stats_by_hand(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x double")
    assert tuple(eda.box_stats(df, "x").first()) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 10.0)], "x double")
    found = [(r.bin, r["count"]) for r in eda.histogram(df, "x", bins=5).orderBy("bin").collect()]
    assert found == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 1)]
    flat = eda.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x", bins=2).orderBy("bin").collect()
    assert [r["count"] for r in flat] == [0, 2]


def test_minmax_clamps_and_handles_constants(spark):
    df = spark.createDataFrame([("a", -5.0), ("a", 5.0), ("a", 50.0), ("b", 1.0), ("c", 2.0)], "g string, x double")
    fitted = spark.createDataFrame([("a", 0.0, 10.0), ("b", 1.0, 1.0)], "g string, low double, high double")
    found = [(r.g, r.s, r.model_found) for r in scoring.minmax_scores(df, "x", "s", ["g"], fitted, 50.0).orderBy("g", "x").collect()]
    assert found == [("a", 0.0, True), ("a", 50.0, True), ("a", 100.0, True), ("b", 50.0, True), ("c", 0.0, False)]


def test_zscores_of_constant_and_single_rows_are_null(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 5), ("b", 1, 1)], "g string, x long, y long")
    found = scoring.zscores(df, ["x", "y"], ["g"]).withColumn("t", scoring.zscore_text()).orderBy("g", "x").collect()
    assert [r.t for r in found] == ['{"x":-0.7071,"y":null}', '{"x":0.7071,"y":null}', '{"x":null,"y":null}']


def test_labels_levels_and_split(spark):
    df = spark.createDataFrame([(60.0,), (60.5,), (None,)], "s double").withColumn("anomaly", S.anomaly_label(F.col("s")))
    normal, odd = scoring.split_by_label(df)
    assert [r.anomaly for r in df.collect()] == [0, 1, None] and normal.count() == odd.count() == 1
    with pytest.raises(ValueError):
        S.anomaly_level(F.col("s"), [1], ["a"])


def test_quantile_edges_and_interactions(spark):
    df = spark.range(1, 5).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).alias("b"))
    assert features.fit_quantile_edges(df, ["a"], 2) == {"a": [2.5]}
    assert list(features.interactions(["a", "b", "c"])) == ["a_x_b", "a_x_c", "b_x_c"]


def test_one_hot_gives_unknown_values_zeros(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "c string, x double")
    model = features.feature_pipeline(["x"], ["c"], one_hot=True).fit(train)
    row = model.transform(spark.createDataFrame([("z", 2.0)], "c string, x double")).first()
    assert row.features.toArray().tolist() == [0.0, 0.0, 0.0]


def test_windows_of_every_length(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:30:00' ts, 1 k, 2 v union all select timestamp_ntz'2024-01-01 23:30:00', 1, 3")
    found = {(r.time_window, r.events, r.v) for r in profiles.all_windows(df, "ts", ["k"], {"v": F.col("v")}).collect()}
    assert found == {("hour", 1, 2), ("hour", 1, 3), ("day", 2, 5), ("week", 2, 5), ("month", 2, 5)}


def test_classifier_study_finds_a_noisy_target(spark):
    rows = [(i, float(i * 7 % 10), float(i % 3), int((i * 7 % 10 >= 5) != (i % 11 == 0))) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double, t int")
    found = {r.classifier: r for r in classify.cross_validated_accuracy(df, ["a", "b"], "t", ["id"], trees=2, folds=2).collect()}
    assert set(found) == set(classify.CLASSIFIERS)
    assert found["random_forest"].continuous > 80 and found["logistic_regression"].discrete_onehot > 80
