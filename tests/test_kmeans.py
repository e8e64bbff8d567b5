import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrail.functions.rules import GROUP_COLS, PROFILE_COUNTERS
from sentrail.operators import kmeans
from sentrail.operators.kmeans import CentroidScorer, fit_distance_model, fit_grouped_distance
from sentrail.session import materialise

KEYS = ["name", *GROUP_COLS]


def test_fit_equals_plain_iterations_from_the_same_starts(activity):
    starts = fit_grouped_distance(activity, PROFILE_COUNTERS, group_cols=["type"], max_iter=0)
    fitted = fit_grouped_distance(activity, PROFILE_COUNTERS, group_cols=["type"])
    scale = {r.type: (np.array(r._means), np.array(r._sds)) for r in fitted.scaling.collect()}
    ends = {r.type: np.array(r._centroids) for r in fitted.centroids.collect()}
    for row in starts.centroids.collect():
        x = np.array([[r[c] for c in PROFILE_COUNTERS] for r in activity.where(F.col("type") == row.type).collect()], float)
        x = np.rint((x - scale[row.type][0]) / scale[row.type][1] * 1e6)
        centres = np.array(row._centroids) * 1e6
        for _ in range(20):
            near = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
            moved = np.array([x[near == j].mean(0) if (near == j).any() else centres[j] for j in range(len(centres))])
            shift, centres = ((moved - centres) ** 2).sum(1).max(), moved
            if shift <= (1e-4 * 1e6) ** 2:
                break
        np.testing.assert_allclose(ends[row.type], centres / 1e6, atol=1e-6)


def test_grouped_fit_does_not_depend_on_partitions(activity):
    one = fit_grouped_distance(activity.coalesce(1), PROFILE_COUNTERS, group_cols=["type"])
    many = fit_grouped_distance(activity.repartition(9), PROFILE_COUNTERS, group_cols=["type"])
    for a, b in zip(*(m.centroids.orderBy("type").collect() for m in (one, many))):
        np.testing.assert_allclose(a._centroids, b._centroids, atol=2e-6)


def test_fewer_distinct_vectors_than_clusters(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 3.0), ("h", 7.0)], "type string, x double")
    model = fit_grouped_distance(df, ["x"], group_cols=["type"])
    sizes = {r.type: len(r._centroids) for r in model.centroids.collect()}
    assert sizes == {"g": 2, "h": 1}
    assert model.raw(df).where("sed is null").isEmpty()


def test_raw_distance_matches_numpy(activity):
    model = fit_grouped_distance(activity, PROFILE_COUNTERS, group_cols=["type"])
    centres = {r.type: np.array(r._centroids) for r in model.centroids.collect()}
    scale = {r.type: (np.array(r._means), np.array(r._sds)) for r in model.scaling.collect()}
    for row in model.raw(activity).limit(50).collect():
        mean, sd = scale[row.type]
        z = (np.array([row[c] for c in PROFILE_COUNTERS]) - mean) / sd
        assert row.sed == pytest.approx(np.sqrt(((centres[row.type] - z) ** 2).sum(1)).sum(), rel=1e-9)


def test_single_model_covers_the_scale_and_repeats(activity):
    first = fit_distance_model(activity, PROFILE_COUNTERS, ["type"], KEYS)
    again = fit_distance_model(activity.repartition(5), PROFILE_COUNTERS, ["type"], KEYS)
    assert first.centroids == again.centroids
    ends = first.score(activity).agg(F.min("PAS"), F.max("PAS"), F.count("PAS")).first()
    assert tuple(ends) == (0.0, 100.0, activity.count())


def test_single_model_lays_its_rows_out_once(spark, monkeypatch):
    seen, lay_out = spark.sparkContext.accumulator(0), kmeans.fixed_layout

    @F.udf("double")
    def value(x):
        seen.add(1)
        return x

    monkeypatch.setattr(kmeans, "fixed_layout", lambda *args: lay_out(*args).withColumn("x", value("x")))
    rows = materialise(spark.createDataFrame([(i, float(i % 7), "ab"[i % 2]) for i in range(60)], "id long, x double, c string"), "rows")
    fit_distance_model(rows, ["x"], ["c"], ["id"])
    assert seen.value == 60


def test_unseen_category_keeps_its_row_unless_skipped(spark):
    train = spark.createDataFrame([(i, float(i % 5), "ab"[i % 2]) for i in range(40)], "id long, x double, c string")
    unseen = spark.createDataFrame([(1, 1.0, "z"), (2, 1.0, None), (3, 1.0, "a")], "id long, x double, c string")
    kept = fit_distance_model(train, ["x"], ["c"], ["id"])
    skipped = fit_distance_model(train, ["x"], ["c"], ["id"], handle_invalid="skip")
    assert kept.score(unseen).where("PAS is not null").count() == 3
    assert skipped.score(unseen).count() == 1


def test_missing_numbers_lie_at_the_mean(spark):
    rows = [(i, i % 5, float(i % 7)) for i in range(35)] + [(99, None, 3.0), (100, 2, None), (101, 2, float("nan"))]
    df = spark.createDataFrame(rows, "id long, a int, b double")
    model = fit_distance_model(df, ["a", "b"], [], ["id"], k=3)
    at_mean = spark.createDataFrame([(1, None, None), (2, 2, 3.0)], "id long, a int, b double")
    assert model.score(df).where("PAS is null or isnan(PAS)").isEmpty()
    one, two = (r.sed for r in model.raw(at_mean).orderBy("id").collect())
    assert one == pytest.approx(two, abs=1e-9)


def test_one_hot_can_leave_out_the_last_category(spark):
    df = spark.createDataFrame([(i, "abbccc"[i % 6]) for i in range(30)], "id long, c string")
    for invalid, width in (("keep", 3), ("error", 2)):
        assert len(fit_distance_model(df, [], ["c"], ["id"], 2, one_hot=True, handle_invalid=invalid).centroids[0]) == width


def test_constant_training_set_scores_fifty(spark):
    df = spark.createDataFrame([(i, 2.0) for i in range(10)], "id long, x double")
    model = fit_distance_model(df, ["x"], [], ["id"])
    assert {r.PAS for r in model.score(df).collect()} == {50.0}


def test_planted_outlier_ranks_first(spark):
    rows = [(i, float(i % 7), float(i % 5)) for i in range(500)] + [(999, 300.0, -200.0)]
    df = materialise(spark.createDataFrame(rows, "id long, a double, b double").withColumn("g", F.lit("all")), "planted")
    single = fit_distance_model(df, ["a", "b"], [], ["id"]).score(df)
    grouped = fit_grouped_distance(df, ["a", "b"], group_cols=["g"]).raw(df, "PAS")
    for scored in (single, grouped):
        assert scored.orderBy(F.desc("PAS")).first().id == 999


def test_centroid_scorer_arithmetic(spark):
    scorer = CentroidScorer(["x"], [1.0], [2.0], [[0.0], [3.0]], 0.0, 10.0)
    row = scorer.score(scorer.raw(spark.createDataFrame([(5.0,)], "x double"))).first()
    assert row.sed == pytest.approx(2.0 + 1.0) and row.PAS == pytest.approx(30.0)
