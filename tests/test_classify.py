import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrail.operators import classify


def study(spark, n=400):
    rows = [(k, float((k * 7919) % 101), float((k * 104729) % 97), int(((k * 7919) % 101) + ((k * 31) % 13) > 55)) for k in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, label int")


def test_linear_models_reach_the_optimum(spark):
    df = classify.feature_sets(study(spark), ["a", "b"]).selectExpr("cast(label as double) label", *classify.FEATURE_SETS, "cast(id % 5 as int) fold")
    models = classify.fit_linear(df.cache(), 2, 320, (1.0, 1.0), 5)
    rows = df.collect()
    for m in models:
        x = np.array([r[classify.FEATURE_SETS[m.features]] + [1.0] for r in rows if r.fold != m.held])
        sign = np.array([2 * r.label - 1 for r in rows if r.fold != m.held])

        def objective(w):
            return classify.losses(m.name, sign * (x @ w), classify.ROUNDING[-1])[0].mean() + m.penalty / 2 * (w[:-1] ** 2).sum()

        best = objective(m.weights)
        random = np.random.default_rng(0)
        for size in (1e-3, 1e-2, 0.1, 1.0):
            assert all(objective(m.weights + size * random.standard_normal(3)) >= best - 1e-5 for _ in range(50)), m.name


def test_the_study_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(x):
        seen.add(1)
        return x

    classify.cross_validated_accuracy(study(spark, 100).withColumn("a", value("a")), ["a", "b"], "label", ["id"], trees=2)
    assert seen.value == 100


def test_equal_rows_are_counted(spark):
    rows = spark.createDataFrame([(1.0, 0, [0.0], [0.5]), (1.0, 0, [0.0], [0.7]), (0.0, 0, [0.0], [0.5])], f"label double, fold int, {classify.FEATURE_SETS[0]} array<double>, {classify.FEATURE_SETS[1]} array<double>")
    points = classify._counted(rows, classify.TASK_ROWS * 3)
    assert sorted((r.features, r.label, r.x, r.n) for r in points.collect()) == [(0, 0.0, [0.0], 1), (0, 1.0, [0.0], 2), (1, 0.0, [0.5], 1), (1, 1.0, [0.5], 1), (1, 1.0, [0.7], 1)]


def test_splits_are_the_best_ones():
    random = np.random.default_rng(3)
    bins = random.integers(0, 6, (200, 3))
    zeros, ones = random.integers(0, 4, 200).astype(float), random.integers(0, 4, 200).astype(float)

    def impure(mask):
        a, b = zeros[mask].sum(), ones[mask].sum()
        return 2 * a * b / max(a + b, 1e-300)

    value, feature, cut = classify.best_splits(np.zeros(200, int), bins, 1, 6, zeros, ones, classify._gini(None))
    gains = {(f, c): impure(np.ones(200, bool)) - impure(bins[:, f] <= c) - impure(bins[:, f] > c) for f in range(3) for c in range(5)}
    assert value[0] == pytest.approx(max(gains.values())) and gains[feature[0], cut[0]] == pytest.approx(value[0])


def test_boosting_lowers_the_loss_and_learns_a_step():
    bins = np.array([[k // 10, k % 10] for k in range(100)])
    ones = np.where((bins[:, 0] > 4) ^ (bins[:, 1] > 6), 9.0, 1.0)
    zeros = 10 - ones
    loss = lambda odds: (ones * np.logaddexp(0, -odds) + zeros * np.logaddexp(0, odds)).sum()
    losses = [loss(classify.boosted(bins, zeros, ones, trees)) for trees in (0, 5, 20, 100)]
    assert losses == sorted(losses, reverse=True)
    assert ((classify.boosted(bins, zeros, ones, 100) > 0) == (ones > 5)).all()
    assert ((classify.forest_votes(bins, zeros, ones, range(100), (1,)) > 50) == (ones > 5)).mean() > 0.9


def test_the_study_does_not_depend_on_partitions_and_rejects_other_labels(spark):
    df = study(spark)
    one, two = (classify.cross_validated_accuracy(d, ["a", "b"], "label", ["id"], trees=30).collect() for d in (df.coalesce(1), df.repartition(6)))
    assert one == two and [r.classifier for r in one] == list(classify.CLASSIFIERS)
    assert all(r.continuous > 85 for r in one)
    more = df.union(spark.createDataFrame([(1, 1.0, 1.0, 2)], df.schema))
    with pytest.raises(ValueError, match="0 or 1"):
        classify.cross_validated_accuracy(more, ["a", "b"], "label", ["id"])
    nothing = classify.cross_validated_accuracy(df.where("id < 0"), ["a", "b"], "label", ["id"]).collect()
    assert all(r.continuous is None for r in nothing) and len(nothing) == 6


def test_the_registered_study_grows_all_trees(spark, sf, monkeypatch):
    from registry import queries

    asked = []
    monkeypatch.setattr(classify, "cross_validated_accuracy", lambda *args, **options: asked.append(options))
    queries.classifier_cv_accuracy(spark, sf)
    assert asked == [{}] and classify.TREES == 400
