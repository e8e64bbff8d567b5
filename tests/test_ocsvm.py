import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrail.operators import ocsvm
from sentrail.operators.ocsvm import fit_one_class, kernel, settle
from sentrail.operators.scoring import minmax_scores
from sentrail.session import materialise

NO_CATS = np.empty((0, 0), np.int64)


def test_kernel_equals_explicit_one_hot():
    z = np.array([[0.0], [1.0], [2.0]])
    c = np.array([[7, 5], [8, 0], [7, 6]])  # 0 is a missing category
    dense = np.array([[0, 1, 0, 1, 0], [1, 0, 1, 0, 0], [2, 1, 0, 0, 1]], float)
    expected = np.exp(-0.1 * ((dense[:, None] - dense[None]) ** 2).sum(-1))
    np.testing.assert_allclose(kernel(z, c, z, c, 0.1), expected)


def in_one_task(z, w, nu=0.5, gamma=0.1, tol=1e-8):
    """The whole problem at once: weights, gradients and offset."""
    c = np.empty((len(z), 0), np.int64)
    k, a, left = kernel(z, c, z, c, gamma), np.zeros(len(w)), nu * w.sum()
    for i in range(len(w)):
        a[i] = min(w[i], left)
        left -= a[i]
    g = k @ a
    settle(k, w, a, g, tol)
    free = (a > 1e-9 * w) & (a < w * (1 - 1e-9))
    rho = g[free].mean() if free.any() else (g[a >= w * (1 - 1e-9)].max() + g[a <= 1e-9 * w].min()) / 2
    return a, g, rho


def test_memory_of_the_kernel_does_not_grow_with_the_model():
    random = np.random.default_rng(2)
    a, b, weight = random.random((1_024, 9)), random.random((16_384, 9)), random.random(16_384)
    none = [np.zeros((len(x), 0), np.int64) for x in (a, b)]
    tracemalloc.start()
    found = ocsvm.similarity(a, none[0], b, none[1], weight, 0.1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # one matrix of all pairs takes 128 MB
    assert found[:9] == pytest.approx(kernel(a[:9], none[0][:9], b, none[1], 0.1) @ weight)


@pytest.mark.parametrize("n", [2, 40, 300])
def test_solution_meets_the_optimality_conditions(n):
    rng = np.random.default_rng(n)
    z, w = rng.standard_normal((n, 3)), rng.integers(1, 5, n).astype(float)
    a, g, rho = in_one_task(z, w)
    assert a.sum() == pytest.approx(0.5 * w.sum()) and (a >= 0).all() and (a <= w).all()
    assert (g[a <= 1e-9 * w] >= rho - 1e-6).all() and (g[a >= w * (1 - 1e-9)] <= rho + 1e-6).all()
    # at most a share nu of the rows lies strictly outside
    assert w[g - rho < -1e-6].sum() <= 0.5 * w.sum() + 1e-9


def gauss(spark, n, label, groups=1):
    rng = np.random.default_rng(n)
    rows = [(i, f"g{i % groups}", *map(float, rng.standard_normal(3))) for i in range(n)]
    return materialise(spark.createDataFrame(rows, "id long, type string, a double, b double, c double").repartition(4), label)


@pytest.mark.parametrize(("n", "working", "max_bytes"), [(60, 2_048, 1 << 28), (400, 64, 1 << 28), (400, 64, 1), (3_000, 400, 1 << 28)])
def test_decomposition_equals_the_whole_problem(spark, n, working, max_bytes):
    df = gauss(spark, n, "gauss")
    model = fit_one_class(df, ["a", "b", "c"], group_cols=["type"], working=working, max_bytes=max_bytes)
    assert all(r.gap <= 1e-4 for r in model.model.collect())
    rows = df.orderBy("id").collect()
    x = np.array([[r.a, r.b, r.c] for r in rows])
    _, g, rho = in_one_task((x - x.mean(0)) / x.std(0), np.ones(n))
    found = np.array([r.score for r in model.raw(df, ["id"], max_bytes=max_bytes).orderBy("id").collect()])
    # a share of the similarities' own scale
    np.testing.assert_allclose(found, rho - g, atol=5e-4 * g.max())


def test_every_chunk_of_changes_counts(spark, monkeypatch):
    df = gauss(spark, 500, "chunks", groups=2)
    whole = fit_one_class(df, ["a", "b", "c"], group_cols=["type"], working=100)
    monkeypatch.setattr(ocsvm, "CHUNK", 40)
    parts = fit_one_class(df, ["a", "b", "c"], group_cols=["type"], working=100)
    assert parts.model.count() > 2 * whole.model.count() == 4
    both = materialise(parts.raw(whole.raw(df, ["id"], "s1"), ["id"], "s2"), "both")
    assert both.agg(F.max(F.abs(F.col("s1") - F.col("s2")))).first()[0] < 0.05


def test_repeated_rows_equal_counted_rows(spark):
    rng = np.random.default_rng(5)
    base = [(float(a), float(b)) for a, b in rng.integers(0, 4, (60, 2))]
    rows = [(i, "g", *base[i % 60]) for i in range(240)]
    df = materialise(spark.createDataFrame(rows, "id long, type string, a double, b double"), "repeated")
    model = fit_one_class(df, ["a", "b"], group_cols=["type"])
    row = model.model.first()
    assert sum(row.alpha) == pytest.approx(120.0) and len(row.alpha) <= 16


def test_categories_missing_values_and_small_groups(spark):
    rows = [(i, "g" if i % 7 else None, None if i % 5 == 0 else float(i % 4), "xyz"[i % 3] if i % 4 else None) for i in range(60)]
    rows += [(100, "one", 1.0, "x"), (101, "two", 1.0, "x"), (102, "two", 2.0, None)]
    df = materialise(spark.createDataFrame(rows, "id long, type string, a double, c string"), "odd-svm")
    model = fit_one_class(df, ["a"], ["c"], ["type"])
    for max_bytes in (1 << 28, 1):
        scored = {r.id: r.score for r in model.raw(df, ["id"], max_bytes=max_bytes).collect()}
        assert len(scored) == len(rows)
        assert all((scored[i] is None) == (kind is None) for i, kind, *_ in rows)
    assert fit_one_class(df.where("id < 0"), ["a"], ["c"], ["type"]).model.isEmpty()


def test_scoring_in_place_moves_no_rows(spark, activity):
    from sentrail.functions.rules import PROFILE_COUNTERS
    from sentrail.operators.iforest import fit_forest

    keys = ["name", "y", "m", "d"]
    for model in (
        fit_one_class(activity, PROFILE_COUNTERS, group_cols=["type"]),
        fit_forest(activity, PROFILE_COUNTERS, group_cols=["type"], key_cols=keys, n_trees=20),
    ):
        inplace, met = model.raw(activity, keys), model.raw(activity, keys, rows_per_task=100, max_bytes=1)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (inplace, met)]
        # the scaling of a group is broadcast; nothing else moves
        assert "hashpartitioning" not in plans[0] and "hashpartitioning" in plans[1]
        pairs = inplace.join(met.withColumnRenamed("score", "other"), ["type", *keys])
        assert pairs.count() == activity.count() and pairs.where("abs(score - other) > 1e-9 or score is null or other is null").isEmpty()


def test_scores_do_not_depend_on_partitions(spark):
    df = gauss(spark, 600, "layout")
    one, two = (fit_one_class(d, ["a", "b", "c"], group_cols=["type"], working=128) for d in (df, materialise(df.repartition(7), "layout7")))
    scaled = minmax_scores(minmax_scores(two.raw(one.raw(df, ["id"], "s1"), ["id"], "s2"), "s1", "p1", ["type"]), "s2", "p2", ["type"])
    assert scaled.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0] < 0.05
