"""Compare classifiers on binned and on scaled features by cross-validated accuracy.

All folds and both feature sets share every pass. Linear models are fitted by Newton steps: a pass adds up loss, gradient
and curvature of all models per partition, the driver solves systems of one row per feature. Trees see a feature's quantile
bins only, so rows of equal bins and label are counted together first, and what is left, at most ``CELLS`` cells
whatever the number of rows, is a task's whole input: forests are dealt out by trees, boosting by fold and set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrail.operators.features import fit_moments, fit_quantile_edges, quantile_bin, standardise
from sentrail.session import materialise

# Folds and bins of the study, and its feature sets and classifiers as they are named in results.
FOLDS = 5
BINS = 2
FEATURE_SETS = ("discrete_onehot", "continuous")
CLASSIFIERS = (
    "support_vector",
    "random_forest",
    "logistic_regression",
    "gradient_boost",
    "sgd_classifier",
    "ridge_classifier",
)
#: trees, a boosting step's share, and depths of both kinds of trees
TREES = 400
LEARNING_RATE = 0.1
FOREST_DEPTH, BOOST_DEPTH = 5, 3
#: a feature's bins for the trees, and cells that they may make in all: with more features each has fewer bins
TREE_BINS = 32
CELLS = 1 << 20
#: trees of a forest in one task
TREES_PER_TASK = 25
#: rows that a task of the linear models takes in
TASK_ROWS = 20_000
#: the hinge is rounded off over this width, narrower each time the models have settled; at first no margin near 0 is beyond it
ROUNDING = (2.0, 0.5, 0.1, 0.02)
NEWTON_STEPS = 100
SHARES = (1.0, 0.3, 0.1, 0.02)
DAMPING = (0.0, 0.01, 0.3)
TOLERANCE = 1e-7


def fold_of(key_cols: Sequence[str], folds: int, seed: int):
    """Fold by a hash of the key: the same rows in any layout."""
    return F.pmod(F.xxhash64(F.lit(seed), *key_cols), F.lit(folds)).cast("int")


def feature_sets(df: DataFrame, num_cols: Sequence[str], bins: int = BINS) -> DataFrame:
    """Adds ``discrete_onehot`` (ordinal quantile bins) and ``continuous`` (scaled numbers) as arrays, both
    fitted on all rows, and ``_cells``, the bins that trees see of the scaled numbers. A missing number
    is in the lowest bin and at the mean."""
    finest = max(2, min(TREE_BINS, int(CELLS ** (1 / max(1, len(num_cols))) + 1e-9)))
    if BINS ** len(num_cols) > CELLS:
        raise ValueError(f"{len(num_cols)} features make more than {CELLS} cells")
    edges, moments = fit_quantile_edges(df, num_cols, bins), fit_moments(df, num_cols)
    finer = fit_quantile_edges(df, num_cols, finest)
    binned = lambda found: F.array(*[F.coalesce(quantile_bin(F.col(c).cast("double"), found[c]), F.lit(0)) for c in num_cols])
    scaled = [F.coalesce(standardise(F.col(c).cast("double"), *[m or 0.0 for m in moments[c]]), F.lit(0.0)) for c in num_cols]
    made = {FEATURE_SETS[0]: binned(edges).cast("array<double>"), FEATURE_SETS[1]: F.array(*scaled), "_cells": binned(finer)}
    return df.withColumns(made)


# ------------------------------------------------------------ linear models


@dataclass
class Linear:
    """One linear model of one held-out fold: its weights, and those that are tried next."""

    name: str
    features: int
    held: int
    penalty: float
    weights: np.ndarray
    trials: list[np.ndarray] = field(default_factory=list)
    loss: float = np.inf
    done: bool = False


def losses(name: str, margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss of each margin (label times score), its slope and its curvature."""
    if name == "logistic_regression":
        chance = 1 / (1 + np.exp(np.clip(margin, -500, 500)))
        return np.logaddexp(0, -margin), -chance, chance * (1 - chance)
    if name == "ridge_classifier":
        return (1 - margin) ** 2 / 2, margin - 1, np.ones_like(margin)
    short = 1 + width - margin  # a hinge that is a parabola within ``width`` of its kink
    bent = (short > 0) & (short < 2 * width)
    loss = np.where(bent, short**2 / (4 * width), np.maximum(1 - margin, 0))
    return loss, np.where(bent, -short / (2 * width), np.where(short > 0, -1.0, 0.0)), bent / (2 * width)


def _counted(data: DataFrame, rows: int) -> DataFrame:
    """Rows of equal features, label and fold once for each feature set, with their number ``n``: written, in as many parts as the work needs."""
    sets = [F.struct(F.lit(k).alias("features"), F.col(name).alias("x")) for k, name in enumerate(FEATURE_SETS)]
    key = ["features", "label", "fold", "x"]
    counted = data.select("label", "fold", F.inline(F.array(*sets))).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return materialise(counted.repartition(1 + rows // TASK_ROWS, *key), "study-points")


def _sums(points: DataFrame, models: list[Linear], balance: tuple[float, float], width: float) -> list[list[np.ndarray]]:
    """For every trial of every model: weight, loss, gradient and curvature, summed over its training rows."""
    size = len(models[0].weights)
    parts = [(m.name, m.features, m.held, trial) for m in models for trial in m.trials]

    def run(batches):
        total = np.zeros((len(parts), 2 + size + size * size))
        for batch in batches:
            of, labels, folds, counts = (batch.column(name).to_numpy() for name in ("features", "label", "fold", "n"))
            flat = np.array(batch.column("x").flatten(), float).reshape(len(of), size - 1)
            for features_ in np.unique(of).tolist():
                mine = of == features_
                x, sign, fold, count = np.column_stack([flat[mine], np.ones(mine.sum())]), 2 * labels[mine] - 1, folds[mine], counts[mine].astype(float)
                weight = np.where(sign > 0, balance[1], balance[0]) * count
                for k, (name, features, held, trial) in enumerate(parts):
                    if features != features_:
                        continue
                    w = np.where(fold == held, 0.0, weight if name in BALANCED else count)
                    loss, slope, curve = losses(name, sign * (x @ trial), width)
                    total[k, 0] += w.sum()
                    total[k, 1] += w @ loss
                    total[k, 2 : 2 + size] += x.T @ (w * slope * sign)
                    total[k, 2 + size :] += ((x.T * (w * curve)) @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), _rows(total)], names=["model", "sums"])

    made = points.mapInArrow(run, "model long, sums array<double>")
    added = made.select("model", F.posexplode("sums").alias("place", "x")).groupBy("model", "place").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros((len(parts), 2 + size + size * size))  # a bounded table: trials by squared features
    out[added["model"].to_numpy(), added["place"].to_numpy()] = added["x"].to_numpy()
    rows = iter(out)
    return [[next(rows) for _ in m.trials] for m in models]


#: classifiers that weigh both labels alike in sum
BALANCED = ("sgd_classifier", "ridge_classifier")
HINGED = ("support_vector", "sgd_classifier")


def _rows(matrix: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(matrix).ravel()))


def fit_linear(data: DataFrame, width: int, rows: int, balance: tuple[float, float], folds: int, steps: int = NEWTON_STEPS) -> list[Linear]:
    """Every linear model of every feature set and held-out fold, fitted in the same passes.

    The usual penalty strength of one over the whole sum of losses is 1/rows here, where losses are averaged;
    the intercept is free. A pass tries several lengths of every model's step, and the best is taken.
    """
    names = [name for name in CLASSIFIERS if name not in ("random_forest", "gradient_boost")]
    penalty = lambda name: 1e-4 if name == "sgd_classifier" else 1.0 / rows
    models = [Linear(name, k, held, penalty(name), np.zeros(width + 1)) for name in names for k in range(len(FEATURE_SETS)) for held in range(folds)]
    free = np.append(np.ones(width), 0.0)
    points = _counted(data, rows)
    for rounding in ROUNDING:
        live = [m for m in models if rounding == ROUNDING[0] or m.name in HINGED]
        for m in live:
            m.trials, m.loss, m.done = [m.weights], np.inf, False
        for _ in range(steps):
            open_ = [m for m in live if not m.done]
            if not open_:
                break
            for m, tried in zip(open_, _sums(points, open_, balance, rounding), strict=True):
                loss = [sums[1] / max(sums[0], 1e-300) + m.penalty / 2 * float((free * w**2).sum()) for sums, w in zip(tried, m.trials, strict=True)]
                best = int(np.argmin(loss))
                m.done = not loss[best] < m.loss - TOLERANCE * max(abs(loss[best]), 1e-12)
                if loss[best] < m.loss:
                    m.weights, m.loss, sums = m.trials[best], loss[best], tried[best]
                    total = max(sums[0], 1e-300)
                    gradient = sums[2 : 3 + width] / total + m.penalty * free * m.weights
                    curvature = sums[3 + width :].reshape(width + 1, width + 1) / total + np.diag(m.penalty * free + 1e-10)
                    # where few rows lie on a hinge's bend the curvature says little: shorter, damped steps too
                    steps_ = [np.linalg.solve(curvature + damping * np.eye(width + 1), gradient) for damping in DAMPING]
                    m.trials = [m.weights - share * step for step in steps_ for share in SHARES]
    return models


def _linear_accuracy(data: DataFrame, models: list[Linear]) -> dict[tuple[str, int], list[tuple[int, int]]]:
    """(right, rows) of every model on its held-out fold, in one pass."""
    parts = [(m.features, m.held, m.weights) for m in models]

    def run(batches):
        total = np.zeros((len(parts), 2))
        for batch in batches:
            label, fold = batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            x = [np.array(batch.column(name).flatten(), float).reshape(len(label), -1) for name in FEATURE_SETS]
            for k, (features, held, weights) in enumerate(parts):
                mine = fold == held
                total[k] += ((x[features][mine] @ weights[:-1] + weights[-1] > 0) == (label[mine] > 0)).sum(), mine.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array(total[:, 0]), pa.array(total[:, 1])], names=["model", "right", "rows"])

    made = data.select("label", "fold", *FEATURE_SETS).mapInArrow(run, "model long, right double, rows double")
    out: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for row in made.groupBy("model").agg(F.sum("right").alias("right"), F.sum("rows").alias("rows")).collect():
        m = models[row["model"]]
        out.setdefault((m.name, m.features), []).append((row["right"], row["rows"]))
    return out


# ------------------------------------------------------------ trees over counted cells


def best_splits(node: np.ndarray, bins: np.ndarray, nodes: int, width: int, first: np.ndarray, second: np.ndarray, gain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node: the best gain, its feature and the last bin that goes left. ``gain`` compares the sums of two sides."""
    out = np.full((bins.shape[1], nodes), -np.inf)
    at = np.zeros((bins.shape[1], nodes), int)
    for f in range(bins.shape[1]):
        place = node * width + bins[:, f]
        left = [np.cumsum(np.bincount(place, v, nodes * width).reshape(nodes, width), axis=1) for v in (first, second)]
        found = gain(left[0], left[1], left[0][:, -1:], left[1][:, -1:], f)
        at[f] = found.argmax(axis=1)
        out[f] = found[np.arange(nodes), at[f]]
    feature = out.argmax(axis=0)
    return out[feature, np.arange(nodes)], feature, at[feature, np.arange(nodes)]


def grow(bins: np.ndarray, first: np.ndarray, second: np.ndarray, depth: int, gain) -> np.ndarray:
    """The leaf of every cell in a tree grown on sums of ``first`` and ``second``; nodes without gain stay whole."""
    width = int(bins.max(initial=0)) + 1
    node = np.zeros(len(bins), int)
    for level in range(depth):
        nodes = 1 << level
        value, feature, cut = best_splits(node, bins, nodes, width, first, second, gain)
        right = (bins[np.arange(len(bins)), feature[node]] > cut[node]) & (value[node] > 1e-12)
        node = 2 * node + right
    return node


def _gini(chosen: np.ndarray | None):
    """How much purer two sides are than the whole; ``chosen`` says which features a node may use."""

    def gain(zeros, ones, all_zeros, all_ones, f):
        def impure(a, b):
            return 2 * a * b / np.maximum(a + b, 1e-300)

        better = impure(all_zeros, all_ones) - impure(zeros, ones) - impure(all_zeros - zeros, all_ones - ones)
        sides = (zeros + ones > 0) & (all_zeros + all_ones - zeros - ones > 0)
        allowed = True if chosen is None else chosen[: len(zeros), f][:, None]
        return np.where(sides & allowed, better, -np.inf)

    return gain


def forest_votes(bins: np.ndarray, zeros: np.ndarray, ones: np.ndarray, trees: Sequence[int], seed: Sequence[int], depth: int = FOREST_DEPTH) -> np.ndarray:
    """Sum over trees of each cell's share of ones in its leaf. Rows count Poisson(1) times in a tree, cells the sum of theirs."""
    votes = np.zeros(len(bins))
    wanted = max(1, int(np.ceil(np.sqrt(bins.shape[1]))))
    for tree in trees:
        random = np.random.default_rng([*seed, tree])
        drawn = [random.poisson(side).astype(float) for side in (zeros, ones)]
        chosen = random.random((1 << depth, bins.shape[1])).argsort(axis=1).argsort(axis=1) < wanted
        leaf = grow(bins, *drawn, depth, _gini(chosen))
        a, b = (np.bincount(leaf, side, 1 << depth) for side in drawn)
        votes += np.where(a + b > 0, b / np.maximum(a + b, 1), 0.5)[leaf]
    return votes


def boosted(bins: np.ndarray, zeros: np.ndarray, ones: np.ndarray, trees: int, depth: int = BOOST_DEPTH, rate: float = LEARNING_RATE) -> np.ndarray:
    """Log odds of every cell after ``trees`` rounds of gradient boosting with Newton leaves."""
    n = zeros + ones
    prior = np.clip(ones.sum() / max(n.sum(), 1), 1e-6, 1 - 1e-6)
    odds = np.full(len(bins), np.log(prior / (1 - prior)))

    def gain(residual, rows, all_residual, all_rows, f):
        rest, others = all_residual - residual, all_rows - rows
        better = residual**2 / np.maximum(rows, 1e-300) + rest**2 / np.maximum(others, 1e-300) - all_residual**2 / np.maximum(all_rows, 1e-300)
        return np.where((rows > 0) & (others > 0), better, -np.inf)

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-odds))
        residual = ones - n * chance
        leaf = grow(bins, residual, n, depth, gain)
        up, down = np.bincount(leaf, residual, 1 << depth), np.bincount(leaf, n * chance * (1 - chance), 1 << depth)
        odds = odds + rate * np.clip(up / np.maximum(down, 1e-12), -10, 10)[leaf]
    return odds


def _tree_accuracy(cells: DataFrame, trees: int, folds: int, seed: int) -> dict[tuple[str, int], list[tuple[int, int]]]:
    """(right, rows) of both kinds of trees on every held-out fold. ``cells``: features, fold, bins, zeros, ones."""
    cells = cells.withColumn("held", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    chunks = F.sequence(F.lit(-1), F.lit(-(-trees // TREES_PER_TASK) - 1))  # -1 boosts
    dealt = cells.withColumn("chunk", F.explode(chunks))

    def train(key: tuple, table: pa.Table) -> pa.Table:
        features, held, chunk = (part.as_py() for part in key)
        bins = np.array(table["bins"].combine_chunks().flatten(), np.int64).reshape(table.num_rows, -1)
        fold, zeros, ones = (table[name].to_numpy() for name in ("fold", "zeros", "ones"))
        order = np.lexsort((fold, *bins.T))  # the same draws in any layout
        bins, fold, zeros, ones = bins[order], fold[order], zeros[order].astype(float), ones[order].astype(float)
        mine = fold == held
        train_zeros, train_ones = np.where(mine, 0, zeros), np.where(mine, 0, ones)
        if chunk < 0:
            score, weight = boosted(bins, train_zeros, train_ones, trees), 1
        else:
            some = range(chunk * TREES_PER_TASK, min(trees, (chunk + 1) * TREES_PER_TASK))
            score, weight = forest_votes(bins, train_zeros, train_ones, some, (seed, features, held)) - len(some) / 2, 1
        at = np.flatnonzero(mine)
        columns = [np.full(len(at), features), np.full(len(at), held), np.full(len(at), chunk < 0), at, score[at] * weight, zeros[at], ones[at]]
        return pa.table([pa.array(c) for c in columns], names=["features", "held", "boost", "cell", "score", "zeros", "ones"])

    schema = "features long, held long, boost boolean, cell long, score double, zeros double, ones double"
    scored = dealt.groupBy("features", "held", "chunk").applyInArrow(train, schema)
    whole = scored.groupBy("features", "held", "boost", "cell").agg(F.sum("score").alias("score"), F.first("zeros").alias("zeros"), F.first("ones").alias("ones"))
    right = F.sum(F.when(F.col("score") > 0, F.col("ones")).otherwise(F.col("zeros")))
    out: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for row in whole.groupBy("features", "held", "boost").agg(right.alias("right"), F.sum(F.col("zeros") + F.col("ones")).alias("rows")).collect():
        out.setdefault(("gradient_boost" if row["boost"] else "random_forest", row["features"]), []).append((row["right"], row["rows"]))
    return out


def cross_validated_accuracy(
    df: DataFrame,
    num_cols: Sequence[str],
    label: str,
    key_cols: Sequence[str],
    trees: int = TREES,
    folds: int = FOLDS,
    seed: int = 1,
) -> DataFrame:
    """Accuracy in percent, the mean over folds, one row per classifier and one column per feature set.

    Labels other than 0 and 1 are an error; rows without a label are left out; a fold without rows counts nowhere.
    """
    spark = df.sparkSession
    # written first: bins and scaling read it many times, and what ``df`` is made of may be far larger
    columns = [F.col(c) for c in dict.fromkeys([*key_cols, *num_cols])]
    named = F.col(label).cast("double").alias("_label")
    labelled = materialise(df.where(F.col(label).isNotNull()).select(*columns, named), "study-rows").withColumn("label", F.col("_label"))
    others = labelled.where(~F.col("label").isin(0.0, 1.0)).limit(1).collect()
    if others:
        raise ValueError(f"labels are 0 or 1, not {others[0]['label']}")
    made = feature_sets(labelled, num_cols)
    data = materialise(made.select("label", *FEATURE_SETS, "_cells", fold_of(key_cols, folds, seed).alias("fold")), "study")
    count = {row["label"]: row["n"] for row in data.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(count.values())
    balance = tuple(total / (2.0 * max(count.get(value, 0), 1)) for value in (0.0, 1.0))
    results: dict[tuple[str, int], list[tuple[int, int]]] = {}
    if total:
        models = fit_linear(data, len(num_cols), max(1, total * (folds - 1) // folds), balance, folds)
        results |= _linear_accuracy(data, models)
        sets = [F.struct(F.lit(k).cast("long").alias("features"), bins.alias("bins")) for k, bins in enumerate((F.col(FEATURE_SETS[0]).cast("array<int>"), F.col("_cells")))]
        cells = data.select("fold", "label", F.inline(F.array(*sets))).groupBy("features", "fold", "bins")
        cells = cells.agg(F.count(F.when(F.col("label") == 0.0, 1)).alias("zeros"), F.count(F.when(F.col("label") == 1.0, 1)).alias("ones"))
        results |= _tree_accuracy(materialise(cells, "study-cells"), trees, folds, seed)
    rows = []
    for name in CLASSIFIERS:
        found = [[right / n for right, n in results.get((name, k), []) if n] for k in range(len(FEATURE_SETS))]
        rows.append((name, *[100.0 * sum(f) / len(f) if f else None for f in found]))
    return spark.createDataFrame(rows, f"classifier string, {', '.join(f'{f} double' for f in FEATURE_SETS)}")
