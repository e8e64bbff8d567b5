"""One-class SVM with an RBF kernel, one per group, by one decomposition method for every group size.

Schoelkopf et al., "Estimating the Support of a High-Dimensional Distribution", 2001; the decomposition follows
Osuna et al., 1997, and Joachims, 1999. Rows with equal features are one weighted point, which keeps counter profiles
small. Every point carries its weight in the solution and its gradient. A pass

1. takes from each group the points that violate optimality most, ``working`` / 2 whose weight should grow and as many
   whose weight should fall: the best of every task, then the best of all;
2. solves the problem over these points in one task, which holds a kernel matrix of ``working`` rows at most;
3. sends the changed points to all tasks, which add their kernel rows to the gradients where the points lie.

A group is done when no pair of points violates optimality by more than ``tolerance`` times its largest gradient; that
share is kept as ``gap``. Groups of up to ``working`` / 2 points are solved in one pass, others in more; nothing
else depends on the size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentrail.operators.encoding import EXPANSION, MODEL_BYTES, Scorer, distinct_rows, encode, features, fit_scaling, score_rows
from sentrail.operators.grouped import join_small
from sentrail.session import materialise, row_count, written_bytes

# Kernel width and the bound on the share of outliers.
GAMMA = 0.1
NU = 0.5

MODEL_FIELDS = "rho double, gap double, alpha array<double>, points array<double>, cats array<bigint>"
WORKING = 2_048
TOLERANCE = 1e-4
#: changed points that meet a task's points at a time
CHUNK = 16_384
#: numbers of a kernel matrix that a task holds at a time
CELLS = 1 << 20
#: weights closer to a bound than this share of it are at the bound
SLACK = 1e-9


@dataclass
class OneClassModel:
    """``model`` has a row per group and up to ``CHUNK`` support vectors (flattened ``points`` and ``cats``) with
    ``alpha``. The raw score is ``rho`` minus the similarity to all of them, on the scale where the alphas sum
    to nu * n. ``gap`` tells how far the group's solution is from optimal."""

    model: DataFrame
    scaling: DataFrame
    group_cols: tuple[str, ...]
    num_cols: tuple[str, ...]
    cat_cols: tuple[str, ...]
    gamma: float

    def scorer(self, out: str = "score", suffix: str = "") -> Scorer:
        gamma, width, cats = self.gamma, len(self.num_cols), len(self.cat_cols)

        def prepare(model: pa.Table):
            return lambda rows: evaluate(rows, model, gamma, width, cats, suffix)

        return Scorer(self.model, prepare, out, suffix)

    def encode(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return encode(df, self.scaling, self.num_cols, self.cat_cols, self.group_cols, suffix)

    def raw(
        self,
        df: DataFrame,
        key_cols: Sequence[str],
        out: str = "score",
        rows_per_task: int = 100_000,
        counts: DataFrame | None = None,
        max_bytes: int = MODEL_BYTES,
    ) -> DataFrame:
        """Adds the raw score (higher is more anomalous)."""
        return score_rows(self.encode(df), [self.scorer(out)], self.group_cols, key_cols, rows_per_task, counts, max_bytes)


def kernel(za: np.ndarray, ca: np.ndarray, zb: np.ndarray, cb: np.ndarray, gamma: float) -> np.ndarray:
    """RBF kernel over scaled numbers and one-hot categories, without building one-hot columns:
    two different known categories are 2 apart, a known and an unknown one (0) 1."""
    squared = (za**2).sum(1)[:, None] + (zb**2).sum(1)[None]
    squared -= 2.0 * za @ zb.T
    for i in range(ca.shape[1]):
        known_a, known_b = ca[:, i] != 0, cb[:, i] != 0
        same = (ca[:, i][:, None] == cb[:, i][None]) & known_a[:, None]
        squared += np.where(same, 0, known_a[:, None].astype(int) + known_b[None].astype(int))
    np.maximum(squared, 0.0, out=squared)
    squared *= -gamma
    return np.exp(squared, out=squared)


def similarity(za: np.ndarray, ca: np.ndarray, zb: np.ndarray, cb: np.ndarray, weight: np.ndarray, gamma: float) -> np.ndarray:
    """Kernel of every row of ``a`` with all of ``b``, by ``weight``. At most about ``CELLS`` numbers are held at a time."""
    out = np.zeros(len(za))
    step = max(1, CELLS // max(1, len(zb)))
    for low in range(0, len(za), step):
        some = slice(low, low + step)
        out[some] = kernel(za[some], ca[some], zb, cb, gamma) @ weight
    return out


def settle(k: np.ndarray, w: np.ndarray, a: np.ndarray, g: np.ndarray, tol: float) -> None:
    """Move weight between the pair of points that gains most, in place, until none violates optimality by more than ``tol``.

    Minimises a'Ka/2 with 0 <= a <= w and an unchanged sum of ``a``; ``g`` is the gradient Ka, to which
    points outside ``k`` may have added."""
    slack = SLACK * w
    while True:
        up, down = a < w - slack, a > slack
        i = int(np.argmin(np.where(up, g, np.inf)))
        gap = np.where(down & up[i], g - g[i], -np.inf)
        if gap.max() <= tol:
            return
        curve = np.maximum(2.0 - 2.0 * k[i], 1e-12)
        j = int(np.argmax(np.where(gap > 0, gap * gap / curve, -np.inf)))
        step = min(gap[j] / curve[j], w[i] - a[i], a[j])
        a[i] = w[i] if step == w[i] - a[i] else a[i] + step
        a[j] = 0.0 if step == a[j] else a[j] - step
        g += step * (k[i] - k[j])


_STATE = "_g bigint, _id bigint, _w double, _z array<double>, _cats array<bigint>, _a double, _grad double"
_CHANGE = "_g bigint, _id bigint, _z array<double>, _cats array<bigint>, _d double, _chunk int"


def fit_one_class(
    df: DataFrame,
    num_cols: Sequence[str],
    cat_cols: Sequence[str] = (),
    group_cols: Sequence[str] = ("type", "y", "m", "d"),
    nu: float = NU,
    gamma: float = GAMMA,
    working: int = WORKING,
    tolerance: float = TOLERANCE,
    passes: int = 10_000,
    max_bytes: int = MODEL_BYTES,
) -> OneClassModel:
    """Fit one model per group. ``df`` is read several times: pass a written table.

    ``passes`` only ends a fit that would not come to its tolerance; the model's ``gap`` tells then.
    """
    group, shape = list(group_cols), (len(num_cols), len(cat_cols))
    scaling = fit_scaling(df, num_cols, group)
    code = F.xxhash64(*group) if group else F.lit(0).cast("long")
    counted = df.groupBy(*group, *num_cols, *cat_cols).agg(F.count(F.lit(1)).alias("_w"))
    encoded = encode(counted, scaling, num_cols, cat_cols, group)
    far = F.floor(64 * F.log2(1 + F.aggregate("_z", F.lit(0.0), lambda s, x: s + x * x))).cast("int")
    points = encoded.select(code.alias("_g"), F.xxhash64("_z", "_cats").alias("_id"), F.col("_w").cast("double"), "_z", "_cats", far.alias("_far"))
    # different numbers may have one code (0 and a missing number at the mean): they are one point
    points = points.groupBy("_g", "_id").agg(F.sum("_w").alias("_w"), *[F.any_value(c).alias(c) for c in ("_z", "_cats", "_far")])
    points = materialise(points, "svm-points")

    state = _started(points, nu)
    changes = state.filter(F.col("_a") > 0).withColumn("_d", F.col("_a"))
    state = _moved(state, changes, gamma, shape, max_bytes, start=True)
    for _ in range(passes):
        facts = materialise(_facts(state), "svm-facts")
        left = materialise(facts.filter(F.col("_high") - F.col("_low") > tolerance * F.abs("_high")).select("_g", "_low", "_high"), "svm-open")
        if not row_count(left):
            break
        chosen = _chosen(state, left, working, tolerance, gamma, shape)
        state = _moved(state, materialise(chosen, "svm-changes"), gamma, shape, max_bytes)
    facts = facts.selectExpr("_g", "_rho as rho", "greatest(_high - _low, 0D) / greatest(abs(_high), 1e-300D) as gap")
    vectors = state.filter(F.col("_a") > SLACK * F.col("_w")).select("_g", (F.pmod("_id", F.lit(1 << 20))).alias("_part"), F.struct("_id", "_a", "_z", "_cats").alias("_v"))
    sizes = materialise(vectors.groupBy("_g").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("_parts")), "svm-sizes")
    parts = join_small(vectors, sizes, ["_g"], row_bytes=64).groupBy("_g", F.pmod("_part", F.col("_parts"))).agg(F.sort_array(F.collect_list("_v")).alias("_v"))
    rows = parts.join(facts, "_g").select("_g", "rho", "gap", F.col("_v._a").alias("alpha"), F.flatten("_v._z").alias("points"), F.flatten("_v._cats").alias("cats"))
    model = scaling.select(*group, code.alias("_g")).join(rows, "_g").drop("_g")
    return OneClassModel(materialise(model, "svm-model"), scaling, tuple(group), tuple(num_cols), tuple(cat_cols), gamma)


def _started(points: DataFrame, nu: float) -> DataFrame:
    """Every point with a first weight: full for those farthest from the mean, up to nu * n in all, and its gradient 0.

    How far is read in steps of a sixty-fourth power of two, so a group has a bounded number of steps."""
    steps = points.groupBy("_g", "_far").agg(F.sum("_w").alias("_step"))
    order = Window.partitionBy("_g").orderBy(F.col("_far").desc())
    before = F.coalesce(F.sum("_step").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    wanted = nu * F.sum("_step").over(Window.partitionBy("_g"))
    cut = steps.select("_g", F.col("_far").alias("_cut"), "_step", before.alias("_before"), wanted.alias("_wanted"))
    cut = cut.filter("_before < _wanted and _wanted <= _before + _step").selectExpr("_g", "_cut", "(_wanted - _before) / _step as _share")
    started = join_small(points, materialise(cut, "svm-starts"), ["_g"], row_bytes=64)
    weight = F.when(F.col("_far") > F.col("_cut"), F.col("_w")).when(F.col("_far") == F.col("_cut"), F.col("_w") * F.col("_share")).otherwise(0.0)
    return materialise(started.select("_g", "_id", "_w", "_z", "_cats", weight.alias("_a"), F.lit(0.0).alias("_grad")), "svm-start")


def _moved(state: DataFrame, changes: DataFrame, gamma: float, shape: tuple[int, int], max_bytes: int, start: bool = False) -> DataFrame:
    """``state`` after ``changes`` (_g, _id, _z, _cats, _d) of weights: gradients of all points, weights of the changed (unless at the start).

    A chunk of the changes at a time, so that a task holds no more of them; chunks within ``max_bytes`` go to
    every task, others meet the points by group."""
    n = max(1, row_count(materialise(changes.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")), "svm-counts")))
    most = changes.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    chunks = max(1, -(-most // CHUNK))
    dealt = changes.select("_g", "_id", "_z", "_cats", "_d", F.pmod(F.xxhash64("_id"), F.lit(chunks)).cast("int").alias("_chunk"))
    dealt = materialise(dealt, "svm-dealt") if chunks > 1 else dealt

    def add(rows: pa.Table, moves: pa.Table) -> pa.Table:
        z, c = features(rows, *shape)
        ids, weight, gradient = rows["_id"].to_numpy(), rows["_a"].to_numpy().copy(), rows["_grad"].to_numpy().copy()
        mz, mc, d = *features(moves, *shape), moves["_d"].to_numpy()
        gradient += similarity(z, c, mz, mc, d, gamma)
        if not start:
            order = np.argsort(moves["_id"].to_numpy())
            sorted_ids = moves["_id"].to_numpy()[order]
            place = np.minimum(np.searchsorted(sorted_ids, ids), len(order) - 1)
            weight += np.where(sorted_ids[place] == ids, d[order][place], 0.0)
        return rows.set_column(5, "_a", pa.array(weight)).set_column(6, "_grad", pa.array(gradient))

    for chunk in range(chunks):
        some = dealt.filter(F.col("_chunk") == chunk) if chunks > 1 else dealt
        if EXPANSION * (written_bytes(changes) or 64 * n) <= max_bytes:
            table = some.toArrow().combine_chunks()
            moves = {g: table.filter(pc.equal(table["_g"], g)) for g in pc.unique(table["_g"]).to_pylist()}
            sent = state.sparkSession.sparkContext.broadcast(moves)

            def run(batches, sent=sent):
                for batch in batches:
                    rows = pa.Table.from_batches([batch])
                    codes = rows["_g"].to_numpy()
                    for g in np.unique(codes).tolist():
                        mine = rows.filter(pc.equal(rows["_g"], g))
                        yield from (add(mine, sent.value[g]) if g in sent.value else mine).to_batches()

            state = materialise(state.mapInArrow(run, _STATE), "svm-state")
        else:
            def meet(_key, rows: pa.Table, moves: pa.Table) -> pa.Table:
                return add(rows, moves) if rows.num_rows and moves.num_rows else rows

            sliced = state.withColumn("_slice", F.pmod("_id", F.lit(SLICES)))
            spread = some.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
            met = sliced.groupBy("_g", "_slice").cogroup(spread.groupBy("_g", "_slice")).applyInArrow(
                lambda key, rows, moves: meet(key, rows.drop_columns("_slice"), moves), _STATE
            )
            state = materialise(met, "svm-state")
    return state


#: slices of a group's points where its changes are too many to be sent to every task
SLICES = 64


def _facts(state: DataFrame) -> DataFrame:
    """Per group: the least gradient whose weight may grow, the largest whose weight may fall, and the offset."""
    grows, falls = (F.expr(f"_a < _w * (1 - {SLACK})"), F.expr(f"_a > _w * {SLACK}"))
    grad = F.col("_grad")
    at = [F.min(F.when(grows, grad)).alias("_low"), F.max(F.when(falls, grad)).alias("_high"), F.avg(F.when(grows & falls, grad)).alias("_free")]
    at += [F.max(F.when(~grows, grad)).alias("_full"), F.min(F.when(~falls, grad)).alias("_none"), F.avg(grad).alias("_mean")]
    # without a free point the offset lies between the full and the unused ones
    return state.groupBy("_g").agg(*at).withColumn("_rho", F.coalesce("_free", (F.col("_full") + F.col("_none")) / 2, "_mean"))


def _chosen(state: DataFrame, left: DataFrame, working: int, tolerance: float, gamma: float, shape: tuple[int, int]) -> DataFrame:
    """Changes of the weights of each open group's most violating points."""
    half = working // 2
    near = join_small(state, left, ["_g"], row_bytes=64)
    near = near.filter(F.expr(f"(_a < _w * (1 - {SLACK}) and _grad < _high) or (_a > _w * {SLACK} and _grad > _low)"))

    def best(rows: pa.Table) -> np.ndarray:
        """Places of the points to work on, of one group."""
        a, w, g, ids = (rows[name].to_numpy() for name in ("_a", "_w", "_grad", "_id"))
        grows, falls = np.flatnonzero(a < w * (1 - SLACK)), np.flatnonzero(a > w * SLACK)
        return np.unique(np.concatenate([grows[np.lexsort((ids[grows], g[grows]))[:half]], falls[np.lexsort((ids[falls], -g[falls]))[:half]]]))

    def of_task(batches):
        held: dict[int, pa.Table] = {}
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for g in np.unique(rows["_g"].to_numpy()).tolist():
                mine = rows.filter(pc.equal(rows["_g"], g))
                mine = pa.concat_tables([held[g], mine]) if g in held else mine
                held[g] = mine.take(pa.array(best(mine))).combine_chunks()
        for mine in held.values():
            yield from mine.to_batches()

    def solve(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(best(rows)))
        rows = rows.sort_by("_id").combine_chunks()
        z, c = features(rows, *shape)
        w, before, g = (rows[name].to_numpy().astype(float) for name in ("_w", "_a", "_grad"))
        a, g = before.copy(), g.copy()
        # finer than the whole, as the rest of the group adds its own part
        settle(kernel(z, c, z, c, gamma), w, a, g, 0.1 * tolerance * abs(rows["_high"][0].as_py()))
        moved = np.flatnonzero(a != before)
        out = rows.select(["_g", "_id", "_z", "_cats"]).append_column("_d", pa.array(a - before)).append_column("_chunk", pa.array(np.zeros(len(a), np.int32)))
        return out.take(pa.array(moved))

    partial = near.mapInArrow(of_task, near.schema)
    return partial.groupBy("_g").applyInArrow(solve, _CHANGE)


def evaluate(rows: pa.Table, model: pa.Table, gamma: float, width: int, cats: int, suffix: str = "") -> np.ndarray:
    """Raw scores of rows against their group's model; equal rows are evaluated once."""
    z, c = features(rows, width, cats, suffix)
    first, back = distinct_rows(z, c)
    z, c = z[first], c[first]
    score = np.full(len(z), float(model["rho"][0].as_py()))
    for part in range(model.num_rows):
        alpha = np.array(model["alpha"][part].values, float)
        sz = np.array(model["points"][part].values, float).reshape(len(alpha), width)
        sc = np.array(model["cats"][part].values, np.int64).reshape(len(alpha), cats)
        score -= similarity(z, c, sz, sc, alpha, gamma)
    return score[back]
