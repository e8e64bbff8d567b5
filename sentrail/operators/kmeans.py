"""Distance-to-centroids scores: one model on MLlib, or one model per group in shared jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sentrail.functions import scores as S
from sentrail.functions.moments import moment_sums, moments
from sentrail.operators.features import feature_pipeline, standardise
from sentrail.operators.grouped import fits_broadcast, join_small, ranked, salted_join
from sentrail.session import materialise, row_count, written_bytes

# Cluster count, and the score of a constant training set.
CLUSTERS = 4
CONSTANT_SCORE = 50.0

# Training works on features in whole steps of a millionth, held in doubles. Their sums are exact
# up to 9e15, so they do not depend on the order of addition, and a vector halfway between two
# centroids falls on the same side in every run.
STEPS = 1e6


# ---------------------------------------------------------------- one model, MLlib


@dataclass
class DistanceModel:
    """A fitted feature and clustering pipeline with the range of its training distances."""

    pipeline: PipelineModel
    low: float
    high: float

    @property
    def centroids(self) -> list[list[float]]:
        return [[float(v) for v in centre] for centre in self.pipeline.stages[-1].clusterCenters()]

    def raw(self, df: DataFrame) -> DataFrame:
        """Adds ``cluster_id`` and ``sed``, keeping the input columns."""
        placed = self.pipeline.transform(df).withColumn("_f", vector_to_array("features"))
        centroids = self.centroids
        features = [F.col("_f")[i] for i in range(len(centroids[0]))]
        return placed.select(*df.columns, "cluster_id", S.sed(features, centroids).alias("sed"))

    def score(self, df: DataFrame, out: str = "PAS") -> DataFrame:
        """Adds the 0-100 score; the same transform serves batch and streaming frames."""
        return self.raw(df).withColumn(
            out, S.minmax(F.col("sed"), F.lit(self.low), F.lit(self.high), CONSTANT_SCORE)
        )


@dataclass
class CentroidScorer:
    """The same score from given centroids over plain numeric columns, without a pipeline: for
    models kept as a few numbers, e.g. for a stream."""

    num_cols: Sequence[str]
    means: Sequence[float]
    sds: Sequence[float]
    centroids: Sequence[Sequence[float]]
    low: float
    high: float

    def raw(self, df: DataFrame, out: str = "sed") -> DataFrame:
        features = [standardise(F.col(c), m, sd) for c, m, sd in zip(self.num_cols, self.means, self.sds, strict=True)]
        return df.withColumn(out, S.sed(features, self.centroids))

    def score(self, df: DataFrame, out: str = "PAS") -> DataFrame:
        scaled = S.minmax(F.col("_sed"), F.lit(self.low), F.lit(self.high), CONSTANT_SCORE)
        return self.raw(df, "_sed").withColumn(out, scaled).drop("_sed")


def fixed_layout(df: DataFrame, key_cols: Sequence[str], partitions: int) -> DataFrame:
    """Same rows in the same partitions and order on every run, which MLlib's seeds rely on."""
    return df.repartition(partitions, *key_cols).sortWithinPartitions(*key_cols)


def fit_distance_model(
    df: DataFrame,
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    key_cols: Sequence[str],
    k: int = CLUSTERS,
    seed: int = 42,
    one_hot: bool = False,
    handle_invalid: str = "keep",
    rows_per_partition: int = 200_000,
) -> DistanceModel:
    """Cluster all rows once. The layout follows from the row count alone, so a refit gives the
    same model wherever it runs. A written table is read as it is, any other is written first. Every stage of the fit
    reads all rows: they are laid out once and stay on the executors' disks meanwhile, as files would lose the layout."""
    columns = list(dict.fromkeys([*key_cols, *num_cols, *cat_cols]))
    training = df if written_bytes(df) is not None else materialise(df.select(*columns), "kmeans-input")
    rows = row_count(training)
    laid_out = fixed_layout(training.select(*columns), key_cols, 1 + rows // rows_per_partition)
    laid_out = laid_out.select(*dict.fromkeys([*num_cols, *cat_cols])).persist(StorageLevel.DISK_ONLY)
    features = feature_pipeline(num_cols, cat_cols, one_hot, handle_invalid)
    clusterer = KMeans(featuresCol="features", predictionCol="cluster_id", k=k, seed=seed)
    features.setStages([*features.getStages(), clusterer])
    try:
        model = DistanceModel(features.fit(laid_out), 0.0, 0.0)
    finally:
        laid_out.unpersist()
    ends = model.raw(training).agg(F.min("sed"), F.max("sed")).first()
    model.low, model.high = float(ends[0]), float(ends[1])
    return model


# ---------------------------------------------------------------- one model per group


@dataclass
class GroupedDistanceModel:
    """Per group: scaling of the numbers (``scaling``) and centroids (``centroids``), as tables.
    ``categories`` holds the frequency index of every category, or None without categories."""

    scaling: DataFrame
    centroids: DataFrame
    categories: DataFrame | None
    group_cols: tuple[str, ...]
    num_cols: tuple[str, ...]
    cat_cols: tuple[str, ...]

    def raw(self, df: DataFrame, out: str = "sed") -> DataFrame:
        """Adds the summed distance; null where the row's group has no model."""
        prepared = _features(df, self.scaling, self.categories, self.group_cols, self.num_cols, self.cat_cols)
        width = len(self.num_cols) + len(self.cat_cols)
        joined = join_small(prepared, self.centroids, self.group_cols, how="left", row_bytes=64 + 8 * width * 16)
        return joined.select(*df.columns, S.sed_array(F.col("_f"), F.col("_centroids")).alias(out))


def _category_index(df: DataFrame, group_cols: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    """(group, column, category) -> 0-based rank by falling count, then by name."""
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).alias("_v")) for i, c in enumerate(cat_cols)]))
    counts = (
        df.select(*group_cols, cells.alias("_cell"))
        .select(*group_cols, "_cell._c", "_cell._v")
        .where(F.col("_v").isNotNull())
        .groupBy(*group_cols, "_c", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = ranked(counts, [*group_cols, "_c"], [F.col("_n").desc(), F.col("_v").asc()], "_i")
    return placed.withColumn("_i", F.col("_i").cast("double")).drop("_n")


def _features(
    df: DataFrame,
    scaling: DataFrame,
    categories: DataFrame | None,
    group_cols: Sequence[str],
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
) -> DataFrame:
    """Adds ``_f``: category indexes first, then the scaled numbers. Missing numbers sit at the
    mean, unknown categories get the index after the last known one."""
    prepared = join_small(df, scaling, group_cols, how="left", row_bytes=64 + 16 * len(num_cols) + 8 * len(cat_cols))
    parts: list[Column] = []
    for i, c in enumerate(cat_cols):
        known = categories.where(F.col("_c") == i).select(*group_cols, F.col("_v").alias(c), F.col("_i").alias(f"_i{i}"))
        prepared = prepared.join(known, [*group_cols, c], "left")
        parts.append(F.coalesce(F.col(f"_i{i}"), F.col("_sizes")[i]))
    for i, c in enumerate(num_cols):
        sd = F.col("_sds")[i]
        z = (F.col(c).cast("double") - F.col("_means")[i]) / sd
        parts.append(F.coalesce(F.when(sd > 0, z), F.lit(0.0)))
    return prepared.withColumn("_f", F.array(*parts)).drop(
        "_means", "_sds", "_sizes", *[f"_i{i}" for i in range(len(cat_cols))]
    )


def fit_grouped_distance(
    df: DataFrame,
    num_cols: Sequence[str],
    cat_cols: Sequence[str] = (),
    group_cols: Sequence[str] = ("type", "y", "m", "d"),
    k: int = CLUSTERS,
    seed: int = 42,
    max_iter: int = 20,
    tol: float = 1e-4,
) -> GroupedDistanceModel:
    """Fit one k-means model per group, all groups in the same jobs.

    Equal feature vectors are counted together first. Groups of every size are then fitted in the same passes over
    all executors, each a broadcast of the centroids and a map-side combined sum, so neither a large
    group nor a frequent vector gathers in one task.

    Starting centroids follow k-means++: each is drawn in proportion to count times squared
    distance, by giving each vector an exponential waiting time at that rate from a hash of its
    values and taking the smallest. Results do not depend on partitioning.
    """
    group = list(group_cols)
    found = [moments(i, sample=True) for i in range(len(num_cols))]
    fitted = [F.array(*[pair[k] for pair in found]).cast("array<double>").alias(name) for k, name in enumerate(("_means", "_sds"))]
    none = F.array(*[F.lit(0.0) for _ in cat_cols]).cast("array<double>").alias("_sizes")
    scaled = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *moment_sums(num_cols)).select(*group, *fitted, none)
    categories = None
    if cat_cols:
        categories = materialise(_category_index(df, group, cat_cols), "kmeans-categories")
        sizes = categories.groupBy(*group).agg(
            F.array(*[F.coalesce(F.max(F.when(F.col("_c") == i, F.col("_i") + 1)), F.lit(0.0)) for i in range(len(cat_cols))]).alias("_sizes")
        )
        scaled = scaled.drop("_sizes").join(sizes, group, "left")
    scaling = materialise(scaled, "kmeans-scaling")

    vectors = materialise(
        _features(
            df.groupBy(*group, *num_cols, *cat_cols).agg(F.count(F.lit(1)).alias("_w")), scaling, categories, group, num_cols, cat_cols
        ).select(*group, "_w", F.xxhash64(*num_cols, *cat_cols).alias("_h"), *[F.rint(F.col("_f")[i] * STEPS).alias(f"_f{i}") for i in range(len(num_cols) + len(cat_cols))]),
        "kmeans-vectors",
    )
    width = len(num_cols) + len(cat_cols)
    # one row of centroids per group: the check made on the scaling table holds for every pass
    shape = _Shape(group, k, width, fits_broadcast(scaling, 64 + 8 * k * width))
    passes = _settle(vectors, _plus_plus(vectors, shape, seed), shape, max_iter, tol * STEPS)
    present = [F.expr(f"CASE WHEN _c{j}_0 IS NOT NULL THEN array({', '.join(shape.centre(j))}) END") for j in range(k)]
    centroids = passes.select(*group, F.array_compact(F.array(*present)).alias("_centroids"))
    unit = F.transform("_centroids", lambda centre: F.transform(centre, lambda c: c / STEPS))
    centroids = centroids.withColumn("_centroids", unit)
    return GroupedDistanceModel(
        scaling, materialise(centroids, "kmeans-model"), categories, tuple(group), tuple(num_cols), tuple(cat_cols)
    )


@dataclass(frozen=True)
class _Shape:
    """Names of the working columns: feature i is ``_f{i}``, centroid j's part ``_c{j}_{i}``
    (null while a group has fewer centroids). Plain columns keep the passes in generated code;
    the expressions are SQL text because a pass has many of them."""

    group: list[str]
    k: int
    width: int
    broadcast: bool

    def features(self) -> list[str]:
        return [f"_f{i}" for i in range(self.width)]

    def centre(self, j: int, prefix: str = "_c") -> list[str]:
        return [f"{prefix}{j}_{i}" for i in range(self.width)]

    def squared(self, a: list[str], b: list[str]) -> str:
        return "(" + " + ".join(f"({x} - {y}) * ({x} - {y})" for x, y in zip(a, b)) + ")"

    def nearest(self, known: int) -> str:
        """Squared distance to the closest of the first ``known`` centroids."""
        distances = [self.squared(self.features(), self.centre(j)) for j in range(known)]
        return f"least({', '.join(distances)})" if known > 1 else distances[0]

    def uniform(self, seed: int, step: int) -> str:
        """A number in (0, 1) from the raw values of the vector."""
        return f"(pmod(xxhash64({seed}, {step}, _h), {1 << 52}L) + 0.5D) / {1 << 52}D"

    def with_centroids(self, vectors: DataFrame, centroids: DataFrame) -> DataFrame:
        if self.broadcast:
            return vectors.join(F.broadcast(centroids), self.group)
        return salted_join(vectors, centroids, self.group, "inner")


def _plus_plus(vectors: DataFrame, shape: _Shape, seed: int) -> DataFrame:
    """Up to k starting centroids per group; fewer where a group has fewer distinct vectors."""
    group, features = shape.group, ", ".join(shape.features())

    def drawn(rate: str, step: int) -> Column:
        waiting = f"-ln({shape.uniform(seed, step)}) / ({rate})"
        return F.expr(f"min_by(array({features}), CASE WHEN {rate} > 0 THEN {waiting} END)").alias("_new")

    centroids = None
    for step in range(shape.k):
        if centroids is None:
            picked = vectors.groupBy(*group).agg(drawn("_w", step))
            known = []
        else:
            known = [c for j in range(step) for c in shape.centre(j)]
            placed = shape.with_centroids(vectors, centroids).withColumn("_rate", F.expr(f"_w * {shape.nearest(step)}"))
            picked = placed.groupBy(*group).agg(*[F.first(c).alias(c) for c in known], drawn("_rate", step))
        # min_by is null where every vector already sits on a centroid
        chosen = [f"_new[{i}] AS {c}" for i, c in enumerate(shape.centre(step))]
        centroids = materialise(picked.selectExpr(*group, *known, *chosen), "kmeans-start")
    return centroids


def _settle(vectors: DataFrame, centroids: DataFrame, shape: _Shape, max_iter: int, tol: float) -> DataFrame:
    """Move centroids to the mean of their vectors until no group moves one by more than tol."""
    group, k = shape.group, shape.k
    first = " ".join(f"WHEN {shape.squared(shape.features(), shape.centre(j))} <= _near THEN {j}" for j in range(k))
    sums, moved, shifts = [], [], []
    for j in range(k):
        sums.append(F.expr(f"sum(CASE WHEN _k = {j} THEN _w END) AS _n{j}"))
        for feature, old, new in zip(shape.features(), shape.centre(j), shape.centre(j, "_m")):
            sums.append(F.expr(f"sum(CASE WHEN _k = {j} THEN _w * {feature} END) AS _s{new}"))
            # a centroid that lost all its vectors stays where it is
            moved.append(f"coalesce(_s{new} / _n{j}, {old}) AS {new}")
        shifts.append(f"coalesce({shape.squared(shape.centre(j), shape.centre(j, '_m'))}, 0D)")
    shift = f"greatest({', '.join(shifts)}, 0D) AS _shift"
    renamed = [f"{new} AS {old}" for j in range(k) for old, new in zip(shape.centre(j), shape.centre(j, "_m"))]
    kept = [F.first(c).alias(c) for j in range(k) for c in shape.centre(j)]
    for _ in range(max_iter):
        assigned = (
            shape.with_centroids(vectors, centroids)
            .withColumn("_near", F.expr(shape.nearest(k)))
            .withColumn("_k", F.expr(f"CASE {first} END"))
        )
        step = assigned.groupBy(*group).agg(*kept, *sums).selectExpr("*", *moved).selectExpr(*group, *renamed, shift)
        moving = Observation()
        moved_to = materialise(step.observe(moving, F.count(F.when(F.col("_shift") > tol * tol, 1)).alias("n")), "kmeans-centroids")
        centroids = moved_to.drop("_shift")
        if not moving.get["n"]:
            break
    return centroids
