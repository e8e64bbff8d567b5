"""Daily job: train three detectors per (day, actor type), score every profile, blend."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrail.functions import scores as S
from sentrail.functions.rules import GROUP_COLS, PROFILE_COUNTERS
from sentrail.operators import modelstore as store
from sentrail.operators.encoding import score_rows as raw_scores
from sentrail.operators.grouped import join_small
from sentrail.operators.iforest import TREES, ForestModel, fit_forest
from sentrail.operators.kmeans import CONSTANT_SCORE, GroupedDistanceModel, fit_grouped_distance
from sentrail.operators.ocsvm import OneClassModel, fit_one_class
from sentrail.operators.scoring import zscore_text, zscores
from sentrail.session import materialise, released
from sentrail.sources.sinks import create_score_table, score_rows, write_scores_table
from sentrail.sources.tables import profile_days

# raw score of each detector -> its 0-100 score, and the score of a constant training set
DETECTORS = {
    "_sed": ("pas_kmeans", CONSTANT_SCORE),
    "_isolation": ("pas_isolation", 0.0),
    "_one_class": ("pas_svm", 0.0),
}


ROWS_PER_TASK = 100_000


@dataclass
class ProfileModels:
    """Three detectors for the same groups, and ``ranges``: each raw score's training range."""

    distance: GroupedDistanceModel
    forest: ForestModel
    one_class: OneClassModel
    ranges: DataFrame
    group_cols: tuple[str, ...]


def _fit_detectors(profiles, num_cols, cat_cols, group_cols, key_cols, n_trees, seed):
    distance = fit_grouped_distance(profiles, num_cols, cat_cols, group_cols, seed=seed)
    forest = fit_forest(profiles, num_cols, cat_cols, group_cols, key_cols, n_trees=n_trees, seed=seed)
    one_class = fit_one_class(profiles, num_cols, cat_cols, group_cols)
    return distance, forest, one_class


def _raw_scores(profiles: DataFrame, detectors, key_cols: Sequence[str]) -> DataFrame:
    """All raw scores as columns of one frame, so they belong to the same row by construction.

    A score depends on a row's group and inputs alone: each different vector of a group is scored once, whatever the number
    of rows that have it, and rows take the scores of theirs. Nulls are values like others here."""
    distance, forest, one_class = detectors
    inputs = list(dict.fromkeys([*distance.group_cols, *distance.num_cols, *distance.cat_cols]))
    # counted vectors take up few bytes and much time: they are dealt to as many tasks as the session has for a shuffle
    tasks = int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    different = profiles.select(*inputs).distinct().repartition(tasks, *inputs)
    scored = distance.raw(materialise(different, "vectors"), "_sed")
    # forest and one-class model are evaluated on the same rows in one crossing to Python
    encoded = one_class.encode(forest.encode(scored, "_f"), "_o")
    scorers = [forest.scorer("_isolation", "_f"), one_class.scorer("_one_class", "_o")]
    raw = raw_scores(encoded, scorers, forest.group_cols, inputs, ROWS_PER_TASK)
    vector = F.struct(*inputs).alias("_vector")
    raw = materialise(raw.select(vector, *DETECTORS), "vector-scores")
    joined = join_small(profiles.select("*", vector), raw, ["_vector"], "left", row_bytes=128 + 32 * len(inputs))
    return materialise(joined.select(*profiles.columns, *DETECTORS), "raw-scores")


def _ranges(raw: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    ends = [f(c).alias(f"{name}{c}") for c in DETECTORS for name, f in (("_low", F.min), ("_high", F.max))]
    return materialise(raw.groupBy(*group_cols).agg(*ends), "score-ranges")


def _finish(raw: DataFrame, ranges: DataFrame, num_cols: Sequence[str], group_cols: Sequence[str]) -> DataFrame:
    joined = join_small(raw, ranges, group_cols, how="left")
    for c, (out, constant) in DETECTORS.items():
        score = S.minmax(F.col(c), F.col(f"_low{c}"), F.col(f"_high{c}"), constant)
        # a group without a model scores 0
        joined = joined.withColumn(out, F.round(F.coalesce(score, F.lit(0.0)), 4))
    parts = [out for out, _ in DETECTORS.values()]
    blended = joined.withColumn("pas", S.ensemble([F.col(c) for c in parts])).withColumn(
        "model_found", F.col("_low_sed").isNotNull()
    )
    kept = [c for c in raw.columns if c not in DETECTORS]
    with_z = zscores(blended.select(*kept, *parts, "pas", "model_found"), num_cols, group_cols)
    return with_z.withColumn("zscore", zscore_text())


def train(
    profiles: DataFrame,
    num_cols: Sequence[str] = PROFILE_COUNTERS,
    cat_cols: Sequence[str] = (),
    group_cols: Sequence[str] = GROUP_COLS,
    key_cols: Sequence[str] = ("name",),
    n_trees: int = TREES,
    seed: int = 42,
) -> ProfileModels:
    """Fit all detectors for all groups. ``profiles`` is read many times: pass a written table."""
    detectors = _fit_detectors(profiles, num_cols, cat_cols, group_cols, key_cols, n_trees, seed)
    raw = _raw_scores(profiles, detectors, key_cols)
    return ProfileModels(*detectors, _ranges(raw, group_cols), tuple(group_cols))


def score(profiles: DataFrame, models: ProfileModels, key_cols: Sequence[str] = ("name",)) -> DataFrame:
    """Score profiles with earlier models; rows of groups without a model score 0."""
    raw = _raw_scores(profiles, (models.distance, models.forest, models.one_class), key_cols)
    return _finish(raw, models.ranges, models.distance.num_cols, models.group_cols)


def train_and_score(
    profiles: DataFrame,
    num_cols: Sequence[str] = PROFILE_COUNTERS,
    cat_cols: Sequence[str] = (),
    group_cols: Sequence[str] = GROUP_COLS,
    key_cols: Sequence[str] = ("name",),
    n_trees: int = TREES,
    seed: int = 42,
    time_window: str = "day",
    models_path: str | None = None,
) -> DataFrame:
    """Train and score the same profiles; every group's raw scores are worked out once. With
    ``models_path`` the models are kept there for later scoring."""
    profiles = materialise(profiles, "profiles")
    detectors = _fit_detectors(profiles, num_cols, cat_cols, group_cols, key_cols, n_trees, seed)
    raw = _raw_scores(profiles, detectors, key_cols)
    models = ProfileModels(*detectors, _ranges(raw, group_cols), tuple(group_cols))
    if models_path is not None:
        save(profiles.sparkSession, models, models_path)
    return _finish(raw, models.ranges, num_cols, group_cols).withColumn("time_window", F.lit(time_window))


def run(
    spark: SparkSession,
    profile_table: str,
    score_table: str,
    last_day: str,
    days: int,
    execution_ms: int,
    models_path: str | None = None,
    **options,
) -> None:
    """The daily job: the last ``days`` days of a profile table, all days and actor types at once,
    into the score table. Running it again replaces the same days."""
    profiles = profile_days(spark.table(profile_table), last_day, days)
    create_score_table(spark, score_table)
    with released(spark):  # the scores are in their table, and the models in their store, when this ends
        scores = train_and_score(profiles, models_path=models_path, **options)
        write_scores_table(score_rows(scores, execution_ms), score_table)


def save(spark: SparkSession, models: ProfileModels, path: str) -> None:
    store.save_grouped_distance(spark, models.distance, f"{path}/distance")
    store.save_forest(spark, models.forest, f"{path}/forest")
    store.save_one_class(spark, models.one_class, f"{path}/one_class")
    store.save_tables(spark, f"{path}/ranges", {"ranges": models.ranges}, {"group_cols": list(models.group_cols)})


def load(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> ProfileModels | None:
    """The saved models, or None unless all of them are there; with ``wanted``, those of its groups only."""
    parts = (
        store.load_grouped_distance(spark, f"{path}/distance", wanted),
        store.load_forest(spark, f"{path}/forest", wanted),
        store.load_one_class(spark, f"{path}/one_class", wanted),
        store.load_tables(spark, f"{path}/ranges", wanted),
    )
    if any(part is None for part in parts):
        return None
    distance, forest, one_class, (tables, settings) = parts
    return ProfileModels(distance, forest, one_class, tables["ranges"], tuple(settings["group_cols"]))
