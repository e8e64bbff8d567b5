"""Alert scores per day and the overall score that blends them with profile scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrail.functions import scores as S
from sentrail.functions.rules import DAY_COLS, PROFILE_COUNTERS
from sentrail.operators.grouped import join_small
from sentrail.session import materialise
from sentrail.sources.sinks import SCORE_COLUMNS

# Weight of the profile score, the new-user and the new-entity alert score.
OVERALL_WEIGHTS = (0.6, 0.2, 0.2)
ALERT_COUNTS = ("is_nu_alert_count", "is_ne_alert_count")


def _score_name(count: str) -> str:
    return count.replace("_count", "_score")


def alert_scores(
    activity: DataFrame,
    counts: Sequence[str] = ALERT_COUNTS,
    day_cols: Sequence[str] = DAY_COLS,
    rescale: bool = False,
    lazy: bool = False,
) -> DataFrame:
    """Each alert count in percent of its day's range over all actors; 0 on a day without range.

    The smallest count is not subtracted, so scores can pass 100; ``rescale=True`` subtracts it.
    ``activity`` is read twice (ranges, rows): pass a written table. ``lazy`` runs nothing now, for views.
    """
    days = list(day_cols)
    ranges = activity.groupBy(*days).agg(
        *[F.min(c).alias(f"_low_{c}") for c in counts],
        *[(F.max(c) - F.min(c)).alias(f"_range_{c}") for c in counts],
    )

    def score(count: str):
        part = F.col(count) - F.col(f"_low_{count}") if rescale else F.col(count)
        return S.guarded_percent(part, F.col(f"_range_{count}")).alias(_score_name(count))

    placed = activity.join(ranges, days) if lazy else join_small(activity, materialise(ranges, "alert-ranges"), days)
    return placed.select(
        "name", "type", *days, "total_events", *counts, *[score(c) for c in counts]
    )


def overall_score(
    profile_scores: DataFrame,
    alerts: DataFrame,
    weights: Sequence[float] = OVERALL_WEIGHTS,
    match_type: bool = False,
    counters: Sequence[str] = PROFILE_COUNTERS,
    day_cols: Sequence[str] = DAY_COLS,
) -> DataFrame:
    """Profile scores with the alert side of the same name and day, blended into one score.

    By default the actor type is not part of the key, so a name that is both a user and an
    entity meets both alert rows; ``match_type=True`` pairs equal types only. Without an alert
    row the ratios, alert scores and the overall score are null.
    """
    keys = ["name", *day_cols] + (["type"] if match_type else [])
    alert_side = alerts if match_type else alerts.drop("type")
    wanted = ["name", "type", *day_cols, "time_window", *counters, "zscore", *SCORE_COLUMNS]
    joined = profile_scores.select(*wanted).join(alert_side, keys, "left")
    nu, ne = ALERT_COUNTS
    return joined.select(
        "name",
        "type",
        *day_cols,
        "time_window",
        *counters,
        F.col("total_events").alias("win_total_events"),
        F.col(nu).alias(f"total_{nu}"),
        F.col(ne).alias(f"total_{ne}"),
        S.percent(F.col(nu), F.col("total_events")).alias("is_nu_alert_ratio"),
        S.percent(F.col(ne), F.col("total_events")).alias("is_ne_alert_ratio"),
        F.col("pas_kmeans").alias("win_kmeans_pas"),
        F.col("pas_isolation").alias("win_isf_pas"),
        F.col("pas_svm").alias("win_svm_pas"),
        F.col("zscore").alias("win_zscore"),
        F.col("pas").alias("win_profile_anomaly_score"),
        _score_name(nu),
        _score_name(ne),
        S.weighted_sum([F.col("pas"), F.col(_score_name(nu)), F.col(_score_name(ne))], weights).alias(
            "overall_anomaly_score"
        ),
    )
