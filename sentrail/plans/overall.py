"""Overall score: raw events and profile scores to one blended score per actor and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from sentrail.functions.rules import ACTORS, OS_LOG_RULES, ActivityRules
from sentrail.operators.alerts import OVERALL_WEIGHTS, alert_scores, overall_score
from sentrail.operators.profiles import daily_activity
from sentrail.session import materialise


def daily_alert_scores(
    events: DataFrame, rules: ActivityRules = OS_LOG_RULES, actors: Mapping[str, str] = ACTORS, rescale: bool = False
) -> DataFrame:
    """Alert scores straight from raw events, which are read once: the daily aggregate, far
    smaller, is written and serves both the ranges and the rows."""
    return alert_scores(materialise(daily_activity(events, rules, actors), "daily-activity"), rescale=rescale)


def overall(
    events: DataFrame,
    profile_scores: DataFrame,
    weights: Sequence[float] = OVERALL_WEIGHTS,
    match_type: bool = False,
) -> DataFrame:
    return overall_score(profile_scores, daily_alert_scores(events), weights, match_type)


def create_views(
    spark: SparkSession,
    event_table: str,
    score_table: str,
    activity_view: str,
    overall_view: str,
    weights: Sequence[float] = OVERALL_WEIGHTS,
    match_type: bool = False,
) -> None:
    """Two views of the session: the daily activity of a raw event table, and the overall scores of a score table
    blended with that activity's alert scores. Names are arguments, so several pairs can live side by side. A
    view holds no rows: each query of it reads the tables as they then are."""
    daily_activity(spark.table(event_table)).createOrReplaceTempView(activity_view)
    scored = overall_score(spark.table(score_table), alert_scores(spark.table(activity_view), lazy=True), weights, match_type)
    scored.createOrReplaceTempView(overall_view)
