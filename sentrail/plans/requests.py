"""Score a table of requests, each for an address or a user of one source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrail.plans import daily
from sentrail.session import materialise


def route(requests: DataFrame, address: str = "src_ip", user: str = "user_name") -> DataFrame:
    """Adds ``type`` and ``name``: the address when given, else the user, else null."""
    by_address, by_user = F.col(address).isNotNull(), F.col(user).isNotNull()
    return requests.withColumns(
        {
            "type": F.when(by_address, "entity").when(by_user, "user"),
            "name": F.coalesce(F.col(address), F.col(user)),
        }
    )


def score_requests(requests: DataFrame, models: daily.ProfileModels, key_cols: Sequence[str]) -> DataFrame:
    """Route and score with models grouped by (source, type). A request that names nobody gets a
    null score; one whose source has no model scores 0 with ``model_found`` false."""
    scored = daily.score(route(requests), models, key_cols)
    routed = F.col("type").isNotNull()
    names = ["pas_kmeans", "pas_isolation", "pas_svm", "pas"]
    return scored.withColumns({c: F.when(routed, F.col(c)) for c in names})


def score_stored(requests: DataFrame, path: str, group_cols: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    """The same with the models stored at ``path``, of which only the groups that are asked for are read."""
    routed = materialise(route(requests), "requests")
    models = daily.load(requests.sparkSession, path, routed.select(*group_cols))
    if models is None:
        raise ValueError(f"no models at {path}")
    return score_requests(routed, models, key_cols)
