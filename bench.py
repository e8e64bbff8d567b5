"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose tables and cores;
BENCH_QUERIES is a comma list to time other queries. Every result is computed in full.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import REGISTRY  # noqa: E402
from sentrail.session import local_session  # noqa: E402

HEADLINE = [
    "win_daily_aggregation",
    "alert_score_normalised",
    "final_anomaly_view",
    "attribute_assembly",
    "event_intake",
    "mail_profile",
    "traffic_bytes_parse",
    "profile_windows",
    "zscore_profile",
    "box_stats",
    "sed_frozen_centroids",
    "event_batch_scoring",
    "event_stream_scoring",
    "kmeans_profile_pas",
    "iforest_profile_pas",
    "ocsvm_profile_pas",
    "daily_train_and_score",
    "classifier_cv_accuracy",
    "event_stream_batches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores=os.environ.get("BENCH_CPUS", "8"), app="sentrail-bench")
    # one small run starts the JVM's and Python workers' machinery outside the timings
    REGISTRY["win_daily_aggregation"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
