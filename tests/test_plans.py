import glob
import os
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from registry import inputs as I
from sentrail.functions import scores as S
from sentrail.functions.rules import GROUP_COLS
from sentrail.operators import alerts
from sentrail.operators import modelstore as store
from sentrail.plans import daily, requests
from sentrail.session import materialise, shared_dir, written_bytes
from sentrail.sources import sinks

KEYS = ["name", *GROUP_COLS]
PARTS = ["pas_kmeans", "pas_isolation", "pas_svm"]


@pytest.fixture(scope="module")
def scored(activity):
    return materialise(daily.train_and_score(activity, group_cols=["type"], key_cols=KEYS, n_trees=60), "scored")


def test_no_row_is_lost_or_doubled(scored, activity):
    assert scored.select(KEYS).exceptAll(activity.select(KEYS)).isEmpty() and scored.count() == activity.count()


def test_scores_cover_the_scale(scored):
    for part in PARTS:
        for row in scored.groupBy("type").agg(F.min(part), F.max(part)).collect():
            assert tuple(row)[1:] == (0.0, 100.0)


def test_pas_is_the_mean_of_its_parts(scored):
    mean = F.round((F.col(PARTS[0]) + F.col(PARTS[1]) + F.col(PARTS[2])) / 3, 4)
    assert scored.where(mean != F.col("pas")).isEmpty()


def test_rerun_gives_the_same_scores(scored, activity):
    again = daily.train_and_score(activity.repartition(5), group_cols=["type"], key_cols=KEYS, n_trees=60)
    joined = scored.join(again.select(*KEYS, F.col("pas").alias("again")), KEYS)
    assert joined.agg(F.max(F.abs(F.col("pas") - F.col("again")))).first()[0] == 0


def test_equal_vectors_are_scored_once(spark, monkeypatch):
    """Rows share their vector's scores, those with nulls among them; no row is lost, doubled or mixed up with another."""
    given = [(f"n{k}", None if k % 11 == 0 else "ab"[k % 2], None if k % 7 == 0 else k % 3, float(k % 5)) for k in range(400)]
    rows = materialise(spark.createDataFrame([*given, given[5]], "name string, type string, x long, z double"), "rows")
    seen, score = [], daily.raw_scores
    monkeypatch.setattr(daily, "raw_scores", lambda encoded, *rest: (seen.append(encoded.count()), score(encoded, *rest))[1])
    models = daily.train(rows, ["x", "z"], group_cols=["type"], n_trees=20)
    scored = materialise(daily.score(rows, models), "scored")
    different = {row[1:] for row in given}
    assert seen == [len(different)] * 2 and len(different) < 100
    assert scored.select("name", "type", "x", "z").exceptAll(rows).isEmpty() and scored.count() == 401
    found = {}
    for row in scored.collect():
        found.setdefault((row["type"], row["x"], row["z"]), set()).add((row["pas"], row["model_found"]))
        assert row["model_found"] == (row["type"] is not None)
    assert set(found) == different and all(len(values) == 1 for values in found.values())
    assert len(set().union(*found.values())) > 10


def test_saved_models_score_the_same_and_unknown_groups_score_zero(spark, activity, folder):
    users = materialise(activity.where("type = 'user'"), "users")
    models = daily.train(users, group_cols=["type"], key_cols=KEYS, n_trees=30)
    daily.save(spark, models, folder + "/m")
    loaded = daily.load(spark, folder + "/m")
    before, after = (materialise(daily.score(activity, m, KEYS), "s") for m in (models, loaded))
    assert before.exceptAll(after).isEmpty() and before.count() == activity.count()
    entity = after.where("type = 'entity'").agg(F.max("pas"), F.max(F.col("model_found").cast("int"))).first()
    assert tuple(entity) == (0.0, 0)
    assert daily.load(spark, folder + "/nothing") is None


def test_daily_saves_add_up_and_a_broken_one_changes_nothing(spark, activity, folder):
    days = materialise(activity.where("y = 2024 and m = 1 and d <= 2"), "two-days")
    for day in (1, 2, 2):
        daily.save(spark, daily.train(materialise(days.where(F.col("d") == day), "day"), n_trees=10), folder + "/m")
    found = materialise(daily.score(days, daily.load(spark, folder + "/m"), ["name"]), "found")
    assert found.count() == days.count() and found.where("not model_found").isEmpty()
    daily.load(spark, folder + "/m").forest.trees.write.parquet(folder + "/m/forest/data/broken/trees")  # never committed
    again = daily.load(spark, folder + "/m")
    assert again.forest.trees.count() == sum(1 for _ in days.select(*GROUP_COLS).distinct().collect()) * 10
    store.save_forest(spark, again.forest, folder + "/m/forest")  # onto its own path
    assert daily.load(spark, folder + "/m").forest.trees.count() == again.forest.trees.count()
    with pytest.raises(ValueError, match="other settings"):
        store.save_tables(spark, folder + "/m/ranges", {"ranges": again.ranges}, {"group_cols": ["type"]})


def rows_of_day(spark, day, value):
    return {"t": spark.createDataFrame([(day, f"g{k}", value + k) for k in range(50)], "d int, type string, x long").coalesce(1)}


def stored_bytes(folder):
    return sum(os.path.getsize(p) for p in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(p))


def test_a_save_costs_its_own_groups_only(spark, folder):
    sizes = [0]
    for day in range(6):
        store.save_tables(spark, folder + "/s", rows_of_day(spark, day, day), {"group_cols": ["d", "type"]})
        sizes.append(stored_bytes(folder))
    steps = [b - a for a, b in zip(sizes, sizes[1:])]
    assert max(steps) < 1.25 * min(steps)  # not by what is stored
    tables, settings = store.load_tables(spark, folder + "/s")
    assert tables["t"].count() == 300 and settings == {"group_cols": ["d", "type"]}
    store.save_tables(spark, folder + "/s", rows_of_day(spark, 3, 1_000), {"group_cols": ["d", "type"]})
    before = sorted(store.load_tables(spark, folder + "/s")[0]["t"].collect())
    assert len(before) == 300 and [r.x for r in before if r.d == 3] == [1_000 + int(r.type[1:]) for r in before if r.d == 3]
    store.compact(spark, folder + "/s")
    assert sorted(store.load_tables(spark, folder + "/s")[0]["t"].collect()) == before
    store.clean(spark, folder + "/s")
    assert sorted(store.load_tables(spark, folder + "/s")[0]["t"].collect()) == before
    assert len(glob.glob(folder + "/s/data/*")) == 1


def test_writers_at_the_same_time_lose_nothing(spark, folder, monkeypatch):
    settings = {"group_cols": ["d", "type"]}
    with ThreadPool(4) as pool:
        pool.map(lambda day: store.save_tables(spark, folder + "/s", rows_of_day(spark, day, day), settings), range(8))
    assert {r.d for r in store.load_tables(spark, folder + "/s")[0]["t"].collect()} == set(range(8))
    # a save between a compaction's reading and its commit comes after it
    found = store.load_tables

    def slow(spark, path):
        out = found(spark, path)
        monkeypatch.setattr(store, "load_tables", found)
        store.save_tables(spark, path, rows_of_day(spark, 2, 5_000), settings)
        return out

    monkeypatch.setattr(store, "load_tables", slow)
    store.compact(spark, folder + "/s")
    rows = store.load_tables(spark, folder + "/s")[0]["t"].collect()
    assert len(rows) == 400 and {r.x for r in rows if r.d == 2} == set(range(5_000, 5_050))


def test_requests_are_routed_and_kept(spark):
    rows = [(1, "os", "10.0.0.1", "u"), (2, "os", None, "u"), (3, "os", None, None)]
    routed = requests.route(spark.createDataFrame(rows, "id long, source string, src_ip string, user_name string"))
    assert {r.id: (r.type, r.name) for r in routed.collect()} == {1: ("entity", "10.0.0.1"), 2: ("user", "u"), 3: (None, None)}


def test_requests_read_the_groups_they_ask_for(spark, folder):
    groups = [f"g{k}" for k in range(200)]
    table = spark.createDataFrame([(g, k, float(k)) for g in groups for k in range(3)], "type string, n int, x double")
    store.save_tables(spark, folder + "/s", {"t": table}, {"group_cols": ["type"]})
    asked = spark.createDataFrame([(g,) for g in (*groups[:4], None, "unknown")], "type string")
    found = store.load_tables(spark, folder + "/s", asked)[0]["t"]
    assert {r.type for r in found.collect()} == set(groups[:4]) and found.count() == 12
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{store.FOLDER}" in plan.replace("PartitionFilters: [isnotnull", f"PartitionFilters: [{store.FOLDER} isnotnull")
    whole = store.load_tables(spark, folder + "/s")[0]["t"]
    assert written_bytes(found) < written_bytes(whole) / 4 and whole.columns == table.columns


def test_left_join_misses_stay_null(spark, activity):
    scores = I.frozen_scores(activity).withColumn("pas", S.ensemble([F.col(c) for c in PARTS]))
    some = alerts.alert_scores(materialise(activity.where("type = 'user'"), "users"))
    joined = alerts.overall_score(scores, some, match_type=True)
    missing = joined.where("type = 'entity'")
    assert joined.count() == activity.count()
    assert missing.where("overall_anomaly_score is not null or is_nu_alert_ratio is not null").isEmpty()


def test_day_without_alert_range_scores_zero(spark):
    rows = [("a", "user", 2024, 1, 1, 10, 3, 0), ("b", "user", 2024, 1, 1, 10, 3, 4)]
    day = spark.createDataFrame(rows, "name string, type string, y int, m int, d int, total_events long, is_nu_alert_count long, is_ne_alert_count long")
    found = {r.name: (r.is_nu_alert_score, r.is_ne_alert_score) for r in alerts.alert_scores(day).collect()}
    assert found == {"a": (0.0, 0.0), "b": (0.0, 100.0)}


def test_scores_written_twice_do_not_double(spark, scored, folder):
    rows = sinks.score_rows(scored, 1)
    for _ in range(2):
        sinks.write_scores_path(rows, folder + "/t")
    sinks.write_scores_path(rows.where("d = 1"), folder + "/t")
    back = spark.read.parquet(folder + "/t")
    assert back.count() == scored.count() and back.select(rows.columns).exceptAll(rows).isEmpty()


def test_score_table_ddl_and_insert_by_name(spark, scored):
    sinks.create_score_table(spark, "profile_scores_test", fmt="parquet")
    rows = sinks.score_rows(scored, 1)
    sinks.write_scores_table(rows.select(*reversed(rows.columns)), "profile_scores_test")
    stored = spark.table("profile_scores_test")
    assert stored.select(rows.columns).exceptAll(rows).isEmpty()
    spark.sql("DROP TABLE profile_scores_test")


def test_daily_job_reads_its_days_and_can_run_again(spark, activity, folder):
    sinks.by_day(activity).write.partitionBy("y", "m", "d").format("parquet").saveAsTable("daily_profiles_test")
    wanted = activity.where("m = 1 and d in (2, 3)")
    left = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    before = set(os.listdir(left))
    for _ in range(2):
        daily.run(spark, "daily_profiles_test", "daily_scores_test", "2024-01-03", 2, 7, folder + "/m", n_trees=10)
    assert set(os.listdir(left)) <= before  # no scratch table of the runs is left
    stored = spark.table("daily_scores_test")
    assert stored.count() == wanted.count() and stored.select(KEYS).exceptAll(wanted.select(KEYS)).isEmpty()
    assert daily.load(spark, folder + "/m") is not None
    spark.sql("DROP TABLE daily_profiles_test")
    spark.sql("DROP TABLE daily_scores_test")


def test_the_daily_store_holds_every_day_and_all_trees(spark, sf, activity, monkeypatch):
    from registry import queries

    stored = []
    save = queries.daily.save
    monkeypatch.setattr(queries.daily, "save", lambda spark, models, path: (stored.append(models), save(spark, models, path)))
    queries.model_store_every_day(spark, sf)
    days = [{tuple(r) for r in m.ranges.select("y", "m", "d").distinct().collect()} for m in stored]
    assert len(days) > 1 and sum(map(len, days)) == len(set.union(*days))
    assert set.union(*days) == {tuple(r) for r in activity.select("y", "m", "d").distinct().collect()}
    assert {m.forest.trees.agg({"tree": "max"}).first()[0] for m in stored} == {999}
