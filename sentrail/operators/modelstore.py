"""Trained models as Parquet tables and MLlib pipelines, in a store that saves add to; a missing one loads as None."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrail.operators.iforest import ForestModel
from sentrail.operators.kmeans import DistanceModel, GroupedDistanceModel
from sentrail.operators.ocsvm import OneClassModel
from sentrail.session import materialise
from sentrail.sources import commits as log


def model_path(root: str, source: str, anomaly_type: str, model_name: str, *scope: str) -> str:
    """Where a model lives: source, scope (day, actor type or window), anomaly type, name."""
    return "/".join([root.rstrip("/"), source, *scope, anomaly_type, model_name])


def _same(group: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in group])


def save_tables(spark: SparkSession, path: str, tables: dict[str, DataFrame | None], settings: dict) -> None:
    """Add the model's tables to the store at ``path``; nothing that is there is read, copied or written over.

    A save writes its own rows and then a commit that names them (see ``commits``), so several writers may
    save at once and a save that broke off counts for nothing. Of a group (by the ``group_cols`` of ``settings``)
    that several saves hold the latest counts; without groups the latest save does. Models with other
    settings can't share a path.
    """
    present = {name: table for name, table in tables.items() if table is not None}
    stored = json.loads(json.dumps(settings))
    group = settings.get("group_cols")
    for content in list(log.live(spark, path).values())[-1:]:
        if group and (content["settings"] != stored or set(content["tables"]) != set(present)):
            raise ValueError(f"the model at {path} has other settings: {content['settings']}")
    log.append(spark, path, {"data": _written(spark, path, present, group), "tables": list(present), "settings": stored})


#: the groups that a save holds, and into how many folders, by hash of the group, its tables are dealt
GROUPS = "groups_of_save"
FOLDER, FOLDERS = "folder_of_group", 64


def _folder(group: list[str]) -> Column:
    return F.pmod(F.xxhash64(*group), F.lit(FOLDERS)).cast("int")


def _written(spark: SparkSession, path: str, tables: dict[str, DataFrame], group: list[str] | None) -> str:
    """Where a save's tables now lie, dealt by group so that a few groups can be read without the others."""
    data = f"{path}/data/{uuid.uuid4().hex}"
    for name, table in tables.items():
        if group:
            table.withColumn(FOLDER, _folder(group)).hint("rebalance", FOLDER).write.partitionBy(FOLDER).parquet(f"{data}/{name}")
        else:
            table.write.parquet(f"{data}/{name}")
    if group:
        # read back, so that a model worked out lazily is worked out once
        keys = reduce(DataFrame.union, [_stored(spark, [f"{data}/{name}"]).select(*group) for name in tables])
        keys.distinct().write.parquet(f"{data}/{GROUPS}")
    return data


def load_tables(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> tuple[dict[str, DataFrame], dict] | None:
    """Tables and settings of the stored model: of every group the rows of its latest save.

    With ``wanted``, a written table of groups, only those: folders without any are not read."""
    saves = list(log.live(spark, path).values())
    if not saves:
        return None
    settings, names = saves[-1]["settings"], saves[-1]["tables"]
    group = settings.get("group_cols")
    if wanted is not None and group:
        asked = materialise(wanted.select(*group).dropna().distinct(), "wanted-groups")
        folders = sorted(row[0] for row in asked.select(_folder(group)).distinct().collect())  # FOLDERS at most
        tables, _ = load_tables(spark, path)
        pruned = {}
        for name, table in tables.items():
            some = table._with_folders.where(F.col(FOLDER).isin(folders)).alias("_old")
            pruned[name] = some.join(asked.alias("_new"), _same(group), "left_semi").drop(FOLDER)
            paths = [f"{whole}/{FOLDER}={folder}" for whole in table._paths for folder in folders]
            pruned[name]._paths = [p for p in paths if log.exists(spark, p)]
        return pruned, settings
    if not group or len(saves) == 1:
        return {name: _stored(spark, [f"{saves[-1]['data']}/{name}"]) for name in names}, settings
    held = reduce(DataFrame.union, [spark.read.parquet(f"{save['data']}/{GROUPS}").withColumn("_save", F.lit(k)) for k, save in enumerate(saves)])
    latest = materialise(held.groupBy(*group).agg(F.max("_save").alias("_save"), F.count(F.lit(1)).alias("_n")), "latest-saves")
    # a save is read whole unless a later one has some of its groups
    stale = materialise(held.alias("_old").join(latest.where("_n > 1").alias("_new"), _same(group)).where("_old._save < _new._save").select("_old.*"), "stale-groups")
    mixed = {row["_save"] for row in stale.select("_save").distinct().collect()}
    tables = {}
    for name in names:
        parts = []
        for k, save in enumerate(saves):
            part = spark.read.parquet(f"{save['data']}/{name}")  # with its folder
            parts.append(part.alias("_old").join(stale.where(F.col("_save") == k).alias("_new"), _same(group), "left_anti") if k in mixed else part)
        tables[name] = _named(reduce(DataFrame.unionByName, parts), [f"{save['data']}/{name}" for save in saves])
    return tables, settings


def _named(rows: DataFrame, paths: list[str]) -> DataFrame:
    """A stored table that knows its files, and itself with the folders of its rows."""
    table = rows.drop(FOLDER)
    table._paths, table._with_folders = paths, rows
    return table


def _stored(spark: SparkSession, paths: list[str]) -> DataFrame:
    return _named(spark.read.parquet(*paths), paths)


def compact(spark: SparkSession, path: str) -> None:
    """Write the stored model as one save that takes the place of those it was read from. Saves made meanwhile stay as they are."""
    covered = list(log.live(spark, path))
    loaded = load_tables(spark, path)
    if loaded is None or len(covered) < 2:
        return
    tables, settings = loaded
    data = _written(spark, path, tables, settings.get("group_cols"))
    log.append(spark, path, {"data": data, "tables": list(tables), "settings": settings, "covers": covered})


def clean(spark: SparkSession, path: str) -> None:
    """Remove the data of saves that a compaction took the place of; only when no one reads them any more."""
    found = log.commits(spark, path)
    for name in {name for content in found.values() for name in content.get("covers", [])}:
        log.remove(spark, found[name]["data"])


def version(spark: SparkSession, path: str) -> str | None:
    """What changes when the store does: the name of its latest commit."""
    return max(log.commits(spark, path), default=None)


def _columns(model) -> dict:
    return {"group_cols": list(model.group_cols), "num_cols": list(model.num_cols), "cat_cols": list(model.cat_cols)}


def _as_tuples(settings: dict) -> dict:
    return {k: tuple(v) if isinstance(v, list) else v for k, v in settings.items()}


def save_grouped_distance(spark: SparkSession, model: GroupedDistanceModel, path: str) -> None:
    tables = {"scaling": model.scaling, "centroids": model.centroids, "categories": model.categories}
    save_tables(spark, path, tables, _columns(model))


def load_grouped_distance(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> GroupedDistanceModel | None:
    stored = load_tables(spark, path, wanted)
    if stored is None:
        return None
    tables, settings = stored
    return GroupedDistanceModel(categories=tables.pop("categories", None), **tables, **_as_tuples(settings))


def save_forest(spark: SparkSession, model: ForestModel, path: str) -> None:
    save_tables(spark, path, {"trees": model.trees, "scaling": model.scaling}, _columns(model))


def load_forest(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> ForestModel | None:
    stored = load_tables(spark, path, wanted)
    return None if stored is None else ForestModel(**stored[0], **_as_tuples(stored[1]))


def save_one_class(spark: SparkSession, model: OneClassModel, path: str) -> None:
    settings = _columns(model) | {"gamma": model.gamma}
    save_tables(spark, path, {"model": model.model, "scaling": model.scaling}, settings)


def load_one_class(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> OneClassModel | None:
    stored = load_tables(spark, path, wanted)
    return None if stored is None else OneClassModel(**stored[0], **_as_tuples(stored[1]))


def save_distance(spark: SparkSession, model: DistanceModel, path: str) -> None:
    """The pipeline in a folder of its own, then the version that names it."""
    folder = f"{path}/pipeline-{uuid.uuid4().hex}"
    model.pipeline.write().save(folder)
    save_tables(spark, path, {}, {"folder": folder, "low": model.low, "high": model.high})


def load_distance(spark: SparkSession, path: str) -> DistanceModel | None:
    stored = load_tables(spark, path)
    return None if stored is None else DistanceModel(PipelineModel.load(stored[1]["folder"]), stored[1]["low"], stored[1]["high"])
