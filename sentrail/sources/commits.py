"""A folder's log of commits: what belongs to a table that several writers append to, and in which order.

Data is written first, under a name of its own, and counts once a commit, a small JSON file, names it; a writer that
broke off leaves data that nothing names. Commits of ``append`` have a number and a name that no other has, so writers
at the same time, also on object stores, take nothing from each other; equal numbers are in the order of
names. Commits are read whole, so folders should be compacted before they are many.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _files(spark, path)
    return files.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _files(spark, path)
    files.delete(hadoop_path, True)


def commit(spark: SparkSession, folder: str, name: str, content: dict) -> None:
    """Write commit ``name``."""
    files, path = _files(spark, f"{folder.rstrip('/')}/commits/{name}.json")
    out = files.create(path, False)
    # one write, so that a reader sees all of it or none
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()


def append(spark: SparkSession, folder: str, content: dict) -> None:
    """Add a commit after all that are there."""
    number = max([int(name.split("-")[0]) for name in commits(spark, folder)], default=-1) + 1
    commit(spark, folder, f"{number:012d}-{uuid.uuid4().hex}", content)


def commits(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Content of every commit by name, in the order of names. One that is being written does not count yet."""
    files, path = _files(spark, f"{folder.rstrip('/')}/commits")
    if not files.exists(path):
        return {}
    names = sorted(status.getPath().getName() for status in files.listStatus(path))
    found = {}
    for name in names:
        if name.endswith(".json") and not name.startswith("."):
            try:
                found[name.removesuffix(".json")] = json.loads(read_text(spark, f"{folder.rstrip('/')}/commits/{name}"))
            except json.JSONDecodeError:
                continue
    return found


def live(spark: SparkSession, folder: str) -> dict[str, dict]:
    """The commits that no compaction covers, in the order that counts: a compaction stands where the last one that it covers stood."""
    found = commits(spark, folder)
    covered = {name for content in found.values() for name in content.get("covers", [])}
    return dict(sorted(((n, c) for n, c in found.items() if n not in covered), key=lambda item: item[1].get("covers", [item[0]])[-1]))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, on the driver."""
    files, hadoop_path = _files(spark, path)
    stream = files.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
