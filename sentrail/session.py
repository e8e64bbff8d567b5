"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_roots: dict[str, str] = {}


def local_session(cores: str = "8", app: str = "sentrail", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` wins, then a directory set on the context. A temporary folder is
    made only in local mode, where driver and executors are one process; anywhere else a
    missing setting is an error, since a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_KEY) or context.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local(\[|$)", context.master):  # local-cluster has executors of its own
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    app = context.applicationId
    if app not in _roots:
        _roots[app] = tempfile.mkdtemp(prefix="sentrail-")
    return _roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, removed when the innermost ``released`` ends, else when the driver's file
    system closes."""
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    files, hadoop_path = _file(spark, path)
    files.deleteOnExit(hadoop_path)
    scopes = _scopes.get()
    if scopes:
        scopes[-1].append(path)
    return path


def _file(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch_scopes", default=())


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside at the end: for work whose result is written elsewhere before that."""
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            files, hadoop_path = _file(spark, path)
            files.delete(hadoop_path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a frame is read more than once or an iteration would grow its lineage. Unlike a
    cache it survives lost executors without recomputing; unlike ``checkpoint()`` it runs the
    plan once, stays columnar and gives the planner file sizes to choose joins by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._paths = [path]
    return written


def remove(df: DataFrame) -> None:
    """Remove the files of a table that ``materialise`` wrote, once nothing reads it any more."""
    for path in df._paths:
        files, hadoop_path = _file(df.sparkSession, path)
        files.delete(hadoop_path, True)


def row_count(df: DataFrame) -> int:
    """Rows of a written table, counted once (Parquet keeps the count in its footers)."""
    if not hasattr(df, "_row_count"):
        df._row_count = df.count()
    return df._row_count


def written_bytes(df: DataFrame) -> int | None:
    """Bytes of the files of a table that ``materialise`` or the model store wrote; None for any other frame."""
    if not hasattr(df, "_paths"):
        return None
    if not hasattr(df, "_bytes"):
        found = [_file(df.sparkSession, path) for path in df._paths]
        df._bytes = sum(files.getContentSummary(path).getLength() for files, path in found)
    return df._bytes
