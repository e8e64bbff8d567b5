"""Spark side of the word-level operators: columns computed from whole texts, rows staying where they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.llm.words import blocks


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns of these names in any case: an operator's own columns replace what came with them."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{name}`") for name in df.columns if name.lower() not in taken])


def carried(docs: DataFrame, *names: str) -> DataFrame:
    """The columns a stage works on, and the others in ``_doc``: no column of a user meets one of the stage's own, and a
    row's text goes through the stage once."""
    others = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in names]
    return docs.select(*([F.struct(*others).alias("_doc")] if others else []), *names)


def restored(kept: DataFrame, docs: DataFrame, *names: str) -> DataFrame:
    """The columns of ``docs``, in their order, of what is left of ``carried`` rows."""
    return kept.select(*[F.col(name.lower()).alias(name) if name.lower() in names else F.col(f"_doc.`{name}`") for name in docs.columns])


#: bytes of rows that go to a Python worker at a time while ``small_batches`` holds
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Send texts to Python in batches of about ``most`` bytes, not of as many rows as there are: an executor holds a batch
    several times over. For tables that are written inside; afterwards the session's own limit holds again."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def add_columns(
    docs: DataFrame, fields: T.StructType, compute: Callable[[pa.RecordBatch], Sequence[pa.Array]], text: str = "text"
) -> DataFrame:
    """``docs`` with ``fields`` appended, computed block by block from the whole texts. Narrow: nothing is shuffled."""
    kept = without(docs, fields.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text):
                made = [pa.array(x) if not isinstance(x, pa.Array) else x for x in compute(block)]
                yield pa.RecordBatch.from_arrays([*block.columns, *made], names=[*block.schema.names, *fields.names])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields.fields]))


def longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])
