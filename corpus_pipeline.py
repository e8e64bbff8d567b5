"""From raw documents to packed training bins, stage by stage, each stage's rows written before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. The first four return
the columns they were given, without the documents they reject; the last one returns the bins. Texts go to Python and
back in small batches, whatever the session's own limit is: a stage that sends them writes its rows before it returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentrail.llm import decontamination, packing, parity_join, quality_rules, toxicity
from sentrail.llm.arrow import carried as _carried
from sentrail.llm.arrow import restored as _restored
from sentrail.llm.arrow import small_batches
from sentrail.session import released, scratch_path

TOXIC_FROM = 0.7


def _written(spark: SparkSession, label: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """What ``rows`` gives, written with small batches; what was made on the way is removed."""
    path = scratch_path(spark, label)
    with small_batches(spark), released(spark):
        made = rows()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity score reaches ``TOXIC_FROM``; the model learns from labels of documents still here."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def kept() -> DataFrame:
        tagged = toxicity.tag(_carried(docs, "text"), toxicity.fit(docs, labels))
        return _restored(tagged.filter(f"score < {TOXIC_FROM}"), docs, "text")

    return _written(spark, "not_toxic", kept)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that fail the base rules or lie beyond their group's fences."""
    worked_on = ("text", "lang", "source")

    def kept() -> DataFrame:
        return _restored(quality_rules.adaptive_filter(_carried(docs, *worked_on)).filter("kept"), docs, *worked_on)

    return _written(spark, "good_quality", kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of every component of near duplicates."""
    return parity_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that a benchmark item's passages make up a twentieth of."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _written(spark, "decontaminated", lambda: decontamination.decontaminate(docs, benchmark))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins without two of a source or of a duplicate cluster."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_bins),
]

#: no SQL: the fitted toxicity model and the packing order can't be told in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet under the shared folder and read again.

    What a stage needed on the way is removed once its rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        with released(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
