"""Labels as the classifiers may see them: held-out rows never reach a fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(folds: int) -> Column:
    """crc32 of the document id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def training_labels(labels: DataFrame, name: str, folds: int, held: int) -> DataFrame:
    """(doc_id, label) of the rows outside fold ``held``, one per document; of repeated rows the largest label counts.

    A label is 0 or 1; rows with any other, or with none, teach nothing."""
    rows = labels.select("doc_id", F.col(name).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    return rows.filter(remainder(folds) != held).groupBy("doc_id").agg(F.max("label").alias("label"))


def bounded_sample(rows: DataFrame, most: int) -> DataFrame:
    """Rows whose hashed id is below the share that gives about ``most`` rows; all of them where there are fewer."""
    n = max(1, rows.count())
    if n <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * most / n))
