"""Best-fit packing of documents into bins of fixed capacity, without conflicts inside a bin.

Length is the number of words (runs without white space). A document longer than a bin fills whole bins of its
own, and its rest is packed like a short document. Two pieces conflict when their documents share a source or
a duplicate cluster (texts that are equal once A-Z are lower-cased); a bin never holds both.

Rests are dealt by hash into pools of about ``POOL`` documents, each packed by one task: longest first, into
the bin with the smallest sufficient residual. Bins are ordered by residual and carry bitmaps of the sources
and clusters they hold; the search starts at the tightest bin that is large enough and goes on to its
successors until one is compatible, or opens a new bin. A hot source spreads over all pools like any other.

Null and empty texts have length 0 and take a place all the same; a null source conflicts with nothing, and
neither do empty texts by cluster; repeated rows are packed each (equal texts in different bins); an empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrail.llm.arrow import small_batches
from sentrail.llm.words import BY_SPACE, blocks, split
from sentrail.session import materialise, row_count

CAPACITY = 2048
POOL = 4096
SCHEMA = "doc_id long, piece long, pool long, bin long, start long, n_words long, first_word long, source string, cluster long"


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and start of each piece, taken in the given order; -1 as source or cluster conflicts with nothing."""
    ordered: list[tuple[int, int]] = []  # (residual, bin)
    held_sources: list[int] = []  # bitmaps
    held_clusters: list[int] = []
    bins, starts = [], []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        source_bit, cluster_bit = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        at = bisect_left(ordered, (length, -1))
        while at < len(ordered) and (held_sources[ordered[at][1]] & source_bit or held_clusters[ordered[at][1]] & cluster_bit):
            at += 1
        if at < len(ordered):
            residual, number = ordered.pop(at)
        else:
            residual, number = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[number] |= source_bit
        held_clusters[number] |= cluster_bit
        insort(ordered, (residual - length, number))
        bins.append(number)
        starts.append(capacity - residual)
    return bins, starts


def _numbers(values: pa.ChunkedArray) -> np.ndarray:
    """Small numbers for equal values, -1 for null."""
    return pd.factorize(values.to_pandas(types_mapper=pd.ArrowDtype))[0]


def pack_pool(rows: pa.Table, capacity: int) -> pa.Table:
    """Pieces of one pool's documents. Whole-bin pieces have bins after those that are shared."""
    rows = rows.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("source", "ascending")])
    length = rows.column("n_words").to_numpy()
    whole = np.maximum(0, -(-length // capacity) - 1)
    rest = length - whole * capacity
    order = np.argsort(-rest, kind="stable")
    clusters = np.where(length > 0, _numbers(rows.column("cluster")), -1)
    bins, starts = best_fit(rest[order].tolist(), _numbers(rows.column("source"))[order].tolist(), clusters[order].tolist(), capacity)
    own = np.repeat(np.arange(len(length)), whole)
    own_piece = np.arange(len(own)) - np.repeat(np.cumsum(whole) - whole, whole)
    facts = rows.take(pa.array(np.concatenate([order, own])))
    piece = np.concatenate([whole[order], own_piece])
    columns = {
        "doc_id": facts.column("doc_id"),
        "piece": piece,
        "pool": facts.column("pool"),
        "bin": np.concatenate([bins, np.arange(len(own)) + (max(bins, default=-1) + 1)]).astype(np.int64),
        "start": np.concatenate([starts, np.zeros(len(own))]).astype(np.int64),
        "n_words": np.concatenate([rest[order], np.full(len(own), capacity)]).astype(np.int64),
        "first_word": piece * capacity,
        "source": facts.column("source"),
        "cluster": facts.column("cluster"),
    }
    return pa.table(columns)


def lengths(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_words, cluster of every document. Lazy, no shuffle; texts go to Python and don't come back."""
    # equal texts share a cluster; only its number is needed to tell them apart
    same = F.xxhash64(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                n_words = pa.array(split(block.column("text"), BY_SPACE).counts)
                columns = [block.column("doc_id"), block.column("source"), n_words, block.column("cluster")]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "n_words", "cluster"])

    facts = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text", same.alias("cluster"))
    return facts.mapInArrow(run, "doc_id long, source string, n_words long, cluster long")


def pack(docs: DataFrame, capacity: int = CAPACITY, pool: int = POOL) -> DataFrame:
    """One row per piece: doc_id, piece, pool, bin (of the pool), start in the bin, n_words, first_word in the document, source, cluster."""
    with small_batches(docs.sparkSession):
        rows = materialise(lengths(docs), "lengths")
    pools = max(1, -(-row_count(rows) // pool))
    dealt = rows.withColumn("pool", F.pmod(F.xxhash64(*rows.columns, F.lit("pool")), F.lit(pools)).cast("long"))
    return dealt.groupBy("pool").applyInArrow(lambda part: pack_pool(part, capacity), SCHEMA)
