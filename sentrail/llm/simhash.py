"""Near duplicates by SimHash fingerprints under the general pigeonhole principle.

A fingerprint has 64 bits: a bit is 1 where it is set in over half of the XXH64 values (seed 42) of a text's
4-word shingles, repeats included. Two documents link when their fingerprints differ in at most ``DISTANCE`` bits.

1. Equal fingerprints form a class; only classes are compared.
2. The 64 bits are grouped into partitions, correlated bits together, from counts over all classes of how often
   two bits are set together.
3. If the thresholds of m partitions add up to ``DISTANCE`` - m + 1, two linked fingerprints are within its threshold
   in some partition (-1 leaves a partition out). Each fingerprint gets thresholds of its own: a dynamic program
   shares ``DISTANCE`` + 1 units out (threshold + 1 each) at least cost, that of probing all values within the
   threshold and of the candidates found there. Candidates are estimated from histograms of parts of at most 8
   bits over all classes. m is the number of partitions whose total cost over all classes is least.
4. Every fingerprint is indexed under its value in each partition and probes the values within its thresholds.
   Each probe is verified against the least and the greatest fingerprint indexed under a key in the join that
   finds them. What these confirm is joined into components, and keys that hold one component are done.
5. Keys left with few rows have their pairs of different components verified. In larger ones every row is
   verified against a centre, and the key is cut in ``DISTANCE`` + 1 blocks of the bits that vary in it: linked
   fingerprints agree on a block, so keys (key, block, value) hold them again. A cut key varies in fewer bits, and
   with ``DISTANCE`` or fewer all its rows link, so this ends; copies cost a few checks each, not one per pair.

The result is exact, and the same for any partitioning: nothing is capped. A null or empty text or one without words
has fingerprint zero and links like any other; a text of fewer than four words is one shingle; repeated rows share
a class; a null doc_id counts in no minimum, and its component is its class's (null where all its ids are). An empty
table gives an empty result. Extra columns are ignored, whatever their names. A text is held whole in one task, at
about 100 bytes a byte.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrail.llm.components import components
from sentrail.llm.words import BY_SPACE, blocks, mix, split
from sentrail.session import materialise, row_count

SHINGLE = 4
SEED = 42
BITS = 64
DISTANCE = 4
#: numbers of partitions that are weighed against each other
PARTS = (2, 3, 4, 5)
#: bits of a histogram; a partition has as many histograms as it needs
HISTOGRAM_BITS = 8
#: cost of a candidate beside that of a probed key: keys are dealt out evenly, candidates of a value meet in one task
CANDIDATE_COST = 4.0
#: rows of a key up to which its pairs are verified one by one
PAIR_ROWS = 128


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of every text, as unsigned 64-bit numbers."""
    words = split(column, BY_SPACE, lower=True)
    out = np.zeros(len(column), dtype=np.uint64)
    lengths = words.ends - words.starts
    if not len(lengths):
        return out
    # all words again, one blank after each, so that every shingle is one run of bytes
    last = np.cumsum(lengths + 1) - 1
    first = last - lengths
    joined = np.full(int(last[-1]) + 1, 0x20, dtype=np.uint8)
    inside = np.ones(len(joined), dtype=bool)
    inside[last] = False
    joined[inside] = words.data[np.repeat(words.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]
    counts = words.counts
    made = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    of = np.cumsum(made) - made
    start = np.repeat(words.of[:-1] - of, made) + np.arange(int(made.sum()))
    stop = start + np.repeat(np.minimum(counts, shingle), made) - 1
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(first[start].tolist(), last[stop].tolist(), strict=True)
    hashes = np.fromiter((digest(data[low:high], SEED) for low, high in spans), dtype=np.uint64, count=len(start))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    some = np.flatnonzero(made)
    votes = np.stack([np.add.reduce(bits[low:high], axis=0, dtype=np.int32) for low, high in zip(of[some].tolist(), (of + made)[some].tolist(), strict=True)])
    out[some] = np.packbits(2 * votes > made[some, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every document, the fingerprint as a signed long. Lazy, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(fingerprints(block.column("text")).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)


def _as_bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(classes: DataFrame, size: int, count: object) -> np.ndarray:
    """Sum over all classes of ``count`` of a batch's fingerprints, an array of ``size`` numbers: a row per number and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += count(_fps(batch))
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["place", "n"])

    out = np.zeros(size)
    for row in classes.select("fp").mapInArrow(run, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        out[row["place"]] = row["n"]
    return out


def correlations(classes: DataFrame) -> np.ndarray:
    """Absolute correlation of every two bits over all classes."""

    def together(fps: np.ndarray) -> np.ndarray:
        bits = np.hstack([_as_bits(fps).astype(np.float32), np.ones((len(fps), 1), dtype=np.float32)])
        return (bits.T @ bits).astype(np.float64).ravel()

    sums = _summed(classes, (BITS + 1) ** 2, together).reshape(BITS + 1, BITS + 1)
    n = max(1.0, sums[BITS, BITS])
    mean = sums[BITS, :BITS] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs(sums[:BITS, :BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits of each partition: the free bit most correlated with all others opens one, those most correlated with it follow."""
    free, out = list(range(BITS)), []
    for part in range(parts):
        width = (BITS - sum(map(len, out))) // (parts - part)
        inner = correlation[np.ix_(free, free)]
        chosen = [free.pop(int(np.argmax(inner.sum(axis=0))))]
        while len(chosen) < width:
            chosen.append(free.pop(int(np.argmax(correlation[np.ix_(chosen, free)].sum(axis=0)))))
        out.append(sorted(chosen))
    return out


def _mask(bits: Sequence[int]) -> np.uint64:
    return np.uint64(sum(1 << bit for bit in bits))


@lru_cache(maxsize=64)
def _flips(bits: tuple[int, ...], most: int) -> np.ndarray:
    """Masks of one to ``most`` of the bits."""
    return np.array([sum(1 << bit for bit in some) for size in range(1, most + 1) for some in combinations(bits, size)], dtype=np.uint64)


def _value(bits: np.ndarray, chosen: Sequence[int]) -> np.ndarray:
    return bits[:, chosen].astype(np.int64) @ (1 << np.arange(len(chosen)))


class Allocation:
    """Partitions of the bits and what is known about the values in them, to share out a fingerprint's thresholds."""

    def __init__(self, grouped: list[list[int]], distance: int):
        self.grouped, self.units = grouped, distance + 1
        self.masks = [_mask(bits) for bits in grouped]
        self.pieces = [(part, list(bits[low : low + HISTOGRAM_BITS])) for part, bits in enumerate(grouped) for low in range(0, len(bits), HISTOGRAM_BITS)]
        self.near: list[np.ndarray] = []

    @property
    def size(self) -> int:
        return len(self.pieces) << HISTOGRAM_BITS

    def histograms(self, fps: np.ndarray) -> np.ndarray:
        bits = _as_bits(fps)
        return np.concatenate([np.bincount(_value(bits, chosen), minlength=1 << HISTOGRAM_BITS) for _, chosen in self.pieces]).astype(np.float64)

    def learn(self, histograms: np.ndarray) -> None:
        """``near[piece][value, d]``: the share of all classes whose value is ``d`` bits from ``value``."""
        values = np.arange(1 << HISTOGRAM_BITS)
        apart = np.bitwise_count(values[:, None] ^ values[None, :])
        for held in histograms.reshape(len(self.pieces), -1):
            share = held / max(1.0, held.sum())
            self.near.append(np.stack([(apart == d) @ share for d in range(self.units)], axis=1))
        self.total = float(histograms[: 1 << HISTOGRAM_BITS].sum())

    def share(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units of each fingerprint (row) in each partition, which are its threshold and one, and the least cost."""
        bits = _as_bits(fps)
        best = np.full((len(fps), self.units + 1), np.inf)
        best[:, 0] = 0
        taken = []
        for part, chosen in enumerate(self.grouped):
            at = np.zeros((len(fps), self.units))
            at[:, 0] = 1
            for (owner, piece), near in zip(self.pieces, self.near, strict=True):
                if owner == part:  # distances of the pieces add up, as if they were independent
                    found = near[_value(bits, piece)]
                    at = np.stack([sum(at[:, j] * found[:, d - j] for j in range(d + 1)) for d in range(self.units)], axis=1)
            candidates = np.cumsum(at, axis=1) * self.total
            probes = np.cumsum([comb(len(chosen), d) for d in range(self.units)])
            cost = np.hstack([np.zeros((len(fps), 1)), CANDIDATE_COST * candidates + probes])
            now, units = np.full_like(best, np.inf), np.zeros(best.shape, dtype=np.int64)
            for total in range(self.units + 1):
                for unit in range(total + 1):
                    price = best[:, total - unit] + cost[:, unit]
                    better = price < now[:, total]
                    now[better, total], units[better, total] = price[better], unit
            best = now
            taken.append(units)
        left = np.full(len(fps), self.units)
        out = np.zeros((len(fps), len(self.grouped)), dtype=np.int64)
        for part in reversed(range(len(self.grouped))):
            out[:, part] = taken[part][np.arange(len(fps)), left]
            left -= out[:, part]
        return out, best[:, self.units]

    def index_keys(self, fps: np.ndarray, part: int) -> np.ndarray:
        return _key(fps & self.masks[part], part)


def _key(value: np.ndarray, part: int) -> np.ndarray:
    return mix(mix(value) + mix(np.array([part + 1]))).view(np.int64)


def allocate(classes: DataFrame, distance: int, parts: Sequence[int] = PARTS) -> Allocation:
    """The partitions of least cost for all classes, with their histograms."""
    correlation = correlations(classes)
    choices = [Allocation(group_bits(correlation, m), distance) for m in parts]
    sizes = [choice.size for choice in choices]
    held = _summed(classes, sum(sizes), lambda fps: np.concatenate([choice.histograms(fps) for choice in choices]))
    for choice, own in zip(choices, np.split(held, np.cumsum(sizes)[:-1]), strict=True):
        choice.learn(own)
    costs = _summed(classes, len(choices), lambda fps: np.array([choice.share(fps)[1].sum() for choice in choices]))
    return choices[int(np.argmin(costs))]


def _index(classes: DataFrame, plan: Allocation) -> DataFrame:
    """(key, fp) of every class in every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _fps(batch)
            keys = np.concatenate([plan.index_keys(fps, part) for part in range(len(plan.grouped))])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(fps, len(plan.grouped)).view(np.int64))], names=["key", "fp"])

    return classes.select("fp").mapInArrow(run, "key long, fp long")


def _probes(classes: DataFrame, plan: Allocation, most: int = 1 << 18) -> DataFrame:
    """(key, fp, own) of every value within a class's thresholds; ``own`` is 1 for the value that it has itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _fps(batch)
            units, _ = plan.share(fps)
            for part, bits in enumerate(plan.grouped):
                for unit in np.unique(units[:, part]):
                    rows = fps[units[:, part] == unit]
                    if unit == 0:
                        continue
                    flips = np.concatenate([np.zeros(1, dtype=np.uint64), _flips(tuple(bits), int(unit) - 1)])
                    step = max(1, most // len(flips))
                    for low in range(0, len(rows), step):
                        some = rows[low : low + step]
                        values = (some & plan.masks[part])[:, None] ^ flips[None, :]
                        own = np.zeros(values.shape, dtype=np.int32)
                        own[:, 0] = 1
                        columns = [_key(values.ravel(), part), np.repeat(some, len(flips)).view(np.int64), own.ravel()]
                        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=["key", "fp", "own"])

    return classes.select("fp").mapInArrow(run, "key long, fp long, own int")


def _near(one: str, two: str, distance: int) -> str:
    return f"{one} <> {two} and bit_count({one} ^ {two}) <= {distance}"


def _blocks(rows: DataFrame, pieces: int) -> DataFrame:
    """(key, fp, own) of rows (key, fp, own, vary) under a new key for each block of the bits that vary in their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, key = _fps(batch), batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            vary = _as_bits(batch.column("vary").to_numpy(zero_copy_only=False).view(np.uint64))
            place = np.cumsum(vary, axis=1, dtype=np.int64) - 1
            for piece in range(pieces):
                mask = np.packbits((vary == 1) & (place % pieces == piece), axis=1, bitorder="little").view("<u8")[:, 0]
                made = _key(mix(key) ^ (fps & mask), piece)
                yield pa.RecordBatch.from_arrays([pa.array(made), batch.column("fp"), batch.column("own")], names=["key", "fp", "own"])

    return rows.select("key", "fp", "own", "vary").mapInArrow(run, "key long, fp long, own int")


def _named(rows: DataFrame, parts: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their fingerprint."""
    if parts is None:
        return rows.withColumn("component", F.col("fp"))
    return rows.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def link_classes(classes: DataFrame, distance: int = DISTANCE, parts_of: Sequence[int] = PARTS, pair_rows: int = PAIR_ROWS) -> DataFrame | None:
    """(node, component) of every fingerprint that links with another; None where none does."""
    plan = allocate(classes, distance, parts_of)
    index = _index(classes, plan)
    held = index.groupBy("key").agg(F.min("fp").alias("least"), F.max("fp").alias("most"), F.count("*").alias("n"))
    # the planner sizes both sides by the classes that they are made from, and would broadcast many times that
    found = _probes(classes, plan).join(held.hint("merge"), "key").filter("fp <> least or fp <> most")
    found = materialise(found, "probes")
    links = found.filter(_near("fp", "least", distance)).selectExpr("fp as a", "least as b")
    links = links.union(found.filter(_near("fp", "most", distance)).selectExpr("fp as a", "most as b"))
    parts = materialise(components(links), "components")
    # keys with more than two indexed fingerprints: their probes from elsewhere, and all that they index
    open_keys = found.filter("n > 2")
    rows = open_keys.filter("own = 0").select("key", "fp", "own").union(index.join(open_keys.select("key").distinct().hint("merge"), "key", "left_semi").selectExpr("key", "fp", "1 as own"))
    while True:
        named = materialise(_named(rows, parts), "keys")
        facts = named.groupBy("key").agg(
            F.count("*").alias("n"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.max("own").alias("indexed"),
            F.min(F.when(F.col("own") == 1, F.col("fp"))).alias("centre"),
            F.bit_or("fp").alias("any"),
            F.bit_and("fp").alias("all"),
        )
        facts = materialise(facts.filter("low <> high and indexed = 1").selectExpr("key", "n", "centre", "any & ~all as vary"), "key_facts")
        if not row_count(facts):
            return parts
        alive = named.join(facts, "key")
        few, many = alive.filter(F.col("n") <= pair_rows), materialise(alive.filter(F.col("n") > pair_rows), "large_keys")
        one, two = few.filter("own = 1").alias("one"), few.alias("two")
        test = F.expr(f"one.key = two.key and one.component <> two.component and {_near('one.fp', 'two.fp', distance)}")
        links = one.join(two, test).selectExpr("one.fp as a", "two.fp as b")
        links = links.union(many.filter(_near("fp", "centre", distance)).selectExpr("fp as a", "centre as b"))
        parts = materialise(components(parts.selectExpr("node as a", "component as b").union(links)), "components")
        if not row_count(many):
            return parts
        rows = _blocks(many.filter(F.bit_count("vary") > distance), distance + 1)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest doc_id reachable by links) of every document."""
    table = materialise(fingerprint_table(docs), "fingerprints")
    classes = materialise(table.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    parts = link_classes(classes, distance)
    named = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    ids = named.join(smallest, "component").select("fp", "component_id")
    return table.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
