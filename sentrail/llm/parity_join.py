"""Exact near-duplicate join on word-shingle sets, by parity sketches and the pigeonhole principle.

A document's set is that of its distinct shingles; two documents link when 100 * |A and B| >= similarity *
|A or B|. A shingle toggles one bit of a sketch, so the Hamming distance of two sketches never exceeds the
symmetric difference of the sets. Two linked sets of at most n shingles differ in at most d(n) of them. Sizes
are cut into bands; for each band, with n its upper end, a sketch has more than d(n) segments of
``SEGMENT_BITS`` bits, and linked documents agree on a whole segment, among any d(n) + 1 chosen by one side.

1. Documents with equal sets form a class, named by 64 bits of the set's hash; only classes are compared.
2. Each class has a key per segment for its own band, and for the next one where a larger partner may be there.
   Keys are counted over all classes, by their first 48 bits, sorted and packed by ranges of them; a class that one row
   has goes without its name. Keys that two classes hold are marked in a bitmap (``marks``),
   and those of ``CROWDED`` classes in another. A class can have a partner in a band only if as many of its segments
   there are marked as it must share with the largest set that it can link with; all others send nothing more.
3. A class that may have one sends its marked keys, with d(n) + 1 segments of its own band as probes, n its own size, as the
   larger one of a pair probes for both: those without
   a mark first, which cost nothing, then the marked, the crowded last. Keys with two classes and a probe survive.
4. Of keys with up to ``FEW`` classes all pairs are checked. Classes of a larger key are first checked against
   ``CENTRES`` of them; confirmed links are joined into components,
   and keys whose classes share one component are done. This is repeated with other centres, and at
   last the remaining pairs of different components under a key are checked. A group of copies costs a few
   checks each, not one per pair.
5. A check compares sizes and a short sketch of both sets (512 bits), then the shingle sets themselves: of the
   classes in a round's pairs, and of no others, one text each is taken from the documents.

The result is exact up to 64-bit hash collisions, and the same for any partitioning: nothing is capped. Null
and empty texts have an empty set and link with nothing; a short text is one shingle; repeated rows share a
class; a null doc_id is ignored by components (its component is its class's smallest id). Extra columns are
ignored by ``near_duplicates`` and kept by ``keep_one``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrail.llm.arrow import add_columns, longs, small_batches
from sentrail.llm.components import components
from sentrail.llm.marks import MARK_BITS, collect_marks, marked
from sentrail.llm.words import BY_SPACE, blocks, mix, split, windows
from sentrail.session import materialise, row_count

SHINGLE = 4
SIMILARITY = 85
BAND = 1.5
SEGMENT_BITS = 4096
SHORT_LONGS = 8
#: classes of a key whose pairs are checked one by one
FEW = 8
#: centres of a larger key in a round, and rounds before the pairs that are left are checked
CENTRES = 4
ROUNDS = 2
#: classes of a key from which it is probed last
CROWDED = 32
#: shingles up to which a band's sets are all taken to be as large as it allows
SMALL = 64
#: keys that a task packs at a time, and that a range of keys has at most on average; bits that number the least ranges
PACKED_KEYS, RANGE_KEYS, RANGE_BITS = 1_000_000, 4_000_000, 8
#: bits of the bitmap of shared keys for each of them, and at most in all (as a power of two)
KEY_MARKS, MOST_MARK_BITS = 16, 28

_ZOBRIST = mix(np.arange(1, SEGMENT_BITS + 1, dtype=np.uint64))
_RADIX = np.uint64(0x9E3779B97F4A7C15)
#: largest set size of each band
UPPER = np.unique(np.floor(BAND ** np.arange(1, 90)).astype(np.int64))


def differences(size: np.ndarray | int, similarity: int) -> np.ndarray | int:
    """Most shingles that two linked sets of at most ``size`` shingles can differ in."""
    return (2 * size * (100 - similarity)) // (100 + similarity)


def most_apart(size: np.ndarray, top: np.ndarray, similarity: int) -> np.ndarray:
    """Most shingles that a set of ``size`` shingles and one that it links with, of at most ``top``, can differ in. For small
    sets, which have few keys, that of two sets of ``top``."""
    apart = (size + np.minimum(100 * size // similarity, top)) * (100 - similarity) // (100 + similarity)
    return np.where(top < SMALL, differences(top, similarity), apart)


def segments(similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every band: the number of segments of its sketches, and how many of them a probe chooses."""
    probes = differences(UPPER, similarity) + 1
    return np.where(probes > 1, probes + probes // 8 + 1, 1), probes


@dataclass
class Sets:
    """Sorted distinct shingle hashes of a block's texts, end to end; text k has those from of[k] to of[k + 1]."""

    shingles: np.ndarray
    of: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.of)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.sizes)

    def take(self, rows: np.ndarray) -> Sets:
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        places = np.arange(int(sizes.sum())) + np.repeat(self.of[:-1][rows] - (ends - sizes), sizes)
        return Sets(self.shingles[places], np.concatenate([[0], ends]))

    def classes(self) -> np.ndarray:
        """62 bits of each set's hash and one that is always set; 0 for an empty set."""
        total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(self.shingles), dtype=np.uint64)])
        summed = mix(total[self.of[1:]] - total[self.of[:-1]] + self.sizes.astype(np.uint64))
        return np.where(self.sizes > 0, (summed >> np.uint64(2) | np.uint64(1 << 61)).view(np.int64), 0)

    def short_sketches(self) -> np.ndarray:
        """One row of SHORT_LONGS 64-bit words for each text: the parity of its shingles by bit."""
        bits = 64 * SHORT_LONGS
        place = self.owner() * bits + (mix(self.shingles) >> np.uint64(7)).astype(np.int64) % bits
        odd = (np.bincount(place, minlength=len(self.sizes) * bits) & 1).astype(np.uint8)
        return np.packbits(odd).view(np.int64).reshape(-1, SHORT_LONGS)


def shingle_sets(column: pa.Array, shingle: int) -> Sets:
    words = split(column, BY_SPACE, lower=True)
    hashes, counts = words.hashes(), words.counts
    made, first = windows(hashes, words.of, shingle)
    per_text = np.maximum(counts - shingle + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    sizes = per_text.copy()
    sizes[short] = 1
    of = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.empty(int(of[-1]), dtype=np.uint64)
    whole = np.ones(len(flat), dtype=bool)
    whole[of[:-1][short]] = False
    flat[whole] = made
    for text in short.tolist():  # a short text is one shingle, told from others by its number of words
        one = np.full(1, counts[text], dtype=np.uint64)
        for word in range(words.of[text], words.of[text + 1]):
            one = mix(one * _RADIX + hashes[word])
        flat[of[text]] = one[0]
    for low, high in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        flat[low:high].sort()
    new = np.ones(len(flat), dtype=bool)
    new[1:] = flat[1:] != flat[:-1]
    new[of[:-1][sizes > 0]] = True
    return Sets(flat[new], np.concatenate([[0], np.cumsum(new)])[of])


def segment_keys(sets: Sets, bands: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of every segment of the sets' sketches for the given bands.

    A key is the exclusive or of the numbers of the segment's odd bits, so equal segments have equal keys.
    """
    count = segments(similarity)[0][bands]
    base = np.cumsum(count) - count
    owner = sets.owner()
    spread = mix(sets.shingles ^ np.uint64(0x5851F42D4C957F2D))
    segment = base[owner] + ((spread >> np.uint64(32)) % count[owner].astype(np.uint64)).astype(np.int64)
    bit = _ZOBRIST[(spread & np.uint64(SEGMENT_BITS - 1)).astype(np.int64)]
    order = np.argsort(segment, kind="stable")
    total = int(count.sum())
    parity = np.zeros(total, dtype=np.uint64)
    filled = np.flatnonzero(np.concatenate([[True], segment[order][1:] != segment[order][:-1]])) if len(order) else np.zeros(0, dtype=np.int64)
    if len(filled):
        parity[segment[order][filled]] = np.bitwise_xor.reduceat(bit[order], filled)
    text = np.repeat(np.arange(len(count)), count)
    number = np.arange(total) - base[text]
    return text, mix(parity ^ mix((number + (bands[text] << 40)).astype(np.uint64)))


def probes(text: np.ndarray, cost: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each text, its ``wanted`` segments of least cost."""
    order = np.lexsort((cost, text))
    first = np.searchsorted(text[order], np.arange(len(wanted)))
    out = np.zeros(len(text), dtype=bool)
    out[order] = np.arange(len(text)) - first[text[order]] < wanted[text[order]]
    return out


def class_table(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, class and short sketch (h0, h1, ...) of every document. Lazy, no shuffle."""
    names = ["doc_id", "n_shingles", "class", *[f"h{k}" for k in range(SHORT_LONGS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                sets = shingle_sets(block.column("text"), shingle)
                sketch = sets.short_sketches()
                columns = [pa.array(sets.sizes), pa.array(sets.classes()), *[pa.array(sketch[:, k]) for k in range(SHORT_LONGS)]]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *columns], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _keyed(batches: Iterator[pa.RecordBatch], shingle: int, similarity: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each block of texts, of the classes that the task has not met: names, sizes and bands, (text, key) of their
    own bands' segments, which of them may have a larger partner in the next band, and (text, key) of those there."""
    seen: set[int] = set()
    for batch in batches:
        for block in blocks(batch, "text"):
            sets = shingle_sets(block.column("text"), shingle)
            named = sets.classes()
            new = [row for row, name in enumerate(named.tolist()) if name and not (name in seen or seen.add(name))]
            sets, named = sets.take(np.array(new, dtype=np.int64)), named[new]
            bands = np.searchsorted(UPPER, sets.sizes)
            # a larger partner, in the next band, has at most 100 / similarity times the shingles
            up = np.flatnonzero(sets.sizes * 100 >= similarity * (UPPER[bands] + 1))
            yield named, sets.sizes, bands, *segment_keys(sets, bands, similarity), up, *segment_keys(sets.take(up), bands[up] + 1, similarity)


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest five bytes of sorted numbers, the highest of them all first, where they hardly change."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 4::-1].T.tobytes()


def _from_planes(packed: Sequence[bytes]) -> np.ndarray:
    parts = [np.frombuffer(part, dtype=np.uint8).reshape(5, -1) for part in packed]
    out = np.zeros((sum(part.shape[1] for part in parts), 8), dtype=np.uint8)
    out[:, 4::-1] = np.concatenate([np.zeros((5, 0), dtype=np.uint8), *parts], axis=1).T
    return out.view("<u8")[:, 0]


def _first_of_each(ordered: np.ndarray, most: int) -> np.ndarray:
    """Which of sorted numbers are among the first ``most`` of equal ones."""
    return np.arange(len(ordered)) - np.searchsorted(ordered, ordered) < most


def packed_keys(docs: DataFrame, repeated: np.ndarray, bits: int, shingle: int, similarity: int) -> DataFrame:
    """(part, alone, several, names): the first 48 bits of all keys, those of a task that agree in the first ``bits`` packed
    in a row. ``repeated`` marks the classes of several rows: only their keys go with their names, as any other class is
    sent once. Of a key that a task has often, ``CROWDED`` go. Lazy, no shuffle."""
    marks = docs.sparkSession.sparkContext.broadcast(repeated)
    low = np.uint64((1 << 40) - 1)

    def packed(held: list[np.ndarray], of: list[np.ndarray], of_names: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        alone, several, names = (np.concatenate(side) for side in (held, of, of_names))
        order = np.argsort(several, kind="stable")
        alone, several, names = np.sort(alone), several[order], names[order]
        alone, stay = alone[_first_of_each(alone, CROWDED)], _first_of_each(several, CROWDED)
        several, names = several[stay], names[stay]
        starts = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(48 - bits)
        one, two = (np.searchsorted(side, starts).tolist() for side in (alone, several))
        rows = [part for part in range(1 << bits) if one[part] < one[part + 1] or two[part] < two[part + 1]]
        columns = [
            pa.array(rows, pa.int32()),
            pa.array([_planes(alone[one[part] : one[part + 1]] & low) for part in rows], pa.binary()),
            pa.array([_planes(several[two[part] : two[part + 1]] & low) for part in rows], pa.binary()),
            pa.array([names[two[part] : two[part + 1]].tobytes() for part in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "alone", "several", "names"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list[np.ndarray], ...] = ([], [], [])
        size = 0
        for named, _, _, text, key, up, above, key_above in _keyed(batches, shingle, similarity):
            names, found = np.concatenate([named[text], named[up][above]]), np.concatenate([key, key_above]) >> np.uint64(16)
            known = marked(marks.value, names.view(np.uint64) << np.uint64(3))
            for side, some in zip(sides, (found[~known], found[known], names[known]), strict=True):
                side.append(some)
            size += len(found)
            if size >= PACKED_KEYS:
                yield from packed(*sides)
                sides, size = ([], [], []), 0
        if size:
            yield from packed(*sides)

    return docs.select("text").mapInArrow(run, "part int, alone binary, several binary, names binary")


def shared_keys(docs: DataFrame, repeated: np.ndarray, keys: int, shingle: int, similarity: int) -> DataFrame:
    """(key, n) of the keys that ``n`` > 1 classes hold, by their first 48 bits; the others are 0.

    There are about ``keys`` keys in all, counted range by range. Beyond ``CROWDED``, ``n`` may be less than there are.
    """
    bits = min(16, max(RANGE_BITS, (keys // RANGE_KEYS).bit_length()))

    def count(table: pa.Table) -> pa.Table:
        part = np.uint64(table["part"][0].as_py()) << np.uint64(48 - bits)
        several = np.stack([_from_planes(table["several"].to_pylist()), np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in table["names"].to_pylist()])])
        several = several[:, np.lexsort(several[::-1])]
        new = np.ones(several.shape[1], dtype=bool)
        new[1:] = (several[:, 1:] != several[:, :-1]).any(axis=0)
        found = np.sort(np.concatenate([_from_planes(table["alone"].to_pylist()), several[0, new]]))
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        n = np.diff(np.concatenate([first, [len(found)]]))
        key = (found[first[n > 1]] | part) << np.uint64(16)
        return pa.table([pa.array(key.view(np.int64)), pa.array(n[n > 1])], names=["key", "n"])

    return packed_keys(docs, repeated, bits, shingle, similarity).groupBy("part").applyInArrow(count, "key long, n long")


def key_table(docs: DataFrame, shingle: int, similarity: int, marks: object) -> DataFrame:
    """(key, marked: class and, in the lowest bit, probe) of every class, sent once per task however many copies of it the task holds.

    ``marks`` is a broadcast pair of bitmaps: only marked keys go, of classes that may have a partner in their band.
    """
    total, _ = segments(similarity)

    def needed(text: np.ndarray, key: np.ndarray, bands: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys to send, and the cost of each as a probe: 0 without a mark, 1 with one, 2 where crowded."""
        shared, crowded = (marked(bitmap, key) for bitmap in marks.value)
        # segments that linked sets must share: each shingle that they differ in spoils one
        may = np.bincount(text, weights=shared, minlength=len(bands)) >= total[bands] - most_apart(sizes, UPPER[bands], similarity)
        return shared & may[text], shared.astype(np.int64) + (shared & crowded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for named, sizes, bands, text, key, up, above, key_above in _keyed(batches, shingle, similarity):
            sent, cost = needed(text, key, bands, sizes)
            sent_above, _ = needed(above, key_above, bands[up] + 1, sizes[up])
            # the mark is the lowest bit beside the class, which keeps a row at two numbers; the larger of two sets probes
            wanted = most_apart(sizes, np.where(UPPER[bands] < SMALL, UPPER[bands], sizes), similarity) + 1
            own = (named[text] << 1 | probes(text, cost, wanted))[sent]
            keys = np.concatenate([key[sent], key_above[sent_above]]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([own, (named[up][above] << 1)[sent_above]]))], names=["key", "marked"])

    return docs.select("text").mapInArrow(run, "key long, marked long")


def _survivors(docs: DataFrame, classes: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """(key, class, probe, n) of the keys held by ``n`` > 1 classes of which one is a probe.

    One shuffle of all keys, packed, counts them; what they leave is sent again, and that alone is joined.
    """
    spark = docs.sparkSession
    repeated = collect_marks(classes.filter("n_rows > 1").select(F.shiftleft("class", 3).alias("hash")))
    # a class has one bit that is always set, which marks no place; a set has keys for about two fifths of its shingles
    shingles = classes.agg(F.sum("n_shingles")).first()[0] or 0
    shared = materialise(shared_keys(docs, repeated, 2 * shingles // 5, shingle, similarity), "shared_keys")
    bits = min(MOST_MARK_BITS, max(MARK_BITS, (KEY_MARKS * row_count(shared)).bit_length()))
    marks = spark.sparkContext.broadcast((collect_marks(shared.selectExpr("key as hash"), bits), collect_marks(shared.filter(F.col("n") >= CROWDED).selectExpr("key as hash"))))
    sent = key_table(docs, shingle, similarity, marks).withColumn("short", F.expr("key & -65536L"))
    sent = sent.join(shared.selectExpr("key as short").hint("merge"), "short").select("key", F.shiftrightunsigned("marked", 1).alias("class"), F.col("marked").bitwiseAND(1).alias("probe"))
    sent = materialise(sent.groupBy("key", "class").agg(F.max("probe").alias("probe")), "sent_keys")
    held = sent.groupBy("key").agg(F.count("*").alias("n"), F.max("probe").alias("probed"))
    return sent.join(held.filter("n > 1 and probed = 1").select("key", "n"), "key")


def _jaccard(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Of (x, y) class pairs, those whose sets link. Each side's text is joined in turn; sets are made in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (0, np.zeros(0, dtype=np.uint64))
        for batch in batches:
            for block in blocks(batch, "text"):
                xs, others = block.column("x").to_pylist(), shingle_sets(block.column("text"), shingle)
                keep = []
                for row, x in enumerate(xs):
                    if last[0] != x:  # rows come in the order of x
                        last = (x, shingle_sets(block.column("text_x").slice(row, 1), shingle).shingles)
                    other = others.shingles[others.of[row] : others.of[row + 1]]
                    common = len(np.intersect1d(last[1], other, assume_unique=True))
                    if 100 * common >= similarity * (len(last[1]) + len(other) - common):
                        keep.append(row)
                yield block.select(["x", "y"]).take(pa.array(keep, pa.int64()))

    of_y = pairs.join(texts.withColumnRenamed("class", "y"), "y")
    of_x = texts.select(F.col("class").alias("x"), F.col("text").alias("text_x"))
    return of_y.join(of_x, "x").select("x", "y", "text", "text_x").mapInArrow(run, "x long, y long")


def _near(one: str, two: str, similarity: int) -> Column:
    """Sizes and short sketches allow a link: the sketches' Hamming distance is at most the symmetric difference."""
    distance = " + ".join(f"bit_count({one}.h{k} ^ {two}.h{k})" for k in range(SHORT_LONGS))
    sizes = f"100 * least({one}.n_shingles, {two}.n_shingles) >= {similarity} * greatest({one}.n_shingles, {two}.n_shingles)"
    return F.expr(f"{sizes} and {100 + similarity} * ({distance}) <= {100 - similarity} * ({one}.n_shingles + {two}.n_shingles)")


_PAIR = ("least(one.class, two.class) as x", "greatest(one.class, two.class) as y")


def _texts(docs: DataFrame, pairs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """One text of every class of ``pairs``. Only rows whose id stands for such a class leave their task."""
    wanted = pairs.selectExpr("explode(array(x, y)) as class").distinct()
    holders = materialise(classes.join(wanted, "class").select("class", "class_id"), "holders")
    marks = docs.sparkSession.sparkContext.broadcast(collect_marks(holders.filter("class_id is not null").select(F.xxhash64("class_id").alias("hash"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("class_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            hit = marked(marks.value, batch.column("hash").to_numpy().view(np.uint64))
            for block in blocks(batch.select(["text"]).filter(pa.array(hit)), "text"):
                # an id may stand for different texts, and repeat: the class tells which are wanted, once a task
                named = shingle_sets(block.column("text"), shingle).classes()
                new = pa.array([row for row, name in enumerate(named.tolist()) if name and not (name in seen or seen.add(name))], pa.int64())
                yield pa.RecordBatch.from_arrays([block.column("text").take(new), pa.array(named).take(new)], names=["text", "class"])

    named = rows.filter("class_id is not null").select("text", F.xxhash64("class_id").alias("hash"))
    found = named.mapInArrow(run, "text string, class long").join(holders.select("class"), "class", "left_semi")
    # classes that no id stands for are found by their texts
    nameless = add_columns(rows.filter("class_id is null").select("text"), longs("class"), lambda block: [shingle_sets(block.column("text"), shingle).classes()])
    nameless = nameless.join(holders.filter("class_id is null").select("class"), "class", "left_semi")
    # each side has one exchange, by class, which its own join and the choice share
    return materialise(found.dropDuplicates(["class"]).unionByName(nameless.dropDuplicates(["class"])).select("class", "text"), "texts")


def _centred(alive: DataFrame, turn: int, similarity: int) -> DataFrame:
    """Near pairs of each key's centres, its least classes in orders that change each round, with classes of other components."""
    ranks = [F.col("class") if number == 0 else F.xxhash64("class", F.lit(number)) for number in range(turn * CENTRES, (turn + 1) * CENTRES)]
    facts = [name for name in alive.columns if name not in ("key", "probe", "class_id", "n")]
    chosen = alive.groupBy("key").agg(*[F.min(F.struct(rank.alias("rank"), *facts)).alias(f"c{k}") for k, rank in enumerate(ranks)])
    centres = chosen.select("key", F.explode(F.array_distinct(F.array(*[F.col(f"c{k}").dropFields("rank") for k in range(CENTRES)]))).alias("c")).select("key", "c.*")
    joined = alive.alias("one").join(centres.alias("two"), "key").filter("one.component <> two.component").filter(_near("one", "two", similarity))
    return joined.selectExpr(*_PAIR).distinct()


def _all_pairs(alive: DataFrame, similarity: int) -> DataFrame:
    """Near pairs under a key that different components and a probe hold."""
    test = F.expr("one.key = two.key and one.component < two.component and one.probe + two.probe > 0")
    return alive.alias("one").join(alive.alias("two"), test & _near("one", "two", similarity)).selectExpr(*_PAIR).distinct()


def _unsettled(alive: DataFrame, parts: DataFrame) -> DataFrame:
    """Keys that still hold a probe and two components, with components as they now are."""
    named = alive.drop("component").join(parts.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    facts = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("probe").alias("probed"))
    return materialise(named.join(facts.filter("low <> high and probed = 1").select("key"), "key"), "keys")


def link_classes(docs: DataFrame, classes: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """(node, component) of every class that links with another."""
    alive = materialise(_survivors(docs, classes, shingle, similarity).join(classes.drop("n_rows"), "class").withColumn("component", F.col("class")), "keys")
    tested = docs.sparkSession.createDataFrame([], "x long, y long")
    parts = docs.sparkSession.createDataFrame([], "node long, component long")
    # keys of few classes are done at once, those of many by centres first
    few, alive = alive.filter(F.col("n") <= FEW), alive.filter(F.col("n") > FEW)
    turn = 0
    while True:
        pairs = _all_pairs(alive, similarity) if turn == ROUNDS else _centred(alive, turn, similarity)
        pairs = pairs.union(_all_pairs(few, similarity)).distinct() if turn == 0 else pairs
        pairs = materialise(pairs.join(tested, ["x", "y"], "left_anti"), "pairs")
        if row_count(pairs):
            texts = _texts(docs, pairs, classes, shingle)
            found = materialise(_jaccard(pairs, texts, shingle, similarity), "found")
            tested = tested.union(pairs)
            if row_count(found):
                parts = materialise(components(parts.toDF("a", "b").union(found.toDF("a", "b"))), "components")
        if turn == ROUNDS:
            return parts
        alive = _unsettled(alive, parts)
        if not row_count(alive):
            return parts
        turn += 1


def _component_table(docs: DataFrame, shingle: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """``class_table`` of the documents, and each class's smallest id (class_id) with its component's smallest (id, class) as ``kept``. Written."""
    with small_batches(docs.sparkSession):
        table = materialise(class_table(docs, shingle), "classes")
        facts = [F.min(name).alias(name) for name in table.columns if name not in ("class", "doc_id")]
        classes = materialise(table.filter("class <> 0").groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_rows"), *facts), "class_facts")
        parts = link_classes(docs, classes, shingle, similarity)
    named = classes.select("class", "class_id").join(parts.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    # a class without an id represents its component only where no class has one
    first = F.min(F.struct(F.col("class_id").isNull().alias("no_id"), F.col("class_id").alias("doc_id"), "class")).alias("kept")
    return table, materialise(named.join(named.groupBy("component").agg(first), "component").select("class", "class_id", "kept"), "class_components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with the same set) and component_id of every document."""
    table, ids = _component_table(docs, shingle, similarity)
    return table.join(ids, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("kept.doc_id", "class_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component: of the smallest id, and of its texts the one with the smallest class.

    An id that stands for several texts counts for each of them: only the texts with a partner go. Of rows that are
    equal in id and set one stays, and one of a component without any id. Rows without words all stay.
    """
    table, ids = _component_table(docs, shingle, similarity)
    held = table.groupBy("doc_id", "class").agg(F.count("*").alias("n"))
    stays = F.col("kept.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("kept.class") == F.col("class"))
    judged = held.join(ids, "class", "left").select("doc_id", "class", "n", ((F.col("class") == 0) | stays).alias("stays"))
    # ids whose rows don't all stay; the rows of those that keep some are told apart by their texts
    sure = F.min(F.col("stays") & ((F.col("n") == 1) | (F.col("class") == 0)))
    by_id = judged.filter("doc_id is not null").groupBy("doc_id").agg(sure.alias("sure"), F.max("stays").alias("some"))
    open_ids = materialise(by_id.filter("not sure"), "open_ids")
    whole = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    clear = whole.filter("doc_id is not null").join(open_ids, "doc_id", "left_anti").select("_doc.*")
    mixed = whole.join(open_ids.filter("some").select("doc_id"), "doc_id", "left_semi").unionByName(whole.filter("doc_id is null"))
    mixed = add_columns(mixed, longs("class"), lambda block: [shingle_sets(block.column("text"), shingle).classes()]).drop("text")
    best = materialise(judged.filter("stays and class <> 0").select(F.col("doc_id").alias("kept_id"), "class").distinct(), "kept_texts")
    chosen = mixed.alias("m").join(best.alias("b"), F.expr("m.class = b.class and m.doc_id <=> b.kept_id")).select("m.*")
    chosen = chosen.groupBy("doc_id", "class").agg(F.first("_doc").alias("_doc")).select("_doc.*")
    return clear.unionByName(chosen).unionByName(mixed.filter("class = 0").select("_doc.*"))
