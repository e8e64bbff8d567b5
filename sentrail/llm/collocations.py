"""Collocations by stripes: every prefix keys an associative counter of the words that follow it.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and pieces into words at blanks and
tabs. All counts are per language. A stripe of a prefix of k words holds how often each next word follows it. The stripe of
the empty prefix also has, under no word (null), the words that can't matter, so that it adds up to all words. From
the merged stripes alone come

- extensions: a counter of at least ``least`` makes prefix and next word a candidate phrase;
- prefix totals: a prefix's own counter, in the stripe of the prefix one word shorter, is how often it occurs, which both
  parts of every cut of a candidate are looked up by;
- subsumption maxima: the largest counter in a phrase's own stripe (one word more on the right), and the largest
  counter that ends stripes of phrases with one word more on the left. A phrase is no more frequent than what it
  holds, so a longer phrase that covers a candidate also shows in one of these two.

Which counters matter is found first, a word at a time: a round counts the hashes of all phrases of its length whose
first and last words the round before has left in, and keeps those that occur ``least`` times, which are also marked in a
bitmap of fixed size (``marks``) that goes to every task. With its count a task sends a number from 0 to ``GIVERS`` - 1, made
of one of the texts that it met the phrase in; the least one sent is chosen to give the phrase's words. Then one pass
gives (prefix, next word) of the phrases that are kept, out of texts of the chosen number alone, so that a phrase is sent
by a task or few and not by all that hold it, and the counts are joined to them. Marks hit by chance cost rows, which find
no count. One prefix's stripe is merged, element by element, by as many tasks as there are. Counts are exact up to
collisions of 64-bit hashes.

A null language counts as ``und``, a null text as empty; repeated rows count each; ties go by the smaller cut and by
phrase in byte order; an empty table gives an empty result. Extra columns are ignored, whatever their names. One text is
held whole in one task, at about 100 bytes a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentrail.llm.marks import collect_marks, marked
from sentrail.llm.words import Words, blocks, mix, split
from sentrail.session import materialise

LONGEST = 4
LEAST = 30
COVERED_PERCENT = 80
TOP = 2_000
SCALE = 2_000_000
#: counters that a task holds before it sends them, of hashes and of stripes
TASK_COUNTS = 2_000_000
TASK_ROWS = 1_000_000
#: numbers that texts have by what they say, one of which gives a phrase's words
GIVER_BITS = 8
GIVERS = 1 << GIVER_BITS
#: slices of a language that are ranked on their own first
SLICES = 64

#: fixed values: bytes that end a piece, and those that end a word
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_WORD_ENDS = b" \t"
_ENDS = np.array([byte in _PIECE_ENDS for byte in range(256)])
_INSIDE = np.array([byte not in _PIECE_ENDS + _WORD_ENDS for byte in range(256)])
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_NOTHING = np.uint64(0xD6E8FEB86659FD93)
NAMED = "hash long, lang string, prefix string, next string, size int, n long"


def _language(column: pa.Array) -> np.ndarray:
    coded = column.cast(pa.string()).fill_null("und").dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(lang.encode()) for lang in coded.dictionary.to_pylist()], dtype=np.uint64)
    return hashes[coded.indices.to_numpy()] if len(hashes) else np.zeros(0, dtype=np.uint64)


def _phrase_hashes(words: Words, language: np.ndarray, together: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 to ``most``: the hash of the phrase at every word, and whether one of that length is there."""
    hashes = words.hashes()
    made, there = mix(np.repeat(language, words.counts) ^ hashes), np.ones(len(hashes), dtype=bool)
    out = [(made, there)]
    for size in range(1, most):
        further = np.zeros(len(hashes), dtype=np.uint64)
        further[: len(hashes) - size] = hashes[size:]
        runs = np.zeros(len(hashes), dtype=bool)
        runs[: len(hashes) - size] = together[size - 1 : len(hashes) - 1]
        made, there = mix(made * _RADIX + further), there & runs
        out.append((made, there))
    return out


class _Text:
    """Words of a block with one blank after each, to cut phrases out of."""

    def __init__(self, words: Words):
        lengths = words.ends - words.starts
        self.last = np.cumsum(lengths + 1) - 1
        self.first = self.last - lengths
        self.bytes = np.full(int(lengths.sum()) + len(lengths), 0x20, dtype=np.uint8)
        inside = np.ones(len(self.bytes), dtype=bool)
        inside[self.last] = False
        self.bytes[inside] = words.data[np.repeat(words.starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))]

    def cut(self, start: np.ndarray, size: int) -> pa.Array:
        """Strings of ``size`` words from each start."""
        low = self.first[start]
        lengths = self.last[start + size - 1] - low if size else np.zeros(len(start), dtype=np.int64)
        ends = np.cumsum(lengths)
        taken = self.bytes[np.repeat(low - (ends - lengths), lengths) + np.arange(int(lengths.sum()))]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(taken)])


class _Held:
    """The counters of a task by hash, each with a row of what else is known of it."""

    def __init__(self, most: int) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.RecordBatch]] = []
        self.rows, self.most = 0, most

    def add(self, hashes: np.ndarray, counts: np.ndarray, facts: pa.RecordBatch) -> bool:
        """Take counters in; whether there are now too many of them to go on."""
        self.parts.append((hashes, counts, facts))
        self.rows += len(hashes)
        if self.rows > self.most:
            self.merge()
        return self.rows > self.most // 2 and len(self.parts) == 1

    def merge(self) -> None:
        hashes, first, place = np.unique(np.concatenate([part[0] for part in self.parts]), return_index=True, return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([part[1] for part in self.parts]), minlength=len(hashes)).astype(np.int64)
        facts = pa.Table.from_batches([part[2] for part in self.parts]).take(pa.array(first)).combine_chunks()
        self.parts, self.rows = [(hashes, counts, (facts.to_batches() or [self.parts[0][2].slice(0, 0)])[0])], len(hashes)

    def rows_out(self) -> pa.RecordBatch:
        self.merge()
        hashes, counts, facts = self.parts[0]
        if facts.schema.names == ["giver"]:  # beside the count, which keeps a row at two numbers
            packed = counts << GIVER_BITS | facts.column("giver").to_numpy()
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(packed)], names=["hash", "packed"])
        return pa.RecordBatch.from_arrays([*facts.columns, pa.array(counts)], names=[*facts.schema.names, "n"])


class _Block:
    """Words of a block of texts with the phrases that begin at each, by length."""

    def __init__(self, block: pa.RecordBatch, longest: int):
        self.words = split(block.column("text"), _INSIDE, lower=True)
        self.total = len(self.words.starts)
        piece = np.cumsum(_ENDS[self.words.data])[self.words.starts] if self.total else np.zeros(0, dtype=np.int64)
        self.owner = self.words.owner()
        together = (piece[1:] == piece[:-1]) & (self.owner[1:] == self.owner[:-1])
        self.phrases = _phrase_hashes(self.words, _language(block.column("lang")), together, longest)
        self.lang = block.column("lang").cast(pa.string()).fill_null("und")
        # of the text's words alone, so that it is the same whichever task reads the text
        self.giver = (mix(self.words.per_text(self.words.hashes().view(np.int64)).view(np.uint64)) % np.uint64(GIVERS)).astype(np.int64)

    def allowed(self, size: int, marks: np.ndarray) -> np.ndarray:
        """Words where a marked phrase of ``size`` words begins."""
        hashes, there = self.phrases[size - 1]
        return there & marked(marks, hashes)

    def counts(self, size: int, marks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
        """Hashes of the phrases of ``size`` words whose first and last ``size`` - 1 are marked, with their counts and a giver."""
        hashes, there = self.phrases[size - 1]
        if marks is not None:
            allowed = self.allowed(size - 1, marks)
            there = there & allowed & np.append(allowed[1:], False)
        start = np.flatnonzero(there)
        found, first, counts = np.unique(hashes[start], return_index=True, return_counts=True)
        return found, counts, pa.RecordBatch.from_arrays([pa.array(self.giver[self.owner[start[first]]])], names=["giver"])

    def named(self, longest: int, marks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
        """(hash, lang, prefix, next, size) of the marked phrases that a text here is to give, and under no hash all words of each language."""
        text, parts = _Text(self.words), []

        def part(key: np.ndarray, counts: np.ndarray, hashes: pa.Array, start: np.ndarray, prefix: pa.Array, further: pa.Array, size: int) -> None:
            rows = [hashes, self.lang.take(pa.array(self.owner[start])), prefix, further, pa.array(np.full(len(start), size, dtype=np.int32))]
            parts.append((key, counts, pa.RecordBatch.from_arrays(rows, names=["hash", "lang", "prefix", "next", "size"])))

        words, first, counts = np.unique(mix(_language(self.lang) ^ _NOTHING)[self.owner], return_index=True, return_counts=True)
        part(words, counts, pa.nulls(len(words), pa.int64()), first, text.cut(first, 0), pa.nulls(len(words), pa.string()), 1)
        for size in range(1, longest + 1):
            frequent, given = marks[size - 1]
            start = np.flatnonzero(self.allowed(size, frequent))
            hashes = self.phrases[size - 1][0][start]
            giver = self.giver[self.owner[start]].astype(np.uint64) << np.uint64(64 - GIVER_BITS)
            here = marked(given, hashes ^ giver)
            found, first = np.unique(hashes[here], return_index=True)
            start = start[here][first]
            part(mix(found + np.uint64(size)), np.zeros(len(found), dtype=np.int64), pa.array(found.view(np.int64)), start, text.cut(start, size - 1), text.cut(start + size - 1, 1), size)
        facts = pa.Table.from_batches([p[2] for p in parts]).combine_chunks().to_batches()[0]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), facts


def _per_task(docs: DataFrame, longest: int, most: int, made: object, schema: str) -> DataFrame:
    """Counters of every task, from what ``made`` finds in a block. Narrow: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(most)
        for batch in batches:
            for rows in blocks(batch, "text"):
                block = _Block(rows, longest)
                if block.total and held.add(*made(block)):
                    yield held.rows_out()
                    held = _Held(most)
        if held.parts:
            yield held.rows_out()

    return docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _frequent(docs: DataFrame, size: int, before: object, least: int) -> DataFrame:
    """(hash, n, giver) of the phrases of ``size`` words that occur ``least`` times, among those that the marks ``before`` allow. Written."""
    counts = _per_task(docs, size, TASK_COUNTS, lambda block: block.counts(size, None if before is None else before.value[0]), "hash long, packed long")
    # dealt out before they are added up: tasks have added up their own already
    giver = F.min(F.col("packed").bitwiseAND(GIVERS - 1)).alias("giver")
    whole = counts.repartition("hash").groupBy("hash").agg(F.sum(F.shiftright("packed", GIVER_BITS)).alias("n"), giver)
    return materialise(whole.filter(F.col("n") >= least), "frequent")


def _marks(frequent: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of frequent phrases, and of them with the number of the texts that give their words."""
    return collect_marks(frequent.select("hash")), collect_marks(frequent.select(F.col("hash").bitwiseXOR(F.shiftleft("giver", 64 - GIVER_BITS)).alias("hash")))


def _phrase() -> Column:
    return F.when(F.col("prefix") == "", F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next"))


def stripes(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, prefix, next, size, n): merged stripes of prefixes of up to ``longest`` - 1 words, counters of at least ``least``. Written.

    ``size`` is the number of words of prefix and next. Words below ``least`` are one counter, under null, of the empty prefix.
    """
    context = docs.sparkSession.sparkContext
    marks, counted = [], []
    for size in range(1, longest + 1):
        frequent = _frequent(docs, size, marks[-1] if marks else None, least)
        marks.append(context.broadcast(_marks(frequent)))  # of fixed size
        counted.append(frequent.select("hash", "n", F.lit(size).alias("size")))
    # read twice below
    named = materialise(_per_task(docs, longest, TASK_ROWS, lambda block: block.named(longest, [m.value for m in marks]), NAMED), "named_phrases")
    key = ["lang", "prefix", "next", "size"]
    found = named.drop("n").join(reduce(DataFrame.union, counted), ["hash", "size"]).groupBy(*key).agg(F.max("n").alias("n"))
    found = materialise(found, "frequent_phrases")
    words = found.filter("size = 1").unionByName(named.filter("hash is null").select(*key, "n"))
    held = F.sum(F.when(F.col("next").isNull(), F.col("n")).otherwise(-F.col("n")))
    rest = words.groupBy("lang").agg(held.alias("n")).filter("n > 0")
    rest = rest.select("lang", F.lit("").alias("prefix"), F.lit(None).cast("string").alias("next"), F.lit(1).alias("size"), "n")
    return materialise(found.unionByName(rest), "stripes")


def scored(table: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer phrase covers, from merged stripes."""
    counted = table.filter("next is not null").select("lang", "size", _phrase().alias("phrase"), "prefix", F.col("n").alias("a"))
    entries = counted.filter("size > 1")
    totals = materialise(counted.select("lang", "phrase", F.col("a").alias("total")), "prefix_totals")
    # the most frequent extension of a phrase to the right, in its own stripe, and to the left
    own = entries.filter("size > 2").groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("a").alias("right"))
    to_left = entries.filter("size > 2").groupBy("lang", F.expr("substring(phrase, locate(' ', phrase) + 1)").alias("phrase")).agg(F.max("a").alias("left"))
    longer = materialise(own.join(to_left, ["lang", "phrase"], "full").select("lang", "phrase", F.greatest("right", "left").alias("longer")), "longer_phrases")
    wide = "decimal(38, 0)"
    kept = entries.join(longer, ["lang", "phrase"], "left")
    kept = kept.filter(f"longer is null or 100 * cast(longer as {wide}) < {covered_percent} * cast(a as {wide})")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    for part, name in (("first", "l"), ("rest", "r")):
        renamed = totals.select("lang", F.col("phrase").alias(part), F.col("total").alias(name))
        cuts = cuts.join(renamed, ["lang", part])
    cuts = cuts.withColumn("score", F.expr(f"cast(({SCALE} * cast(a as {wide})) div (cast(l as decimal(20, 0)) + r) as long)"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases by score, occurrences and phrase."""
    table = stripes(docs, longest, least)
    totals = table.filter("size = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # a language may hold most phrases: slices of it are cut to their own top before they meet
    sliced = scored(table).withColumn("_slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    sliced = sliced.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))).filter(F.col("_rank") <= top)
    ranked = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
