"""Benchmark decontamination by suffix arrays of the training texts.

The texts of a block, as numbers of benchmark words, form one shard. Its suffix array holds every suffix that
can start a match: one whose first two words stand in that order somewhere in the benchmark, or whose first
word is a whole item (for longest matches, every suffix that begins with a benchmark word). Every suffix of every benchmark item is binary-searched in every shard. That gives its
longest verbatim match, and at the depth of its window (13 words, or the whole item where that has fewer) all
places where the window occurs. Words inside an occurrence are hit.

The benchmark is the stated query set. It is read in blocks of at most ``BENCHMARK_BYTES`` of text, and each
document batch passes all blocks in turn, carrying its hits; documents never move, whatever holds them.
Equality of words is that of 64-bit hashes of their lower-cased bytes.

Null and empty texts have no words and are never contaminated. Items without words are ignored. Repeated
items are all named; repeated documents are judged each; an empty benchmark hits nothing. Extra columns stay,
except those named like a result, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.llm.arrow import add_columns, carried, restored
from sentrail.llm.words import ALNUM, blocks, covered, split

WINDOW = 13
BENCHMARK_BYTES = 16 << 20


@dataclass
class Items:
    """A block of benchmark items as word numbers; ``vocabulary`` is sorted, a word's number is its place there."""

    ids: list[str]
    vocabulary: np.ndarray
    words: np.ndarray  # numbers, items end to end
    ends: np.ndarray  # for each word, where its item ends
    item: np.ndarray  # for each word, its item
    depth: np.ndarray  # for each word, the length of the window that starts there, 0 for none
    pairs: np.ndarray  # sorted numbers of neighbouring word pairs
    singles: np.ndarray  # words that are whole items


def read_items(ids: list, texts: list[str], window: int = WINDOW) -> Items:
    words = split(pa.array(texts, pa.string()), ALNUM, lower=True)
    vocabulary, numbers = np.unique(words.hashes(), return_inverse=True)
    owner = words.owner()
    ends, counts = words.of[1:][owner], words.counts[owner]
    place = np.arange(len(numbers)) - words.of[:-1][owner]
    depth = np.where(counts < window, np.where(place == 0, counts, 0), np.where(ends - np.arange(len(numbers)) >= window, window, 0))
    follows = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = np.unique(numbers[follows] * (len(vocabulary) + 1) + numbers[follows + 1])
    return Items([str(i) for i in ids], vocabulary, numbers, ends, owner, depth, pairs, np.unique(numbers[counts == 1]))


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), dtype=bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def suffix_array(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``starts`` in the order of the suffixes of ``words`` that begin there, which end at the first negative word.

    Words are refined round by round: suffixes still tied after k words are ordered by their next word. Only tied
    ones are looked at again, so the work follows the length of what the suffixes share.
    """
    order = starts[np.argsort(words[starts], kind="stable")]
    group = np.concatenate([[0], np.cumsum(words[order][1:] != words[order][:-1])]) if len(order) else np.zeros(0, int)
    depth, places = 1, np.arange(len(order))
    while len(places):
        size = np.bincount(group)
        tied = (size[group] > 1) & (words[np.minimum(order[places] + depth - 1, len(words) - 1)] >= 0)
        places, group = places[tied], group[tied]
        if not len(places):
            break
        following = order[places] + depth
        word = np.where(following < len(words), words[np.minimum(following, len(words) - 1)], -1)
        again = np.lexsort((word, group))
        order[places] = order[places][again]
        word, old = word[again], group[again]
        group = np.concatenate([[0], np.cumsum((word[1:] != word[:-1]) | (old[1:] != old[:-1]))])
        depth += 1
    return order


def _narrow(words: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray, right: bool) -> np.ndarray:
    """Binary search, for all queries at once, of ``wanted`` as the word at ``depth`` of the suffixes low..high."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        at = order[middle] + depth
        word = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], -1)
        go = word <= wanted[open_] if right else word < wanted[open_]
        low[open_[go]] = middle[go] + 1
        high[open_[~go]] = middle[~go]


def search(words: np.ndarray, order: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each item suffix: length of its longest match, the range of ``order`` with that match, and first and last of its window's."""
    count = len(items.words)
    longest = np.zeros(count, dtype=np.int64)
    reach = np.zeros((count, 2), dtype=np.int64)
    first, last = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
    query, low, high, depth = np.arange(count), np.zeros(count, dtype=np.int64), np.full(count, len(order)), 0
    while len(query):
        at_window = items.depth[query] == depth
        if depth:
            first[query[at_window]], last[query[at_window]] = low[at_window], high[at_window]
        going = query + depth < items.ends[query]
        query, low, high = query[going], low[going], high[going]
        wanted = items.words[query + depth]
        left = _narrow(words, order, low, high, depth, wanted, right=False)
        right = _narrow(words, order, left, high, depth, wanted, right=True)
        some = left < right
        query, low, high = query[some], left[some], right[some]
        depth += 1
        longest[query] = depth
        reach[query, 0], reach[query, 1] = low, high
    return longest, reach, first, last


def _shard(block: pa.RecordBatch, items: Items, every: bool = False) -> tuple:
    """The block's words as benchmark numbers (negative elsewhere and after each text), and its suffix array.

    ``every`` takes all suffixes that begin with a benchmark word, for matches of a single word too."""
    found = split(block.column("text"), ALNUM, lower=True)
    hashes = found.hashes()
    owner = found.owner()
    # one negative word after each text ends its suffixes
    place = np.arange(len(hashes)) + owner
    words = np.full(len(hashes) + block.num_rows, -1, dtype=np.int64)
    number = np.searchsorted(items.vocabulary, hashes)
    known = items.vocabulary[np.minimum(number, len(items.vocabulary) - 1)] == hashes
    words[place[known]] = number[known]
    pair = words[:-1] * (len(items.vocabulary) + 1) + words[1:]
    candidate = words >= 0
    if not every:
        candidate &= _member(words, items.singles) | np.append((words[1:] >= 0) & _member(pair, items.pairs), False)
    return found, words, place, suffix_array(words, np.flatnonzero(candidate))


def _occurrences(order: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place in the ranges first..last of ``order``, with the number of its range."""
    sizes = last - first
    which = np.repeat(np.arange(len(sizes)), sizes)
    return order[np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[which]], which


_HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.LongType())),  # first word and end of every hit stretch
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _lists(values: list, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))


def _match_block(block: pa.RecordBatch, items: Items) -> list:
    found, words, place, order = _shard(block, items)
    rows = block.num_rows
    _, _, first, last = search(words, order, items)
    wanted = np.flatnonzero(last > first)
    at, which = _occurrences(order, first[wanted], last[wanted])
    query = wanted[which]
    mark = covered(at, items.depth[query], len(words))
    hit = mark[place] if len(place) else np.zeros(0, dtype=bool)
    starts = found.of[:-1] + np.arange(rows)  # where each text begins in ``words``
    text = np.searchsorted(starts, at, "right") - 1
    named = np.unique(text * len(items.ids) + items.item[query])
    inside = np.concatenate([[False], hit, [False]])
    owner = found.owner()
    cut = np.zeros(len(hit) + 1, dtype=bool)
    cut[found.of[:-1]] = True
    begin = np.flatnonzero(hit & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(hit & (~inside[2:] | cut[1:])) + 1
    at_text = owner[begin] if len(begin) else np.zeros(0, dtype=np.int64)
    stretches = np.column_stack([begin, end]) - found.of[:-1][at_text][:, None]
    return [
        found.counts,
        _lists(stretches.ravel().tolist(), 2 * np.bincount(at_text, minlength=rows), pa.int64()),
        _lists([items.ids[k] for k in (named % len(items.ids)).tolist()], np.bincount(named // len(items.ids), minlength=rows), pa.string()),
    ]


def _merged(old: list[int], new: list[int]) -> list[int]:
    """Two lists of stretches as one of disjoint stretches."""
    out: list[int] = []
    for begin, end in sorted([*zip(old[::2], old[1::2], strict=True), *zip(new[::2], new[1::2], strict=True)]):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def item_blocks(benchmark: DataFrame, window: int, most: int) -> Iterator[Items]:
    """The benchmark in blocks of at most ``most`` bytes (one item where that is longer), read one partition at a time."""
    ids, texts, total = [], [], 0
    for row in benchmark.select("item_id", "text").filter("text is not null").toLocalIterator():
        size = len(row["text"].encode())
        if texts and total + size > most:
            yield read_items(ids, texts, window)
            ids, texts, total = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        total += size
    if texts:
        yield read_items(ids, texts, window)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = BENCHMARK_BYTES) -> DataFrame:
    """``docs`` with n_words, hits (stretches of words) and items (that have occurring windows). Lazy, no shuffle."""
    out = None
    for items in item_blocks(benchmark, window, most):
        if not len(items.words):
            continue
        sent = docs.sparkSession.sparkContext.broadcast(items)  # at most ``most`` bytes of text

        def compute(block: pa.RecordBatch, sent=sent, carried=out is not None) -> list:
            made = _match_block(block, sent.value)
            if not carried:
                return made
            before = [block.column(name).to_pylist() for name in ("_hits", "_items")]
            hits = [_merged(a, b) for a, b in zip(before[0], made[1].to_pylist(), strict=True)]
            named = [sorted({*a, *b}) for a, b in zip(before[1], made[2].to_pylist(), strict=True)]
            return [made[0], pa.array(hits, pa.list_(pa.int64())), pa.array(named, pa.list_(pa.string()))]

        if out is None:
            out = add_columns(docs, _HITS, compute)
        else:
            out = add_columns(out.withColumnsRenamed({"hits": "_hits", "items": "_items"}), _HITS, compute)
            out = out.drop("_hits", "_items")
    if out is not None:
        return out

    def nothing(block: pa.RecordBatch) -> list:
        none = np.zeros(block.num_rows, dtype=np.int64)
        return [split(block.column("text"), ALNUM, lower=True).counts, _lists([], none, pa.int64()), _lists([], none, pa.string())]

    return add_columns(docs, _HITS, nothing)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = BENCHMARK_BYTES) -> DataFrame:
    """item_id, n_words of its longest verbatim match anywhere in ``docs``, and the smallest doc_id that holds one."""
    out = None
    for items in item_blocks(benchmark, window, most):
        sent = docs.sparkSession.sparkContext.broadcast(items)  # at most ``most`` bytes of text

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                for block in blocks(batch, "text"):
                    found, words, _, order = _shard(block, items, every=True)
                    longest, reach, _, _ = search(words, order, items)
                    starts = found.of[:-1] + np.arange(block.num_rows)
                    for item in np.unique(items.item[longest > 0]).tolist():
                        own = np.flatnonzero(items.item == item)
                        best = own[longest[own] == longest[own].max()]
                        at, _ = _occurrences(order, reach[best, 0], reach[best, 1])
                        holders = block.column("doc_id").take(pa.array(np.unique(np.searchsorted(starts, at, "right") - 1)))
                        rows = {"item_id": [items.ids[item]], "n_words": [int(longest[own].max())], "doc_id": [pc.min(holders).as_py()]}
                        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("item_id", pa.string()), ("n_words", pa.int64()), ("doc_id", pa.int64())]))

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "item_id string, n_words long, doc_id long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id string, n_words long, doc_id long")
    return out.groupBy("item_id").agg(F.max(F.struct("n_words", -F.col("doc_id"))).alias("m")).select("item_id", "m.n_words", (-F.col("m.col2")).alias("doc_id"))


def judge(matched: DataFrame, share: int = 20) -> DataFrame:
    """``matched`` with n_hit, n_items and contaminated: hit, and at least one word in ``share``."""
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2)), F.lit(0).cast("long"), lambda s, k: s + F.col("hits")[k + 1] - F.col("hits")[k])
    counted = matched.withColumn("n_hit", F.when(F.size("hits") > 0, n_hit).otherwise(0).cast("long"))
    return counted.withColumn("n_items", F.size("items").cast("long")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents. One narrow pass, through which a row's text goes once."""
    return restored(judge(matches(carried(docs, "text"), benchmark)).filter("not contaminated"), docs, "text")


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    judged = judge(matches(docs.select("doc_id", "text"), benchmark))
    named = F.concat_ws(",", F.array_sort("items"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(named, 256).alias("items_sha256"), "contaminated")
