"""Alignment of two tokenizers' tokens over the same texts, by pointer jumping.

``A`` is a byte-level BPE file of the tokenizers library and encodes a blank and the text; ``B`` is a sentencepiece model,
which puts the blank there itself. Strings of special tokens inside a text are plain text. Every token stands
for the bytes of its entry, so each side cuts the same bytes, and a text whose tokens' bytes are not
exactly the blank and the text on both sides (or that is null or empty) counts as having no tokens.

Two tokens are linked where their byte ranges overlap. Groups, the parts between byte offsets where tokens of both sides
end, are the components of these links. They are labelled for many texts at once: every token points to
the overlapping token that reaches farthest right (to the one of A of two that end together), and pointers
are doubled until they stand still, at the group's last token of A. That takes as many steps as the logarithm of the
longest group's tokens.

A text is cut before every blank between two letters, digits or marks (see ``cuts``): there both tokenizers begin anew, as no
entry of theirs has a blank after anything else, so the parts have the tokens that the whole text has, and a group ends.
Equal parts of a task are encoded and aligned once while they are kept. Whether a pair of tokenizers may be cut so is
read off their entries and settings; others encode whole texts.

``alignments`` returns the tokens and groups of every text. ``alignment_report`` sums them up with corpus-wide counts: an
id pair's count is the number of rows that hold it linked; a link is among the best of its A id if no other pair
of that id has a higher count. Each text is encoded once; its distinct linked pairs are written and looked up
in the merged counts, which are broadcast only where their number allows it, and met by salted keys beyond.

Rows that repeat, also in doc_id, count each; a null doc_id is kept; an empty table gives an empty result; extra
columns are ignored, whatever their names. One text is held whole in one task, at about 200 bytes a byte.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sentrail.llm.words import blocks, text_bytes
from sentrail.operators.grouped import join_small
from sentrail.session import materialise, scratch_path


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible Latin-1 letters for themselves, others from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + k): byte for k, byte in enumerate(others)}


def _by_id(entries: dict[int, bytes]) -> list[bytes]:
    return [entries.get(k, b"") for k in range(max(entries, default=-1) + 1)]


_PROBES = ("two words", "Été à Łódź 42 groß, n'est-ce pas? 3.14 x_y", "日本 語 “q” don't I'll we've")


class Tokenizers:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already take all cores
        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        byte_of = _byte_of()
        special = set(self.a.get_added_tokens_decoder())
        self.bytes_a = _by_id({k: bytes(byte_of[letter] for letter in entry) for entry, k in self.a.get_vocab(with_added_tokens=False).items() if k not in special})
        self.bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.lengths_a, self.lengths_b = (np.array([len(entry) for entry in side], dtype=np.int64) for side in (self.bytes_a, self.bytes_b))
        # both sides begin anew at a blank: A cuts texts before words, and no entry of B has a blank after something else
        cutter = json.loads(self.a.to_str())["pre_tokenizer"] or {}
        simple = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not json.loads(self.a.to_str())["normalizer"]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.cut = simple and not any("▁" in piece.lstrip("▁") for piece in pieces) and all(map(self._same, _PROBES))
        # decimal ids with what may follow them in a description of groups
        self.said_a = [np.array([b"%d%s" % (k, end) for k in range(len(self.bytes_a))], dtype=object) for end in (b",", b"|")]
        self.said_b = [np.array([b"%d%s" % (k, end) for k in range(len(self.bytes_b))], dtype=object) for end in (b",", b";")]

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    def _same(self, text: str) -> bool:
        """Whether the parts of a text have the ids of the whole."""
        parts = text.split(" ")
        a = self.a.encode(" " + text, add_special_tokens=False).ids == [k for part in parts for k in self.a.encode(" " + part, add_special_tokens=False).ids]
        return a and self.b.encode(text) == [k for part in parts for k in self.b.encode(part)]

    def encode(self, texts: Sequence[str]) -> tuple[list[Sequence[int]], list[Sequence[int]]]:
        """Ids of both sides; none where either side's bytes are not a blank and the text."""
        some = [k for k, text in enumerate(texts) if text]
        a: list[Sequence[int]] = [()] * len(texts)
        b: list[Sequence[int]] = [()] * len(texts)
        wanted = [" " + texts[k] for k in some]
        coded = self.a.encode_batch_fast(wanted, add_special_tokens=False)
        pieces = self.b.encode([texts[k] for k in some], num_threads=1)
        for k, text, one, two in zip(some, wanted, coded, pieces, strict=True):
            ids, data = one.ids, text.encode()
            if b"".join(map(self.bytes_a.__getitem__, ids)) == data == b"".join(map(self.bytes_b.__getitem__, two)):
                a[k], b[k] = ids, two
        return a, b


def _flat(ids: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    return np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token of A and then of B, the last token of A in its group. Both sides cover the same bytes."""
    n = len(ends_a)
    far_a = np.searchsorted(np.concatenate([[0], ends_b[:-1]]), ends_a, "left") - 1
    far_b = np.searchsorted(np.concatenate([[0], ends_a[:-1]]), ends_b, "left") - 1
    to = np.concatenate([np.where(ends_b[far_a] > ends_a, n + far_a, np.arange(n)), far_b]) if n else np.zeros(0, dtype=np.int64)
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


@dataclass
class Aligned:
    """Tokens of a block of texts with their groups; text k has tokens of A from of_a[k] to of_a[k + 1], and so for B and groups."""

    a: np.ndarray
    of_a: np.ndarray
    b: np.ndarray
    of_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    of_groups: np.ndarray
    low: np.ndarray
    links: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id of A, id of B) of every link."""
        one = np.repeat(np.arange(len(self.a)), self.links)
        two = np.repeat(self.low - (np.cumsum(self.links) - self.links), self.links) + np.arange(len(one))
        return np.repeat(np.repeat(np.arange(len(self.of_a) - 1), np.diff(self.of_a)), self.links), self.a[one], self.b[two]

    def descriptions(self, tokenizers: Tokenizers) -> Iterator[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text: ids of A and B, group by group."""
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        last_a, last_b = (np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, dtype=bool) for group in (self.group_a, self.group_b))
        out[np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a, "left")] = np.where(last_a, tokenizers.said_a[1][self.a], tokenizers.said_a[0][self.a])
        out[np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")] = np.where(last_b, tokenizers.said_b[1][self.b], tokenizers.said_b[0][self.b])
        bounds = self.of_a + self.of_b
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield b"".join(out[low:high].tolist())[:-1]


def align(texts: Sequence[str], tokenizers: Tokenizers) -> Aligned:
    (a, of_a), (b, of_b) = (_flat(side) for side in tokenizers.encode(texts))
    ends_a, ends_b = np.cumsum(tokenizers.lengths_a[a]), np.cumsum(tokenizers.lengths_b[b])
    last = terminals(ends_a, ends_b)
    ends_group = np.zeros(len(a) + 1, dtype=np.int64)
    ends_group[1:] = np.cumsum(last[: len(a)] == np.arange(len(a)))
    group = ends_group[last]
    low = np.searchsorted(ends_b, ends_a - tokenizers.lengths_a[a], "right")
    links = np.searchsorted(ends_b, ends_a, "left") + 1 - low
    return Aligned(a, of_a, b, of_b, group[: len(a)], group[len(a) :], ends_group[of_a], low, links)


#: bytes of parts that a task keeps before it starts anew, each taken as its own bytes and PART_BYTES
CACHE = 128 << 20
PART_BYTES = 600


def cuts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Places of the blanks that texts are cut at: single ones, neither first nor last in a text, between characters that
    can't be white space: ASCII from ! on, or others that the leading bytes of white space beyond ASCII don't begin."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(data == 0x20)
    first, end = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
    first[texts[:-1]] = True
    end[texts[1:]] = True
    at = at[~first[at] & ~end[at + 1]]
    before, after = data[at - 1], data[at + 1]
    # U+0085, U+00A0, U+1680, U+2000 to U+205F and U+3000 begin with these bytes
    fits_after = (after > 0x20) & (after != 0x7F) & ~np.isin(after, [0xC2, 0xE1, 0xE2, 0xE3])
    two = (before >= 0x80) & (at > 1) & (data[at - 2] >= 0xC3) & (data[at - 2] <= 0xDF)
    return at[fits_after & (((before > 0x20) & (before < 0x7F)) | two)]


class Parts:
    """Parts of texts, each encoded and aligned when it is first met and known by its number from then on."""

    def __init__(self, tokenizers: Tokenizers, most: int = CACHE):
        self.tokenizers, self.most = tokenizers, most
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.kept = 0
        self.right = np.zeros(0, dtype=bool)
        self.said = np.zeros(0, dtype=object)
        self.sizes = {name: np.zeros(0, dtype=np.int64) for name in ("a", "b", "groups", "pairs")}
        self.values = {name: np.zeros(0, dtype=np.int64) for name in ("a", "b", "group_a", "group_b", "pairs")}

    def _learn(self, parts: list[bytes]) -> None:
        texts = [part.decode() for part in parts]
        made = align(texts, self.tokenizers)
        text, one, two = made.pairs()
        counts = {"a": np.diff(made.of_a), "b": np.diff(made.of_b), "groups": np.diff(made.of_groups), "pairs": np.bincount(text, minlength=len(parts))}
        first = made.of_groups[:-1]
        found = {
            "a": made.a, "b": made.b, "group_a": made.group_a - np.repeat(first, counts["a"]), "group_b": made.group_b - np.repeat(first, counts["b"]),
            "pairs": one * len(self.tokenizers.bytes_b) + two,
        }
        self.right = np.concatenate([self.right, counts["a"] > 0])
        said = np.empty(len(parts), dtype=object)
        said[:] = list(made.descriptions(self.tokenizers))
        self.said = np.concatenate([self.said, said])
        self.sizes = {name: np.concatenate([old, counts[name]]) for name, old in self.sizes.items()}
        self.values = {name: np.concatenate([old, found[name]]) for name, old in self.values.items()}

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of all texts end to end, and where each text's begin. Texts that are not cut alike on both
        sides, or are null or empty, have none."""
        if self.kept > self.most:
            self._reset()
        data, bounds = text_bytes(texts)
        at = cuts(data, bounds) if self.tokenizers.cut else np.zeros(0, dtype=np.int64)
        full = np.diff(bounds) > 0
        inside = np.ones(len(data), dtype=bool)
        inside[at] = False
        # a part begins with a text, and after every cut
        starts = np.union1d(bounds[:-1][full], at + 1)
        gone = np.concatenate([[0], np.cumsum(~inside)])
        offsets = np.append(starts - gone[starts], len(data) - len(at))
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [part for part in distinct if part not in self.number]
        if new:
            self._learn(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.kept += sum(map(len, new)) + PART_BYTES * len(new)
        places = np.fromiter(map(self.number.__getitem__, distinct), dtype=np.int64, count=len(distinct))[coded.indices.to_numpy()]
        of = np.searchsorted(starts, bounds)
        wrong = np.concatenate([[0], np.cumsum(~self.right[places])])
        good = (wrong[of[1:]] == wrong[of[:-1]]) & full
        counts = np.where(good, np.diff(of), 0)
        return places[np.repeat(good, np.diff(of))], np.concatenate([[0], np.cumsum(counts)])

    def take(self, name: str, size: str, places: np.ndarray) -> np.ndarray:
        """Values of the given parts, end to end."""
        sizes = self.sizes[size][places]
        begin = (np.cumsum(self.sizes[size]) - self.sizes[size])[places]
        return self.values[name][np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


@lru_cache(maxsize=1)
def _parts(path_a: str, path_b: str) -> Parts:
    """One for all tasks of a Python worker."""
    return Parts(Tokenizers(path_a, path_b))


def _bounds(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Where each text's share of a number of values for every part begins."""
    return np.concatenate([[0], np.cumsum(values)])[of]


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and, for each side, its token ids and their group numbers (from 0 in each text). Lazy, no shuffle."""
    names = ["doc_id", "a_ids", "a_groups", "b_ids", "b_groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                parts = _parts(path_a, path_b)
                places, of = parts.of(block.column("text"))
                groups = parts.sizes["groups"][places]
                before = np.cumsum(groups) - groups - np.repeat(_bounds(groups, of)[:-1], np.diff(of))
                columns = [block.column("doc_id")]
                for side in ("a", "b"):
                    sizes = parts.sizes[side][places]
                    bounds = _bounds(sizes, of)
                    numbers = parts.take(f"group_{side}", side, places) + np.repeat(before, sizes)
                    columns += [_lists(parts.take(side, side, places), bounds), _lists(numbers, bounds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, " + ", ".join(f"{name} array<int>" for name in names[1:]))


_SUMMARY = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<int>"


def _summaries(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Sizes and the groups' checksum of every text, with its distinct linked pairs and how often it has each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                parts = _parts(path_a, path_b)
                places, of = parts.of(block.column("text"))
                sizes = [np.diff(_bounds(parts.sizes[name][places], of)) for name in ("a", "b", "groups", "pairs")]
                said = parts.said[places]
                digests = [hashlib.sha256(b";".join(said[low:high].tolist())).hexdigest() if high > low else "" for low, high in zip(of[:-1].tolist(), of[1:].tolist(), strict=True)]
                # each text's distinct parts first, then the pairs in those
                known, width = len(parts.right), len(parts.tokenizers.bytes_b)
                key, times = np.unique(np.repeat(np.arange(block.num_rows), np.diff(of)) * known + places, return_counts=True)
                text, place = np.divmod(key, max(1, known))
                counts = parts.sizes["pairs"][place]
                codes = width * len(parts.tokenizers.bytes_a)
                found, at = np.unique(np.repeat(text, counts) * codes + parts.take("pairs", "pairs", place), return_inverse=True)
                times = np.bincount(at, weights=np.repeat(times, counts), minlength=len(found))
                text, pair = np.divmod(found, codes)
                bounds = np.searchsorted(text, np.arange(block.num_rows + 1))
                lists = [_lists(pair // width, bounds), _lists(pair % width, bounds), _lists(times, bounds)]
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), *map(pa.array, sizes), pa.array(digests, pa.string()), *lists], names=_NAMES)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, _SUMMARY)


_NAMES = [field.split()[0] for field in _SUMMARY.split(", ")]


def pair_counts(summaries: DataFrame, max_bytes: int) -> DataFrame:
    """a, b, rows (that hold the pair linked) and best (1 where no pair of ``a`` has more) of every linked id pair. Written."""
    pairs = summaries.select(F.explode(F.arrays_zip("a", "b")).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("rows"))
    pairs = materialise(pairs, "pairs")
    most = materialise(pairs.groupBy("a").agg(F.max("rows").alias("most")), "best_pairs")  # a row per id of A
    joined = join_small(pairs, most, ["a"], row_bytes=64, max_bytes=max_bytes)
    return materialise(joined.select("a", "b", "rows", (F.col("rows") == F.col("most")).cast("int").alias("best")), "pair_counts")


def alignment_report(docs: DataFrame, path_a: str, path_b: str, max_bytes: int = 128 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    ``max_bytes`` is the size up to which the table of pairs is broadcast.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "alignments")
    _summaries(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(_SUMMARY + ", row long").parquet(path)
    counts = pair_counts(rows, max_bytes)
    held = rows.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("p")).select("row", "p.a", "p.b", "p.times")
    looked_up = join_small(held, counts, ["a", "b"], row_bytes=64, max_bytes=max_bytes)
    sums = looked_up.groupBy("row").agg(F.sum(F.expr("cast(times as long) * best")).alias("n_best"), F.sum(F.expr("times * rows")).alias("count_sum"))
    facts = rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    out = facts.join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
