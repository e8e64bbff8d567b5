"""Token ids as ORC files: integer run-length encoding, row indexes and Bloom filters on the document id.

``write_tokens`` encodes whole texts with a given tokenizer, appends an end id to each, and writes
(doc_id, place, n_tokens, ids) in ascending doc_id order: files hold consecutive ranges of ids and are sorted
inside, so stripes can be read in parallel and skipped by the ids' minimum, maximum and Bloom filter. ``place`` is
the number of ids before the document in its file. ``read_tokens`` gives the rows back with ``start``, the number
of ids in all documents before: it adds up one total per file and moves no row. Looking up ids (``doc_id in
(...)``) reaches the file reader as a filter.

A text is cut at blanks, where this kind of tokenizer never joins, and equal words of a task are encoded once,
by the same library and with the same ids as the whole text; texts that hold an added token's text go through it
whole. A tokenizer that keeps white space needs ``cut_at_blanks=False``. Null counts as empty and has the end id alone.
Repeated ids are written each, in the order of their texts' checksums, and an id may fill many files; a null doc_id comes
first; an empty table gives no rows. Extra columns are ignored. One text is held whole in one task.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from sentrail.llm.words import blocks, split
from sentrail.operators.grouped import join_small
from sentrail.session import materialise

END = 2
#: bytes of encoded words that a task keeps before it starts anew, each word taken as its own bytes and WORD_BYTES
CACHE = 128 << 20
WORD_BYTES = 200
#: bytes of text encoded together
BLOCK = 1 << 20
#: documents to a file, about
FILE_ROWS = 10_000
ROW = "doc_id long, place long, n_tokens long, ids array<int>"


#: what is not a blank, tab or line feed
_WORD = np.array([byte not in b" \t\n" for byte in range(256)])
_LAST_LATIN = "\u024f"  # letters up to here have one form and no marks
_PROBES = ("a", "Word", "Été", "ñandú", "groß", "straße", "łódź")
#: kinds of bytes: a-z (and, two bytes each, À to ÿ), 0-9, the apostrophe, other ASCII signs; 0 is all else
_LETTER, _DIGIT, _QUOTE, _SIGN = 1, 2, 3, 4
_SIGNS = [chr(byte) for byte in range(0x21, 0x7F) if not chr(byte).isalnum() and byte != 0x27]
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x61:0x7B], _KIND[0x30:0x3A], _KIND[0x27], _KIND[[ord(sign) for sign in _SIGNS]] = _LETTER, _DIGIT, _QUOTE, _SIGN
#: whether a piece ends between bytes of two kinds, by 8 times the first and the second. 's and the like stay in one
_CUT = np.zeros(64, dtype=bool)
_CUT[[8 * one + two for one, two in [(1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (3, 2), (4, 1), (4, 2)]]] = True
_BYTES = ByteLevel(add_prefix_space=False, use_regex=False)
_MAPPED = {point: _BYTES.pre_tokenize_str(chr(point))[0][0] for point in range(0x80, ord(_LAST_LATIN) + 1)}


class WordEncoder:
    """Encodes texts by their words; each distinct word is encoded once while it is kept.

    Words are what lies between blanks, tabs and line feeds, with A-Z in lower case and cut further where letters a-z and
    À-ÿ, single digits and other ASCII signs meet. A word of Latin letters goes straight to the tokenizer's model in
    lower case; all other words go through the whole tokenizer. Whether these shortcuts hold for a tokenizer is tried on
    ``_PROBES`` first; else words are taken as they are. Texts that hold an added token's text, in any case, are encoded whole.
    """

    def __init__(self, tokenizer: Tokenizer, most: int = CACHE):
        self.tokenizer, self.model, self.most = tokenizer, tokenizer.model, most
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.direct = all(self._simple(word) == self._whole([word])[0] for word in _PROBES) and self._cuts_hold()
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.kept = 0
        self.ids, self.bounds = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [item.ids for item in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cuts_hold(self) -> bool:
        """Whether the probes, joined by what ``_CUT`` parts, have the ids of their parts."""
        joints = [[sign] for sign in [*_SIGNS, *"0123456789", "***", "!?.", "'!", "'."]] + [["4", "2"], ["'", "7"], ["5", "'."], ["-", "3"], ["3", ","]]
        cases = [[word.lower(), *joint, other.lower()] for joint in joints for word, other in zip(_PROBES, (*_PROBES[1:], _PROBES[0]), strict=True)]
        cases += [[word.lower(), tail] for word in _PROBES for tail in ("'", "'s", "'ll", "'x", "'S.")]
        parts = {part: ids for part in {part for case in cases for part in case} for ids in self._whole([part])}
        return self._whole(["".join(case) for case in cases]) == [[i for part in case for i in parts[part]] for case in cases]

    def _simple(self, word: str) -> list[int] | None:
        """Ids of a word of Latin letters, else None."""
        if not word.isalpha():
            return None
        word = word.lower()
        if not word.isascii():
            if max(word) > _LAST_LATIN:
                return None
            word = word.translate(_MAPPED)
        return [token.id for token in self.model.tokenize(word)]

    def _learn(self, words: list[str]) -> None:
        found = list(map(self._simple, words)) if self.direct else [None] * len(words)
        others = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(others, self._whole([words[k] for k in others]), strict=True):
            found[k] = ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])

    def _places(self, distinct: list[bytes]) -> np.ndarray:
        """The number of each word, new ones learnt."""
        if self.kept > self.most:
            self._reset()
        places = np.fromiter(map(self.number.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        fresh = np.flatnonzero(places < 0)
        if len(fresh):
            new = [distinct[k] for k in fresh.tolist()]
            self._learn(b"\n".join(new).decode().split("\n"))  # no word holds a line feed
            places[fresh] = np.arange(len(self.number), len(self.number) + len(new))
            self.number.update(zip(new, places[fresh].tolist(), strict=True))
            self.kept += sum(map(len, new)) + WORD_BYTES * len(new)
        return places

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = split(texts, _WORD, lower=self.direct)
        # all words end to end: a binary array whose values Arrow tells apart without making them objects
        ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
        inside = words.data[_WORD[words.data]]
        of = words.of
        if self.direct and len(inside):
            kind = _KIND[inside]
            latin = np.flatnonzero(inside == 0xC3)  # À to ÿ, without the two signs among them
            latin = latin[(inside[latin + 1] != 0x97) & (inside[latin + 1] != 0xB7)]
            kind[latin] = kind[latin + 1] = _LETTER
            edge = np.ones(len(inside) + 1, dtype=bool)
            edge[1:-1] = _CUT[(kind[:-1] << 3) | kind[1:]]
            edge[ends] = True
            cut = np.flatnonzero(edge)
            ends, of = cut, np.searchsorted(cut, ends[of])
        column = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(inside)])
        coded = column.dictionary_encode()
        places = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        sizes = self.bounds[places + 1] - self.bounds[places]
        last = np.cumsum(sizes)
        take = np.arange(int(last[-1]) if len(last) else 0) + np.repeat(self.bounds[places] - (last - sizes), sizes)
        return self.ids[take], np.diff(np.concatenate([[0], last])[of])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has. Null counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(texts), dtype=bool)
        for content in self.added:
            whole |= pc.match_substring(texts, content, ignore_case=True).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._by_words(texts)
        ids, counts = self._by_words(pc.if_else(pa.array(whole), "", texts))
        rows = np.flatnonzero(whole)
        found = self._whole(texts.take(pa.array(rows)).to_pylist())
        before = np.concatenate([[0], np.cumsum(counts)])
        counts[rows] = list(map(len, found))
        at = np.repeat(before[rows], counts[rows])
        return np.insert(ids, at, np.fromiter(chain.from_iterable(found), dtype=np.int32, count=len(at))), counts


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already take all cores
    return WordEncoder(Tokenizer.from_file(path))


def _encoded(docs: DataFrame, path: str, end: int, cut_at_blanks: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        before = 0
        for batch in batches:
            for block in blocks(batch, "text", BLOCK):
                if cut_at_blanks:
                    ids, counts = encoder.encode(block.column("text"))
                else:
                    found = encoder._whole(block.column("text").fill_null("").to_pylist())
                    ids, counts = np.array([i for part in found for i in part], dtype=np.int32), np.array([len(part) for part in found])
                ids = np.insert(ids, np.cumsum(counts), end)
                ends = np.concatenate([[0], np.cumsum(counts + 1)])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))
                columns = [block.column("doc_id"), pa.array(before + ends[:-1]), pa.array(counts + 1), lists]
                before += int(ends[-1])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, ROW)


def write_tokens(docs: DataFrame, folder: str, path: str, end: int = END, cut_at_blanks: bool = True, **orc: str) -> None:
    """Write the token files. Texts are dealt by ranges of doc_id, then encoded and written where they are. ``orc`` adds writer settings."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    files = max(1, -(-docs.count() // FILE_ROWS))
    # repeated ids are told apart by their texts, and rows that are equal in both by where they were read
    order = ["doc_id", F.crc32(F.col("text").cast("binary")), F.monotonically_increasing_id()]
    dealt = docs.repartitionByRange(files, *order).sortWithinPartitions(*order[:2])
    settings = {"orc.compress": "ZSTD", "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": "10000"}
    _encoded(dealt, path, end, cut_at_blanks).write.options(**settings | orc).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document. Placing the files reads their names and n_tokens only."""
    # files are numbered in the order of their ranges
    rows = spark.read.schema(ROW).orc(folder).withColumn("_file", F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int"))
    sizes = rows.groupBy("_file").agg(F.sum("n_tokens").alias("total"))
    in_order = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = materialise(sizes.select("_file", F.coalesce(F.sum("total").over(in_order), F.lit(0)).alias("_before")), "token_files")  # one row a file
    placed = join_small(rows, files, ["_file"], row_bytes=128)
    return placed.select("doc_id", (F.col("_before") + F.col("place")).alias("start"), "n_tokens", "ids")


def digests(rows: DataFrame) -> DataFrame:
    """``rows`` of (doc_id, n_tokens, ids) with ids_crc32 in place of the ids: crc32 of them as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
            sums = [zlib.crc32(data[4 * low : 4 * high]) for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=[*batch.schema.names[:-1], "ids_crc32"])

    others = [name for name in rows.columns if name != "ids"]
    return rows.select(*others, "ids").mapInArrow(run, ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in others) + ", ids_crc32 long")
