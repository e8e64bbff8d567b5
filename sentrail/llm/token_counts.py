"""Token counts of the sections or fields of a document, from one encoding of the whole document.

The tokenizer is byte-level, so its tokens' byte lengths add up to their spans in the text. A section is a span
of bytes; tokens meet sections in an interval join on both sides' sorted bounds. A token that crosses a
boundary counts for the section that holds most of its bytes, and for the earlier one of equals. So the counts of
a document's sections add up to the tokens of the whole, which separate encodings would not give.

``line_tokens`` takes the lines of a text as sections (a line break belongs to the line that it ends);
``field_tokens`` takes columns, joined by line breaks that belong to the field before. Null counts as empty. An
empty text has one empty section without tokens. Repeated rows are counted each, an empty table gives an empty
result, extra columns are ignored. Whole texts are encoded.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.llm.words import blocks

SECTION = T.StructType([T.StructField(name, T.LongType()) for name in ("section", "first_byte", "n_bytes", "n_tokens", "n_crossing")])


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, file)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for word, rank in ranks.items():
        lengths[rank] = len(word)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def allocate(lengths: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross its bounds. ``bounds`` has each section's first byte, and the end.

    Of the sections that a token overlaps, the one that holds most of its bytes gets it, and of equals the first.
    """
    sections = len(bounds) - 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    low = np.searchsorted(bounds, starts, "right") - 1
    high = np.searchsorted(bounds, ends, "left") - 1
    owner = low.copy()
    for token in np.flatnonzero(high > low):
        parts = np.arange(low[token], high[token] + 1)
        shares = np.minimum(bounds[parts + 1], ends[token]) - np.maximum(bounds[parts], starts[token])
        owner[token] = parts[np.argmax(shares)]
    return np.bincount(owner, minlength=sections), np.bincount(owner[high > low], minlength=sections)


def _line_bounds(text: bytes) -> np.ndarray:
    breaks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    inner = breaks[breaks < len(text)]
    return np.concatenate([[0], inner, [len(text)]])


def _attributed(rows: DataFrame, key: str, texts: Callable[[pa.RecordBatch], Iterator[tuple[str, np.ndarray | None]]], path: str, pattern: str) -> DataFrame:
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoding(path, pattern)
        for batch in batches:
            for block in blocks(batch, columns[1]):
                taken, parts = [], []
                for row, (text, bounds) in enumerate(texts(block)):
                    data = text.encode()
                    bounds = _line_bounds(data) if bounds is None else bounds
                    tokens = np.array(encoding.encode_ordinary(text), dtype=np.int64)
                    counts, crossing = allocate(lengths[tokens], bounds)
                    parts.append(np.column_stack([np.arange(len(counts)), bounds[:-1], np.diff(bounds), counts, crossing]))
                    taken.append(np.full(len(counts), row))
                if parts:
                    made = np.concatenate(parts)
                    ids = block.column(key).take(pa.array(np.concatenate(taken)))
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(made[:, k]) for k in range(made.shape[1])]], names=[key, *SECTION.names])

    return rows.mapInArrow(run, T.StructType([rows.schema[key], *SECTION.fields]))


def line_tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, section, first_byte, n_bytes, n_tokens, n_crossing of every line of every text. Lazy, no shuffle."""
    texts = lambda block: ((text, None) for text in block.column("text").fill_null("").to_pylist())
    return _attributed(docs.select("doc_id", "text"), "doc_id", texts, path, pattern)


def field_tokens(rows: DataFrame, key: str, fields: list[str], path: str, pattern: str) -> DataFrame:
    """The same for columns as sections, in the order of ``fields``; ``section`` is the number of the field."""

    def texts(block: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
        for values in zip(*[block.column(name).cast(pa.string()).fill_null("").to_pylist() for name in fields], strict=True):
            sizes = [len(value.encode()) + 1 for value in values]
            sizes[-1] -= 1
            yield "\n".join(values), np.concatenate([[0], np.cumsum(sizes)])

    picked = rows.select(F.col(key), *[F.col(name).cast("string") for name in fields])
    return _attributed(picked, key, texts, path, pattern)
