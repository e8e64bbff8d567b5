"""Toxicity scores: misspelled lexicon terms found by automaton, weighed by the context that they stand in.

Fitting, on a bounded sample of labelled documents outside the held-out fold (``SAMPLE``, a parameter):

1. Lexicon: words of toxic documents seen between at least ``CONTEXTS`` different pairs of neighbours, so
   that copies of one text count once, and far likelier in toxic documents than in clean ones.
2. A Levenshtein automaton over the lexicon's trie (``automaton``) finds terms and words one edit away. The
   weight of a term, by edits, is its log odds over documents; a variant that clean documents use weighs nothing.
3. Evidence of a document: sum over its distinct (term, edits) of weight times the best context factor. A hit
   inside quotation marks counts ``QUOTED``, one within ``NEAR`` characters of a word of reporting ``REPORTED``, any
   other fully. What is inside is worked out over the whole line: an odd number of plain marks before the hit and one
   after, or an opening mark that none closed before the hit and that one closes after.
4. A logistic curve over evidence gives the score.

Every whole text is scored. Null and empty texts have no evidence; repeated rows are scored each; without
toxic labels the lexicon is empty and all scores are equal and low; labels other than 0 and 1 teach nothing; extra
columns are kept by ``tag`` (its own replace those of the same name) and ignored by ``toxicity_scores``. The lexicon
is as large as the sample's toxic words make it, which ``SAMPLE`` bounds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.llm.arrow import add_columns
from sentrail.llm.automaton import TermAutomaton, build
from sentrail.llm.labelled import bounded_sample, remainder, training_labels
from sentrail.llm.words import blocks
from sentrail.session import materialise

SAMPLE = 100_000
CONTEXTS = 4
LOG_ODDS = 3.0
QUOTED, REPORTED = 0.25, 0.5
NEAR = 30  # characters on either side of a hit
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_REPORT = re.compile(r"\b(said|says|wrote|writes|quoted?|quoting|called|reported|according|term|word|slur)\b")
_PAIRS = {"“": "”", "«": "»", "„": "“", "‘": "’"}


@dataclass
class ToxicityModel:
    automaton: TermAutomaton
    weights: np.ndarray  # term, edits
    slope: float
    offset: float


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts, one line break after each, and where each begins."""
    lower = [text.lower() for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(text) + 1 for text in lower])]).astype(np.int64)
    points = np.frombuffer("".join(text + "\n" for text in lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return points, starts


def _spans(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate([[False], letters > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


class Context:
    """Quotation marks and line ends of a block of texts, to look the state of any place up in."""

    def __init__(self, points: np.ndarray):
        self.points = points
        at = lambda mark: np.flatnonzero(points == ord(mark))
        self.breaks, self.plain = at("\n"), at('"')
        self.pairs = [(at(opening), at(closing)) for opening, closing in _PAIRS.items()]

    def line(self, place: int) -> tuple[int, int]:
        """Where the line of a place begins and ends."""
        k = int(np.searchsorted(self.breaks, place))
        return int(self.breaks[k - 1]) + 1 if k else 0, int(self.breaks[k]) if k < len(self.breaks) else len(self.points)

    def factor(self, low: int, high: int) -> float:
        """How fully a hit from ``low`` to ``high`` counts."""
        start, end = self.line(low)

        def last(marks: np.ndarray) -> int:
            k = int(np.searchsorted(marks, low))
            return int(marks[k - 1]) if k and marks[k - 1] >= start else -1

        def follows(marks: np.ndarray) -> bool:
            k = int(np.searchsorted(marks, high))
            return k < len(marks) and marks[k] < end

        if (np.searchsorted(self.plain, low) - np.searchsorted(self.plain, start)) % 2 and follows(self.plain):
            return QUOTED
        if any(last(opening) > last(closing) and follows(closing) for opening, closing in self.pairs):
            return QUOTED
        near = (self.points[max(start, low - NEAR) : low], self.points[high : min(end, high + NEAR)])
        return REPORTED if any(_REPORT.search(part.tobytes().decode("utf-32-le", "surrogatepass")) for part in near) else 1.0


def _hits(texts: list[str], automaton: TermAutomaton) -> Iterator[tuple[int, int, int, float]]:
    """(text, term, edits, context factor) of every hit."""
    points, starts = _letters(texts)
    letters = automaton.classes[points]
    first, last = _spans(letters)
    words, terms, edits = automaton.match(letters, first, last)
    context = Context(points)
    owners = np.searchsorted(starts, first[words], "right") - 1
    for word, term, edit, owner in zip(words.tolist(), terms.tolist(), edits.tolist(), owners.tolist(), strict=True):
        yield owner, term, edit, context.factor(int(first[word]), int(last[word]))


def _evidence(texts: list[str], automaton: TermAutomaton, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text: its evidence and its number of hits with weight."""
    best: dict[tuple[int, int, int], float] = {}
    hits = np.zeros(len(texts), dtype=np.int64)
    for text, term, edit, factor in _hits(texts, automaton):
        if weights[term, edit] > 0:
            best[text, term, edit] = max(factor, best.get((text, term, edit), 0.0))
            hits[text] += 1
    total = np.zeros(len(texts))
    for (text, term, edit), factor in best.items():
        total[text] += factor * weights[term, edit]
    return total, hits


def _texts(batch: pa.RecordBatch) -> list[str]:
    return batch.column("text").fill_null("").to_pylist()


#: bytes of text whose words are Python objects at a time, at about 50 bytes a byte
PART = 1 << 18


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from blocks(batch, "text", PART)


def _toxic_words(train: DataFrame, contexts: int) -> dict[str, int]:
    """Words of toxic documents by number of different neighbour pairs, where that is at least ``contexts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            rows: set[tuple[str, int]] = set()
            for text in _texts(batch):
                found = ["", *_WORD.findall(text.lower()), ""]
                rows.update((word, zlib.crc32(f"{left} {right}".encode())) for left, word, right in zip(found, found[1:], found[2:]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], names=["word", "around"])

    pairs = train.filter("label = 1").select("text").mapInArrow(run, "word string, around long").distinct()
    rows = pairs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= contexts).collect()
    return {row["word"]: row["n"] for row in rows}


def _documents_with(train: DataFrame, words: set[str]) -> dict[str, tuple[int, int]]:
    """Clean and toxic documents that hold each of ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, int]] = Counter()
        for batch in _blocks(batches):
            for text, label in zip(_texts(batch), batch.column("label").to_pylist(), strict=True):
                counts.update((word, label) for word in words.intersection(_WORD.findall(text.lower())))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            names=["word", "label", "n"],
        )

    found = train.select("text", "label").mapInArrow(run, "word string, label int, n long")
    by_label = [F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0)) for label in (0, 1)]
    return {row[0]: (row[1], row[2]) for row in found.groupBy("word").agg(*by_label).collect()}


def _term_counts(train: DataFrame, automaton: TermAutomaton) -> np.ndarray:
    """Documents by term, edits and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(automaton.terms), 2, 2), dtype=np.int64)
        for batch in _blocks(batches):
            labels = batch.column("label").to_pylist()
            for text, term, edit in {hit[:3] for hit in _hits(_texts(batch), automaton)}:
                counts[term, edit, labels[text]] += 1
        term, edit, label = np.nonzero(counts)
        arrays = [pa.array(x.astype(np.int64)) for x in (term, edit, label, counts[term, edit, label])]
        yield pa.RecordBatch.from_arrays(arrays, names=["term", "edit", "label", "n"])

    counts = np.zeros((len(automaton.terms), 2, 2))
    rows = train.select("text", "label").mapInArrow(run, "term long, edit long, label long, n long")
    for term, edit, label, n in rows.groupBy("term", "edit", "label").agg(F.sum("n")).collect():
        counts[term, edit, label] = n
    return counts


def _logistic(evidence: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the chance by evidence, by Newton steps with a weak pull to small slopes."""
    beta = np.array([0.1, -1.0])
    x = np.column_stack([evidence, np.ones(len(evidence))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (ones - counts * p) - 1e-2 * beta
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return max(float(beta[0]), 0.0), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE) -> ToxicityModel:
    """Learn lexicon, weights and curve from at most about ``sample`` labelled documents outside fold ``held``."""
    chosen = materialise(bounded_sample(training_labels(labels, "toxic", folds, held), sample), "toxicity_labels")
    # at most about `sample` rows of (id, label): a proven bound
    train = materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxicity_training")
    sizes = {row["label"]: row["n"] for row in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    odds = lambda in_toxic, in_clean: math.log((in_toxic + 0.5) / (toxic + 1)) - math.log((in_clean + 0.5) / (clean + 1))
    words = _toxic_words(train, CONTEXTS) if toxic else {}
    ranked = sorted(((odds(t, c), word) for word, (c, t) in _documents_with(train, set(words)).items() if t >= CONTEXTS), reverse=True) if words else []
    automaton = build([word for weight, word in ranked if weight >= LOG_ODDS])
    counts = _term_counts(train, automaton) if automaton.terms else np.zeros((0, 2, 2))
    weights = np.array([[max(0.0, odds(t, c)) for c, t in term] for term in counts]).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            quarters = np.round(_evidence(_texts(batch), automaton, weights)[0] * 4).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(quarters), batch.column("label")], names=["quarters", "label"])

    steps = train.select("text", "label").mapInArrow(run, "quarters long, label int").groupBy("quarters")
    curve = np.array(steps.agg(F.sum("label"), F.count("*")).collect() or [(0, 0, 1)], dtype=float)  # no more rows than the sample
    return ToxicityModel(automaton, weights, *_logistic(curve[:, 0] / 4, curve[:, 1], curve[:, 2]))


_FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("n_hits", T.LongType())])


def tag(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` and ``n_hits`` of each whole text. Lazy, no shuffle; the model is as large as the sample allows."""

    def compute(block: pa.RecordBatch) -> list[np.ndarray]:
        evidence, hits = _evidence(_texts(block), model.automaton, model.weights)
        return [1 / (1 + np.exp(-np.clip(model.slope * evidence + model.offset, -500, 500))), hits]

    return add_columns(docs, _FIELDS, compute)


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits of every document."""
    scored = tag(docs.select("doc_id", "text"), fit(docs, labels, folds, held)).drop("text")
    return scored.select(
        "doc_id", (remainder(folds) == held).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"), "n_hits"
    )
