"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

The statistics (``STATISTICS``) are standardised and sent through fixed random cosines, which approximate a
Gaussian kernel. Each partition adds up its part of the normal equations; the parts meet row by row of the
matrix, and the driver solves a system whose size is the number of cosines, whatever the number of rows. What is summed
is in whole steps (``STEP`` of a cosine, ``UNIT`` of a statistic), so that sums are exact and the same in any order.
Raw scores of training rows are counted in narrow steps, and pool-adjacent-violators turns the steps into
probabilities. All labelled rows outside the held-out fold take part.

Null and empty texts have all-zero counts and are scored like others; repeated documents are scored each, and where
an id stands for several texts the one with the smallest statistics is learnt from; labels other than 0 and 1 teach
nothing; documents of one score are ties; without any label every score is 0.5, and an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentrail.llm.arrow import add_columns
from sentrail.llm.labelled import remainder, training_labels
from sentrail.llm.quality_rules import _measures, _per_text
from sentrail.llm.words import BY_SPACE, split
from sentrail.session import materialise

STATISTICS = (
    "words", "word_length", "word_length_spread", "symbols", "repeat_lines", "repeat_words", "capitals",
    "digits", "stops", "shouts", "bars", "distinct_words", "words_per_line", "other_bytes", "entropy",
)
COSINES = 256
WIDTH = 2.0
RIDGE = 1e-3
STEPS = 512
#: steps that a cosine, and a statistic, are counted in: sums of their products stay whole in a double and a long
STEP = 1 / 4096
UNIT = 1 / (1 << 20)

_is = lambda chars: np.array([chr(byte) in chars for byte in range(256)])
_DIGIT, _STOP, _SHOUT, _BAR = _is("0123456789"), _is(".,;:"), _is("!?"), _is("|")
_FIELD = T.StructType([T.StructField("stats", T.ArrayType(T.DoubleType()))])


def _distinct(owner: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    return np.bincount(owner[order][new], minlength=texts)


def _entropy(words) -> np.ndarray:
    out = np.zeros(len(words.texts) - 1)
    for k, (low, high) in enumerate(zip(words.texts[:-1], words.texts[1:], strict=True)):
        if high > low:
            share = np.bincount(words.data[low:high], minlength=1)
            share = share[share > 0] / (high - low)
            out[k] = -(share * np.log2(share)).sum()
    return out


def _statistics(block: pa.RecordBatch) -> list[pa.Array]:
    words = split(block.column("text"), BY_SPACE)
    n_words, chars, symbols, dup_lines, repeats, lines, capitals = _measures(block)
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    length = words.ends - words.starts
    mean = words.per_text(length) / w
    share = lambda mask: np.sqrt(_per_text(mask[words.data], words.texts) / c)
    columns = [
        np.log1p(n_words), chars / w, np.sqrt(np.maximum(words.per_text(length * length) / w - mean * mean, 0)), np.sqrt(symbols / c),
        np.sqrt(dup_lines / np.maximum(lines, 1)), np.sqrt(repeats / w), np.sqrt(capitals / c),
        share(_DIGIT), share(_STOP), share(_SHOUT), share(_BAR), _distinct(words.owner(), words.hashes(), len(w)) / w,
        np.log1p(n_words / np.maximum(lines, 1)), share(np.arange(256) >= 0x80), _entropy(words),
    ]
    matrix = np.column_stack(columns).astype(float)
    starts = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * len(STATISTICS))
    return [pa.ListArray.from_arrays(starts, pa.array(matrix.ravel()))]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each whole text, in the order of ``STATISTICS``. Lazy, no shuffle."""
    return add_columns(docs.select("doc_id", "text"), _FIELD, _statistics).drop("text")


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    turns: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    levels: np.ndarray
    chances: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        standard = np.clip((stats - self.centre) / self.scale, -6, 6)
        cosines = np.rint(np.cos(standard @ self.turns + self.phase) / STEP) * STEP
        return np.column_stack([cosines, np.ones(len(stats))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights, -0.5, 1.5)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        if not len(self.levels):
            return np.full(len(raw), 0.5)
        # a hundredth of the raw score orders documents within one calibrated step
        return 0.99 * np.interp(raw, self.levels, self.chances) + 0.01 * (raw + 0.5) / 2


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(STATISTICS))


def _normal_equations(train: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of z zT and z y: added up per partition, then cell by cell of the matrix, in whole steps."""
    size = COSINES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_matrix(batch))
            total[:, :size] += z.T @ z
            total[:, size] += z.T @ batch.column("label").to_numpy()
        whole = np.rint(total / STEP**2).astype(np.int64)
        rows = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * (size + 1)), pa.array(whole.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), rows], names=["i", "row"])

    parts = train.select("stats", "label").mapInArrow(partial, "i int, row array<long>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()  # (COSINES + 1) * (COSINES + 2) rows
    whole = np.zeros((size, size + 1))
    whole[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["x"].to_numpy() * STEP**2
    return whole[:, :size], whole[:, size]


def isotonic(levels: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing shares closest to ones / counts."""
    blocks: list[list[float]] = []
    for one, n in zip(ones, counts, strict=True):
        blocks.append([float(one), float(n), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            one_, n_, k_ = blocks.pop()
            blocks[-1] = [blocks[-1][0] + one_, blocks[-1][1] + n_, blocks[-1][2] + k_]
    return np.concatenate([np.full(int(k), (one + 0.5) / (n + 1)) for one, n, k in blocks])


def fit(train: DataFrame, seed: int = 11) -> QualityModel:
    """Fit on written rows of (stats, label). Four jobs; nothing that grows with the rows reaches the driver."""
    width = len(STATISTICS)
    units = [F.rint(F.col("stats")[k] / UNIT).cast("decimal(18, 0)") for k in range(width)]
    row = train.agg(F.count("*"), *[F.sum(x) for unit in units for x in (unit, unit * unit)]).collect()[0]
    empty = row[0] == 0
    n = max(1, row[0])
    sums, squares = ([int(x or 0) for x in row[1 + k :: 2]] for k in (0, 1))
    centre = np.array([s / n * UNIT for s in sums])
    variance = np.array([(n * q - s * s) / n**2 * UNIT**2 for s, q in zip(sums, squares, strict=True)])
    scale = np.ones(width) if empty else np.maximum(np.sqrt(variance), 1e-6)
    random = np.random.default_rng(seed)
    turns = random.normal(0, 1 / (WIDTH * np.sqrt(width / 4)), (width, COSINES))
    model = QualityModel(centre, scale, turns, random.uniform(0, 2 * np.pi, COSINES), np.zeros(COSINES + 1), np.zeros(0), np.zeros(0))
    if empty:
        return model
    left, right = _normal_equations(train, model)
    # features are cosines as they are, sqrt(COSINES / 2) times those of the kernel's expansion
    penalty = np.append(np.full(COSINES, COSINES / 2), 1.0) * RIDGE * row[0] * 1e-2
    model.weights = np.linalg.solve(left + np.diag(penalty), right)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.floor(model.raw(_matrix(batch)) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("label")], names=["step", "label"])

    steps = train.select("stats", "label").mapInArrow(raw, "step long, label int").groupBy("step")
    counted = sorted(steps.agg(F.sum("label").alias("ones"), F.count("*").alias("n")).collect())  # 2 * STEPS rows at most
    step, ones, n = (np.array(x, dtype=float) for x in zip(*counted, strict=True))
    model.levels, model.chances = (step + 0.5) / STEPS, isotonic(step, ones, n)
    return model


def score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every row of ``statistics``. Lazy, no shuffle; the model goes along in the closure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch)))], names=["doc_id", "score"])

    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return stats.select("doc_id", "stats").mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document. The texts are read once; their statistics are written."""
    stats = materialise(statistics(docs), "quality_statistics")
    train = materialise(stats.groupBy("doc_id").agg(F.min("stats").alias("stats")).join(training_labels(labels, "quality", folds, held), "doc_id"), "quality_training")
    scored = score(stats, fit(train))
    return scored.select(
        "doc_id", (remainder(folds) == held).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
