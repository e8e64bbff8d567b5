"""Quality rules whose cut-offs follow the corpus: per language and source, from mergeable quantile sketches.

Every text is measured by numbers of its words, symbols and repeats. Each measure of each (lang, source) is
summarised by a sketch: counts of values rounded down to 7 significant bits. Sketches add up, so those of a
language or of everything are sums of the finer ones; a quantile read from one is at most 1/64 too low,
whatever the order or the partitions. A value beyond its group's far fence, q3 + ``reach`` * (q3 - q1), is an
outlier; the fence replaces a fixed cut-off. A group's quartiles are averaged with those of its language, which weigh as
much as ``prior`` texts, and a language's with those of the corpus: every group follows its own texts by as
much as there are, and none is taken for itself alone.

Texts that fail the base rules (under 50 words, or over half of the words repeated) are not kept and don't
shape the fences. Null text counts as empty, null lang or source is a group of its own, repeated rows are
measured each, an empty table gives an empty result, and input columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentrail.llm.arrow import add_columns, longs, without
from sentrail.llm.words import BY_SPACE, covered, split, windows
from sentrail.operators.grouped import join_small
from sentrail.session import materialise

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OWN = ("n_lines", "n_capitals")
#: fences read from the sketches: how far beyond the quartiles they are, and for how many texts the level above counts
REACH = 3
PRIOR = 400
#: narrowest spread of a measure (in its own unit): groups of near-constant values don't reject the next value
SPREAD = {"symbol_rate": 150, "repeat_rate": 1000, "line_repeat_rate": 1500, "capital_rate": 600, "word_length": 80}

_SYMBOL = np.array([chr(byte) in "#*$%&|<>" for byte in range(256)])
_CAPITAL = np.array([0x41 <= byte <= 0x5A for byte in range(256)])
_CODE_POINT = np.array([byte & 0xC0 != 0x80 for byte in range(256)])
_BLANK = b" \t\n\x0b\x0c\r"


def _per_text(mask: np.ndarray, texts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[texts[1:]] - total[texts[:-1]]


def _repeated(words) -> np.ndarray:
    """For each text, its words inside 3-word windows that the text holds twice or more."""
    key, first = windows(words.hashes(), words.of, 3)
    owner = words.owner()[first]
    order = np.lexsort((key, owner))
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    return words.per_text(covered(first[order[twice]], 3, len(words.starts)))


def _lines(words) -> tuple[list[int], list[int]]:
    lines, repeats = [], []
    for low, high in zip(words.texts[:-1], words.texts[1:], strict=True):
        full = [line for line in words.data[low:high].tobytes().split(b"\n") if line.strip(_BLANK)]
        lines.append(len(full))
        repeats.append(len(full) - len(set(full)))
    return lines, repeats


def _measures(block: pa.RecordBatch) -> list[np.ndarray]:
    words = split(block.column("text"), BY_SPACE)
    lines, repeats = _lines(words)
    inside = _CODE_POINT[words.data] & BY_SPACE[words.data]
    return [
        words.counts,
        _per_text(inside, words.texts),
        _per_text(_SYMBOL[words.data], words.texts),
        np.array(repeats, dtype=np.int64),
        _repeated(words),
        np.array(lines, dtype=np.int64),
        _per_text(_CAPITAL[words.data], words.texts),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the base and own measures of each whole text and ``base_failed``. Lazy, no shuffle."""
    measured = add_columns(without(docs, ["base_failed"]), longs(*BASE, *OWN), _measures)
    return measured.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def rates() -> dict[str, Column]:
    """Whole-number measures with a fence: shares in ten-thousandths, mean word length in hundredths."""
    return {
        "symbol_rate": F.expr("n_symbols * 10000 div greatest(word_chars, 1)"),
        "repeat_rate": F.expr("n_repeat_words * 10000 div greatest(n_words, 1)"),
        "line_repeat_rate": F.expr("n_dup_lines * 10000 div greatest(n_lines, 1)"),
        "capital_rate": F.expr("n_capitals * 10000 div greatest(word_chars, 1)"),
        "word_length": F.expr("word_chars * 100 div greatest(n_words, 1)"),
    }


def _rounded(value: Column) -> Column:
    """A whole number rounded down to 7 significant bits."""
    shift = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 7, F.lit(0))).cast("long")
    return value - F.pmod(value, shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Mergeable quantile sketches of every (lang, source): lang, source, measure, bucket, n."""
    pairs = [F.struct(F.lit(name).alias("measure"), _rounded(rate).alias("bucket")) for name, rate in rates().items()]
    passed = measured.filter(~F.col("base_failed")).select("lang", "source", F.explode(F.array(*pairs)).alias("m"))
    return passed.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def _level(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Number of texts, first and third quartile of each group of ``keys`` and measure."""
    by = [*keys, "measure"]
    merged = sketch.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by).orderBy("bucket")
    running = merged.select(
        *by, "bucket", F.sum("n").over(order).alias("up_to"), F.sum("n").over(Window.partitionBy(*by)).alias("total")
    )
    at = lambda share: F.min(F.when(F.col("up_to") * 4 >= F.col("total") * share, F.col("bucket")))
    return running.groupBy(*by).agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))


def fences(sketch: DataFrame, reach: int = REACH, prior: int = PRIOR) -> DataFrame:
    """One row per (lang, source) with the highest value that passes, for every measure. Whole numbers throughout."""
    spread = F.create_map(*[F.lit(x) for pair in SPREAD.items() for x in pair])

    def blended(own: DataFrame, above: DataFrame, by: list[str]) -> DataFrame:
        """Quartiles of ``own`` and ``above``, averaged by numbers of texts."""
        renamed = above.select(*[F.col(c).alias(f"_{c}") for c in (*by, "measure")], F.col("q1").alias("_q1"), F.col("q3").alias("_q3"))
        same = own["measure"] == renamed["_measure"]
        for c in by:
            same = same & own[c].eqNullSafe(renamed[f"_{c}"])
        joined = own.join(renamed, same)
        return joined.select(*own.columns[:-2], *[F.expr(f"(total * {q} + {prior}L * _{q}) div (total + {prior}L)").alias(q) for q in ("q1", "q3")])

    lang = blended(_level(sketch, ["lang"]), _level(sketch, []), [])
    own = blended(_level(sketch, ["lang", "source"]), lang, ["lang"])
    fence = F.col("q3") + reach * F.greatest(F.col("q3") - F.col("q1"), spread[F.col("measure")])
    return own.withColumn("fence", fence).groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == name, F.col("fence"))).alias(f"most_{name}") for name in SPREAD])


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with ``kept``: it passes the base rules and no measure lies beyond its group's fence.

    ``limits`` comes from ``materialise``; it is broadcast only where its counted size allows.
    """
    tagged = limits.select(F.to_json(F.struct("lang", "source")).alias("_group"), *[f"most_{name}" for name in SPREAD])
    tagged = materialise(tagged, "fences")
    joined = join_small(measured.withColumn("_group", F.to_json(F.struct("lang", "source"))), tagged, ["_group"], "left")
    within = [F.coalesce(rate <= F.col(f"most_{name}"), F.lit(True)) for name, rate in rates().items()]
    passed = within[0]
    for test in within[1:]:
        passed = passed & test
    kept = joined.withColumn("kept", ~F.col("base_failed") & passed)
    return kept.drop("_group", *[f"most_{name}" for name in SPREAD])


def adaptive_filter(docs: DataFrame, reach: int = REACH, prior: int = PRIOR) -> DataFrame:
    """``docs`` with measures and verdict. Two passes over the texts: one for the sketches, one lazy for the verdicts."""
    docs = without(docs, ["kept"])
    sketch = materialise(sketches(measure(docs.select("text", "lang", "source"))), "quality_sketches")
    return judge(measure(docs), fences(sketch, reach, prior))


def quality_report(docs: DataFrame, reach: int = REACH, prior: int = PRIOR) -> DataFrame:
    """Measures and verdict of every text, without the texts: they are read once and their measures written."""
    measured = materialise(measure(docs).select("doc_id", "lang", "source", *BASE, *OWN, "base_failed"), "quality_measures")
    sketch = materialise(sketches(measured), "quality_sketches")
    return judge(measured, fences(sketch, reach, prior))
