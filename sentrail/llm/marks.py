"""A bitmap of fixed size that marks 64-bit hashes, to leave out early what can't matter later.

It is made on the executors and brought to the driver as at most 2 ** (bits - 6) pairs of numbers, 4 MB as an
array unless more bits are asked for, whatever the number of hashes. A mark that is hit by chance costs rows; what is
marked is never missed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK_BITS = 25


def collect_marks(hashes: DataFrame, mark_bits: int = MARK_BITS) -> np.ndarray:
    """The bitmap, of 2 ** ``mark_bits`` bits, of the long column ``hash``."""
    place = F.shiftrightunsigned("hash", 64 - mark_bits)
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    found = hashes.select(F.shiftrightunsigned(place, 6).alias("place"), bits.alias("bits")).groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    marks = np.zeros(1 << (mark_bits - 6), dtype=np.uint64)
    marks[found["place"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return marks


def marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned ``hashes`` are marked, or fall on the place of one that is."""
    place = hashes >> np.uint64(64 - (len(marks).bit_length() + 5))
    return (marks[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
