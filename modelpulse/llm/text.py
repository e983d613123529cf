"""Whole Arrow batches of texts as arrays: code points, words and hashes of ranges of words.

Everything here works on one batch inside a task. The hashes are polynomial ones modulo 2**64 over
mixed values, so the hash of any range comes from two prefix sums; equal ranges have equal hashes in
every task and on every machine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from modelpulse.sources.tables import load
from modelpulse.session import spread

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64
# Rows of an Arrow batch; some hundred whole texts keep a task's arrays to a few dozen megabytes.
BATCH_ROWS = 400

_powers: dict[int, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """The table of texts, over all cores, read in batches of bounded size by Python tasks."""
    bounded_batches(spark)
    return spread(load(spark, sf_dir, name))


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        _powers[base] = known
    return known[:n]


class RangeHash:
    """Hashes of any ranges [start, end) of an array of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.prefix = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * _power(_BASE, len(values)), out=self.prefix[1:])
        self.inverse = _power(_INVERSE, len(values) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inside = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix64(inside + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


@dataclass
class Batch:
    """The texts of a batch joined by line feeds, and the words in them."""

    points: np.ndarray  # code points of the joined texts
    bounds: np.ndarray  # text i is points[bounds[i] : bounds[i + 1] - 1]
    start: np.ndarray  # of every word
    end: np.ndarray
    first: np.ndarray  # words of text i are first[i] .. first[i + 1] - 1

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(self.n), self.n_words)

    def word_hashes(self) -> np.ndarray:
        return RangeHash(mix64(self.points.astype(np.uint64))).of(self.start, self.end)


def fold(points: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all else as it is."""
    return np.where((points >= 65) & (points <= 90), points + 32, points)


def is_space(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def is_separator(points: np.ndarray) -> np.ndarray:
    """Everything in ASCII but letters and digits."""
    letter = (points >= 48) & (points <= 57) | (points >= 97) & (points <= 122) | (points >= 65) & (points <= 90)
    return (points < 128) & ~letter


def read(texts: Sequence[str | None], lower: bool = False, gap=is_space) -> Batch:
    """Code points and words of the texts; a null is an empty text."""
    texts = [t or "" for t in texts]
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if lower:
        points = fold(points)
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    if not texts:
        points = points[:0]
    edge = np.diff(np.concatenate(([True], gap(points), [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return Batch(points, bounds, start, end, np.searchsorted(start, bounds))


def windows(batch: Batch, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and the places where they start."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.arange(n)
    doc = batch.doc()
    at = at[doc[:n] == doc[width - 1 :]]
    return RangeHash(hashes).of(at, at + width), at


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes in the type that Spark has for them."""
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
