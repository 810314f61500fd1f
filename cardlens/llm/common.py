"""What the operators of this package share: reading, normal forms, and hashing of whole batches."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# characters (or bytes) that one numpy pass works on; a longer text is a slice of its own
SLICE = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this library to the session's Python workers, once; Spark itself carries the archive to the executors."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="package-"), os.path.basename(package))
        context.addPyFile(shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(context.applicationId)


def held_out(doc_id: Column) -> Column:
    """Rows of the test fold; a row without id is in neither fold's training set, so it counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; texts of ASCII alone take the quick way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def slices(sizes: list[int], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to ``limit`` at most, or of one longer row."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (xor-shift and multiply)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class RangeHash:
    """Polynomial hashes, modulo 2^64, of any ranges of one sequence of small integers."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, symbols: np.ndarray, seed: int):
        self.seed = seed
        base = (0x5851F42D4C957F2D + 2 * 0x9E3779B97F4A7C15 * seed) & (2**64 - 1) | 5
        self.power, self.inverse = self._tables(base, len(symbols) + 1)
        terms = mix(symbols.astype(np.uint64), seed + 101)
        terms *= self.power[: len(symbols)]
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])

    @classmethod
    def forget(cls) -> None:
        """Give back the tables that a worker keeps between tasks."""
        cls._powers.clear()

    @classmethod
    def _tables(cls, base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < size:
            room = 1 << max(10, (size - 1).bit_length())
            made = []
            for factor in (base, pow(base, -1, 2**64)):
                steps = np.full(room, factor, np.uint64)
                steps[0] = 1
                made.append(np.cumprod(steps))
            have = (made[0], made[1])
            if room <= 2 * SLICE:
                cls._powers[base] = have
        return have

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per range, of its symbols and its length."""
        value = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        value += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(value, self.seed)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
