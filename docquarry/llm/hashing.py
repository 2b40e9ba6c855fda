"""Word hashes and fixed-size bit filters shared by the scanning operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xBF58476D1CE4E5B9)
#: Words remembered by one task; beyond it the memory starts afresh.
WORDS_KEPT = 500_000


class WordHashes(dict):
    """64-bit hashes of words, remembered within a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * M2
    return h ^ (h >> np.uint64(29))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` word hashes; none if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, width):
        total = total * M1 + hashes[k : k + n]
    return mix(total)


#: A filter has at least and at most so many bits (512 KB, 8 MB), 16 a value in between.
LEAST_BITS, MOST_BITS = 1 << 22, 1 << 26


def bit_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """Packed bits that are set for the hashes in ``column``.

    The bits are put together by the executors; what reaches the driver is at
    most MOST_BITS, whatever the input.  A filter that fills up lets more
    through; whoever uses it joins exactly afterwards.
    """
    bits, wanted = LEAST_BITS, 16 * hashes.count()
    while bits < MOST_BITS and bits < wanted:
        bits *= 4
    at = F.col(column).bitwiseAND(bits - 1)
    words = (
        hashes.select(F.shiftright(at, 5).cast("int").alias("w"), F.expr(f"shiftleft(1L, int({column} & 31))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toPandas()
    )
    packed = np.zeros(bits // 32, np.uint32)
    packed[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return packed


def in_filter(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(len(packed) * 32 - 1)).astype(np.int64)
    return (packed[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def signed(hashes: np.ndarray) -> np.ndarray:
    """As Spark's long."""
    return hashes.view(np.int64)
