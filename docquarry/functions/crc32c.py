"""CRC-32C of bytes, the identity that object stores give their objects.

Texts of a batch, some of them at a time, are cut into blocks of 64 bytes, whose
remainders are worked out side by side, two bytes of each at a time.  A remainder is linear in the message and
blind to leading zeros, so blocks are joined in pairs, pairs of pairs and so on,
each time after moving the left one on by the length of the right one.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: The reflected polynomial and the value before and after.
POLYNOMIAL, FLIPPED = 0x82F63B78, 0xFFFFFFFF
BLOCK = 64
#: Bytes worked on at a time, so that what is worked on stays in the caches.
TOGETHER = 1 << 20
PREFIX = "crc32c-"


@cache
def _steps() -> np.ndarray:
    """What one more zero byte makes of each low byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> 1) ^ np.where(out & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return out


@cache
def _double_steps() -> np.ndarray:
    """What two more zero bytes make of each low pair of bytes."""
    pairs, steps = np.arange(1 << 16, dtype=np.uint32), _steps()
    once = (pairs >> 8) ^ steps[pairs & 255]
    return (once >> 8) ^ steps[once & 255]


@cache
def _moves(power: int) -> np.ndarray:
    """Four tables, by byte, of what 2**power more zero bytes make of a remainder."""
    if power == 0:
        steps, every = _steps(), np.arange(256, dtype=np.uint32)
        return np.stack([steps, *(every << (8 * (k - 1)) for k in (1, 2, 3))])
    half = _moves(power - 1)
    return np.stack([_moved(half[k], power - 1) for k in range(4)])


def _moved(values: np.ndarray, power: int) -> np.ndarray:
    tables = _moves(power)
    return tables[0][values & 255] ^ tables[1][(values >> 8) & 255] ^ tables[2][(values >> 16) & 255] ^ tables[3][values >> 24]


def moved(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Remainders after as many more zero bytes as ``lengths`` says."""
    out, lengths, power = values.astype(np.uint32), lengths.copy(), 0
    while lengths.any():
        odd = (lengths & 1).astype(bool)
        out[odd] = _moved(out[odd], power)
        lengths >>= 1
        power += 1
    return out


def _joined_blocks(values: list[bytes]) -> np.ndarray:
    """The checksum of each of some values."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    blocks = -(-lengths // BLOCK)
    # each value stands at the end of its blocks, behind zeros that change nothing
    padded = b"".join(part for v in values for part in (bytes(-len(v) % BLOCK), v))
    pairs = np.ascontiguousarray(np.frombuffer(padded, "<u2").reshape(-1, BLOCK // 2).T)
    part, steps = np.zeros(len(padded) // BLOCK, np.uint32), _double_steps()
    for column in pairs:
        part = (part >> 16) ^ steps[(part ^ column) & 0xFFFF]
    power, counts = BLOCK.bit_length() - 1, blocks
    while counts.max(initial=0) > 1:
        of = np.repeat(np.arange(len(counts)), counts)
        behind = np.cumsum(counts)[of] - 1 - np.arange(len(part))  # places from the end of its text
        pair = behind // 2
        halves = -(-counts // 2)
        out = np.zeros(int(halves.sum()), np.uint32)
        target = np.cumsum(halves)[of] - 1 - pair
        right = behind % 2 == 0
        out[target[right]] = part[right]
        out[target[~right]] ^= _moved(part[~right], power)
        part, counts, power = out, halves, power + 1
    raw = np.zeros(len(lengths), np.uint32)
    raw[counts > 0] = part
    return raw ^ moved(np.full(len(lengths), FLIPPED, np.uint32), lengths) ^ np.uint32(FLIPPED)


def of_bytes(values: list[bytes]) -> np.ndarray:
    """The checksum of each value, of some MB of them at a time."""
    found, some, size = [], [], 0
    for value in values:
        some.append(value)
        size += len(value)
        if size >= TOGETHER:
            found.append(_joined_blocks(some))
            some, size = [], 0
    return np.concatenate([*found, _joined_blocks(some)])


def joined(first: int, second: int, length: int) -> int:
    """The checksum of two parts in a row, the second of ``length`` bytes."""
    return int(moved(np.array([first], np.uint32), np.array([length], np.int64))[0]) ^ second


def checksum(content: Column) -> Column:
    """CRC-32C of binary values, a batch at a time; null for null."""

    @F.pandas_udf(LongType())
    def of_batch(values: pd.Series) -> pd.Series:
        found = iter(of_bytes([c for c in values if c is not None]).tolist())
        return pd.Series([None if c is None else next(found) for c in values], dtype="Int64")

    return of_batch(content)


def identity(value: Column) -> Column:
    """How a checksum is written as the id of an object."""
    return F.concat(F.lit(PREFIX), F.lower(F.lpad(F.hex(value), 8, "0")))


def whole_checksums(parts: DataFrame, key: str, order: str) -> DataFrame:
    """``key``, ``checksum`` and ``length`` of objects whose parts come as rows with ``order``,
    ``checksum`` and ``length``: no part is read again."""

    @F.pandas_udf(LongType())
    def fold(lists: pd.Series) -> pd.Series:
        def one(found) -> int:
            total = 0
            for p in found:
                total = joined(total, int(p["checksum"]), int(p["length"]))
            return total

        return lists.map(one)

    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "checksum", "length")))
    gathered = parts.groupBy(key).agg(rows.alias("parts"), F.sum("length").alias("length"))
    return gathered.select(key, fold("parts").alias("checksum"), "length")
