"""Blocked Bloom filters as DataFrames of (block, word): one 64-bit word a block, two bits a key.

Built and probed with built-in expressions. A filter has at most ``2**MAX_LOG_BLOCKS`` rows
of 16 bytes, so broadcasting it has a fixed bound whatever the data; beyond that
size it only lets more keys through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LOG_BLOCKS = 21
BITS_PER_KEY = 16


def n_blocks(keys: int) -> int:
    """A power of two that gives BITS_PER_KEY bits a key, within the bound."""
    log = max(4, (max(1, keys) * BITS_PER_KEY // 64).bit_length())
    return 1 << min(log, MAX_LOG_BLOCKS)


def block_of(h: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(h, 12).bitwiseAND(F.lit(blocks - 1))


def _bits(h: Column) -> tuple[Column, Column]:
    return h.bitwiseAND(F.lit(63)).cast("int"), F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(63)).cast("int")


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def mask_of(h: Column) -> Column:
    first, second = _bits(h)
    return _one(first).bitwiseOR(_one(second))


def blocks_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """:func:`block_of` in numpy, for a filter held as an array of words."""
    return ((h.view(np.uint64) >> np.uint64(12)) & np.uint64(blocks - 1)).astype(np.int64)


def masks(h: np.ndarray) -> np.ndarray:
    """:func:`mask_of` in numpy."""
    u, one, low = h.view(np.uint64), np.uint64(1), np.uint64(63)
    return ((one << (u & low)) | (one << ((u >> np.uint64(6)) & low))).view(np.int64)


def build(keys: DataFrame, h: str, blocks: int) -> DataFrame:
    """The filter of the keys in column ``h`` (64-bit hashes)."""
    return keys.groupBy(block_of(F.col(h), blocks).alias("__block")).agg(F.bit_or(mask_of(F.col(h))).alias("__word"))


def build_repeated(keys: DataFrame, h: str, blocks: int) -> DataFrame:
    """The filter of bits that at least two rows set.

    A hash that occurs twice has both its bits here; one that occurs once has only where other
    hashes set the same bits.
    """
    first, second = _bits(F.col(h))
    # a hash whose two bits coincide sets that bit once
    bits = F.when(first == second, F.array(first)).otherwise(F.array(first, second))
    cells = keys.select(block_of(F.col(h), blocks).alias("__block"), F.explode(bits).alias("__bit"))
    twice = cells.groupBy("__block", "__bit").count().where("count > 1")
    return twice.groupBy("__block").agg(F.bit_or(_one(F.col("__bit"))).alias("__word"))


def probe(rows: DataFrame, h: str, filter_: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with boolean ``flag``: false only if the filter surely lacks column ``h``'s hash."""
    probed = rows.withColumn("__block", block_of(F.col(h), blocks)).join(F.broadcast(filter_), "__block", "left")
    hit = F.coalesce(F.col("__word").bitwiseAND(mask_of(F.col(h))) == mask_of(F.col(h)), F.lit(False))
    return probed.withColumn(flag, hit).drop("__block", "__word")
