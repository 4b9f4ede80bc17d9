"""Synthetic sequences with known patterns, one per row of a given key table.

Everything is computed from the key, the position and the channel, noise included: a task that runs again
gives the same rows, and only the keys are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.functions.sequences import INTERNAL_LENGTH
from trailseq.functions.vectors import DEFAULT_DIM

FILLER = 0.5
#: Values that a task draws at once.
DRAWN_VALUES = 1 << 14


def sequence_keys(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "seq_no")


def gaussian(key: Column, *parts: Column, seed: int = 0) -> Column:
    """A standard normal value that depends only on its arguments (Box-Muller on two hashes)."""
    def uniform(stream: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, *parts, F.lit(seed), F.lit(stream)), 11)
        return (bits.cast("double") + 0.5) / float(1 << 53)

    return F.sqrt(-2.0 * F.log(uniform(1))) * F.cos(2.0 * math.pi * uniform(2))


def _hashed(state: np.ndarray, value: np.ndarray | int) -> np.ndarray:
    """XXH64 of 32-bit integers seeded with ``state``: what ``xxhash64`` makes of one more argument."""
    p1, p2, p3, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    with np.errstate(over="ignore"):
        h = (state + (p5 + np.uint64(4))) ^ (np.asarray(value).astype(np.uint32).astype(np.uint64) * p1)
        h = (h << np.uint64(23) | h >> np.uint64(41)) * p2 + p3
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        return h ^ h >> np.uint64(32)


def gaussians(state: np.ndarray, length: int, dim: int, seed: int = 0) -> np.ndarray:
    """``gaussian(key, position, channel, seed=seed)`` as (keys, positions from 0, channels from 1), for hashes of keys."""
    at = _hashed(_hashed(state[:, None], np.arange(length))[:, :, None], np.arange(1, dim + 1))
    at = _hashed(at, seed)
    first, second = (((_hashed(at, k) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53) for k in (1, 2))
    return np.sqrt(-2.0 * np.log(first)) * np.cos(2.0 * math.pi * second)


def _spread(keys: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """Keys are tiny and sequences are not: spread the keys before they grow.

    A number given outright is kept by adaptive execution, which would merge partitions by key bytes.
    """
    n = partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.select(key).repartition(n, key)


def _table(keys: DataFrame, key: str, vector: Callable[[Column], Column], length: int,
           partitions: int | None) -> DataFrame:
    """``vector(position)`` for the positions 0 to ``length - 1``, without noise."""
    value = F.transform(F.sequence(F.lit(0), F.lit(length - 1)), vector)
    return _spread(keys, key, partitions).select(key, value.alias("value"))


def _noisy_table(keys: DataFrame, key: str, level: np.ndarray, divisors: tuple[np.ndarray | float, ...], dim: int,
                 seed: int, partitions: int | None, noiseless: np.ndarray | None = None) -> DataFrame:
    """``(level + noise) / divisors`` of every position and channel, divided in turn; ``noiseless`` positions hold the filler."""
    length = len(level)
    step = max(1, DRAWN_VALUES // (length * dim))

    @F.arrow_udf("array<array<double>>")
    def draw(hashes: pa.Array) -> pa.Array:
        states = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        values = np.empty((len(states), length, dim))
        for k in range(0, len(states), step):
            part = gaussians(states[k:k + step], length, dim, seed) + level[:, None]
            for divisor in divisors:
                part /= divisor
            values[k:k + step] = part
        if noiseless is not None:
            values[:, noiseless] = FILLER
        vectors = pa.ListArray.from_arrays(
            pa.array(np.arange(0, values.size + 1, dim, dtype=np.int32)), pa.array(values.reshape(-1)))
        return pa.ListArray.from_arrays(
            pa.array(np.arange(0, len(states) * length + 1, length, dtype=np.int32)), vectors)

    # nondeterministic only in name: a filter on the vectors, which posexplode brings along, would draw them again
    value = draw.asNondeterministic()(F.xxhash64(key))
    return _spread(keys, key, partitions).select(key, value.alias("value"))


def alternating(keys: DataFrame, key: str = "seq_no", validation: bool = False, dim: int = DEFAULT_DIM,
                length: int = INTERNAL_LENGTH, noise: bool = False, scaled: bool = True, seed: int = 0,
                partitions: int | None = None) -> DataFrame:
    """A falling series at odd and a rising one at even positions; validation swaps them."""
    falling_parity = 0 if validation else 1
    scale = float(length if scaled else 1)
    if noise:
        at = np.arange(length)
        level = np.where(at % 2 == falling_parity, length - at, at)
        return _noisy_table(keys, key, level, (scale,), dim, seed, partitions)

    def vector(p: Column) -> Column:
        level = F.when(p % 2 == falling_parity, F.lit(length) - p).otherwise(p)
        return F.array_repeat(level.cast("double") / scale, dim)

    return _table(keys, key, vector, length, partitions)


def uninteresting(keys: DataFrame, key: str = "seq_no", validation: bool = False, dim: int = DEFAULT_DIM,
                  length: int = INTERNAL_LENGTH, noise: bool = False, scaled: bool = True, seed: int = 0,
                  partitions: int | None = None) -> DataFrame:
    """A constant filler at odd and a rising series at even positions; validation swaps them."""
    filler_parity = 0 if validation else 1
    scale = float(length if scaled else 1)
    if noise:
        at = np.arange(length)
        return _noisy_table(keys, key, at, (scale,), dim, seed, partitions, noiseless=at % 2 == filler_parity)

    def vector(p: Column) -> Column:
        return F.array_repeat(F.when(p % 2 == filler_parity, F.lit(FILLER)).otherwise(p.cast("double") / scale), dim)

    return _table(keys, key, vector, length, partitions)


def channel_dependent(keys: DataFrame, key: str = "seq_no", validation: bool = False,
                      dim: int = DEFAULT_DIM, length: int = INTERNAL_LENGTH, noise: bool = True,
                      scaled: bool = False, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """A falling series whose scale depends on the channel, against a rising one.

    Train: falling at odd positions, divided by 3 on every third channel and by the length elsewhere;
    rising divided by the length. Validation: falling at even positions, by 3 on every fourth channel;
    rising not divided.
    """
    falling_parity, wide_every = (0, 4) if validation else (1, 3)
    base_scale = float(length if scaled else 1)
    rising_scale = base_scale * (1.0 if validation else float(length))
    of_channel = [3.0 if c % wide_every == 0 else float(length) for c in range(1, dim + 1)]
    if noise:
        at = np.arange(length)
        falls = at % 2 == falling_parity
        divisors = (np.where(falls, base_scale, rising_scale)[:, None],
                    np.where(falls[:, None], np.array(of_channel), 1.0))
        return _noisy_table(keys, key, np.where(falls, length - at, at), divisors, dim, seed, partitions)
    divisors = F.array(*[F.lit(d) for d in of_channel])

    def vector(p: Column) -> Column:
        level = (F.lit(length) - p).cast("double")
        falling = F.transform(divisors, lambda divisor: level / base_scale / divisor)
        rising = F.array_repeat(p.cast("double") / rising_scale, dim)
        return F.when(p % 2 == falling_parity, falling).otherwise(rising)

    return _table(keys, key, vector, length, partitions)
