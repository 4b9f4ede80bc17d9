"""Exact order statistics and quantiles of a column that is not counted, without sorting it.

Doubles are mapped to whole numbers of the same order. A round counts, in arrays, the next 16 bits of all
numbers that agree with a wanted rank's bits so far, so a task sends one row per rank and value of the bits that it has
seen; the counts say where the rank goes on. Four rounds fix all 64 bits, however the numbers are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16


def _ordered(numbers: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; -0.0 counts as 0.0, NaN as the largest."""
    bits = (numbers + 0.0).view(np.uint64)
    negative = bits >> np.uint64(63) == 1
    return np.where(negative & ~np.isnan(numbers), ~bits, bits | np.uint64(1 << 63))


def _double(ordered: int) -> float:
    bits = ordered ^ (1 << 63) if ordered >> 63 else ~ordered & ((1 << 64) - 1)
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def order_statistics(rows: DataFrame, value: str, ranks: list[int]) -> list[float]:
    """The numbers with the given ranks (from 0) among those of ``value`` that aren't NULL; ``rows`` is read four times."""
    numbers = rows.select(F.col(value).cast("double").alias("x")).where("x is not null")
    prefix, left = [0] * len(ranks), list(ranks)
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        wanted = sorted(set(prefix))

        def count(batches: Iterator[pa.RecordBatch], wanted=wanted, shift=shift) -> Iterator[pa.RecordBatch]:
            total = {p: np.zeros(1 << DIGIT_BITS, dtype=np.int64) for p in wanted}
            for batch in batches:
                ordered = _ordered(batch.column(0).to_numpy(zero_copy_only=False))
                high, above = ordered >> np.uint64(shift), shift + DIGIT_BITS
                for p, counts in total.items():
                    # a shift by all 64 bits isn't defined
                    same = high if above == 64 else high[high >> np.uint64(DIGIT_BITS) == np.uint64(p)]
                    counts += np.bincount((same & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64), minlength=len(counts))
            for p, counts in total.items():
                digits = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({
                    "prefix": pa.array([str(p)] * len(digits), pa.string()), "digit": pa.array(digits), "n": pa.array(counts[digits])})

        table: dict[int, list[tuple[int, int]]] = {}
        for r in numbers.mapInArrow(count, "prefix string, digit bigint, n bigint").groupBy("prefix", "digit").agg(
                F.sum("n").alias("n")).collect():
            table.setdefault(int(r["prefix"]), []).append((r["digit"], r["n"]))
        for k, rank in enumerate(left):
            for digit, n in sorted(table.get(prefix[k], ())):
                if rank < n:
                    prefix[k], left[k] = prefix[k] << DIGIT_BITS | digit, rank
                    break
                rank -= n
            else:
                raise ValueError(f"there is no rank {ranks[k]}")
    return [_double(p) for p in prefix]


def quantiles(rows: DataFrame, value: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles, interpolated between neighbours; None without numbers. ``rows`` should be stored."""
    n = rows.where(F.col(value).isNotNull()).count()
    if not n:
        return [None] * len(shares)
    places = [share * (n - 1) for share in shares]
    low = [int(p) for p in places]
    found = order_statistics(rows, value, [*low, *(min(k + 1, n - 1) for k in low)])
    return [a + (p - k) * (b - a) for a, b, p, k in zip(found, found[len(low):], places, low)]
