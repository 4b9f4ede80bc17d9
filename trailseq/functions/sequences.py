"""Ordered work inside one array column (a history or a sequence of vectors); no shuffle anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailseq.functions.vectors import _col, add_vectors, is_padding, zero_vector

SEQ_LENGTH = 16
INTERNAL_LENGTH = SEQ_LENGTH + 2


def take_last(values: Column | str, n: int) -> Column:
    values = _col(values)
    return F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), F.lit(n))


def padding_mask(value: Column | str, dim: int) -> Column:
    return F.transform(_col(value), lambda v: is_padding(v, dim))


def last_real_index(mask: Column | str) -> Column:
    """1-based index of the last non-padding element, 0 when there is none."""
    ends = F.transform(_col(mask), lambda m, i: F.when(m, F.lit(0)).otherwise(i + 1))
    return F.coalesce(F.array_max(ends), F.lit(0))


def count_real(mask: Column | str) -> Column:
    return F.size(F.filter(_col(mask), lambda m: ~m))


def drop_trailing_padding(value: Column | str, mask: Column | str) -> Column:
    return F.slice(_col(value), F.lit(1), last_real_index(mask))


def left_pad(value: Column | str, n: int, dim: int) -> Column:
    value = _col(value)
    missing = F.greatest(F.lit(n) - F.size(value), F.lit(0))
    return F.concat(F.array_repeat(zero_vector(dim), missing), value)


def remove_padding(value: Column | str, dim: int) -> Column:
    """Drop padding vectors wherever they stand."""
    return F.filter(_col(value), lambda v: ~is_padding(v, dim))


def vectors_of(value: Column | str) -> Column:
    """Resolved ``(item_id, vec)`` pairs to their vectors."""
    return F.transform(_col(value), lambda e: e["vec"])


def encoder_source(value: Column | str, seq_length: int = SEQ_LENGTH) -> Column:
    return F.slice(_col(value), 1, seq_length)


def decoder_source(value: Column | str, decoder_length: int = SEQ_LENGTH,
                   seq_length: int = SEQ_LENGTH) -> Column:
    return F.slice(_col(value), seq_length + 2 - decoder_length, decoder_length)


def target(value: Column | str, decoder_length: int = SEQ_LENGTH,
           seq_length: int = SEQ_LENGTH) -> Column:
    return F.slice(_col(value), seq_length + 3 - decoder_length, decoder_length)


def decoder_mask(mask: Column | str, seq_length: int = SEQ_LENGTH) -> Column:
    """The part of a padding mask that lines up with the full-length decoder source."""
    return F.slice(_col(mask), 2, seq_length)


def running_mean(value: Column | str, dim: int) -> Column:
    """Element j becomes the mean of the vectors 0..j, one pass per row."""
    start = F.struct(
        zero_vector(dim).alias("total"),
        F.array().cast("array<array<double>>").alias("means"),
    )

    def step(acc: Column, vec: Column) -> Column:
        total = add_vectors(acc["total"], vec)
        n = (F.size(acc["means"]) + 1).cast("double")
        mean = F.zip_with(acc["total"], vec, lambda x, y: (x + y) / n)
        return F.struct(total.alias("total"), F.concat(acc["means"], F.array(mean)).alias("means"))

    return F.aggregate(_col(value), start, step, lambda acc: acc["means"])
