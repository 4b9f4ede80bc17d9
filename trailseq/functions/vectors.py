"""Vector arithmetic on ``array<double>`` columns. ``dim`` is the vector length everywhere."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_DIM = 768


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    Without the binding an outer expression used in a lambda is evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def zero_vector(dim: int = DEFAULT_DIM) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def is_padding(vec: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """True for the all-zero vector of full length; an empty vector is not padding.

    Array equality is code-generated, stops at the first difference and takes -0.0 as 0.0.
    """
    return _col(vec) == zero_vector(dim)


def add_up(values: Column | str) -> Column:
    """Sum of an ``array<double>``; 0.0 when empty."""
    return F.aggregate(_col(values), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return add_up(F.zip_with(_col(a), _col(b), lambda x, y: x * y))


def squared_norm(vec: Column | str) -> Column:
    return F.aggregate(_col(vec), F.lit(0.0), lambda acc, x: acc + x * x)


def l2_norm(vec: Column | str) -> Column:
    return F.sqrt(squared_norm(vec))


def l2_normalize(vec: Column | str, floor: float = 1e-12) -> Column:
    """``v / max(|v|, floor)``; the norm is computed once per vector."""
    vec = _col(vec)
    return let(F.greatest(l2_norm(vec), F.lit(floor)), lambda n: F.transform(vec, lambda x: x / n))


def min_max_scale(vec: Column | str, low: Column, high: Column) -> Column:
    """``(x - low) / (high - low)``; NULL elements when the range is empty."""
    return F.transform(_col(vec), lambda x: F.try_divide(x - low, high - low))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; 0.0 when one of them has no length."""
    return F.coalesce(F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b)), F.lit(0.0))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    return add_up(F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)))


def hard_shrink(vec: Column | str, threshold: float) -> Column:
    """Set every element with ``abs(x) <= threshold`` to zero."""
    return F.transform(_col(vec), lambda x: F.when(F.abs(x) > threshold, x).otherwise(0.0))


def positional_features(pos: Column | str, dim: int = DEFAULT_DIM) -> Column:
    """Sine at even and cosine at odd channels of the position, wavelengths up to 10000."""
    pos = _col(pos).cast("double")

    def channel(i: Column) -> Column:
        angle = pos * F.exp((i - i % 2).cast("double") * F.lit(-math.log(10000.0) / dim))
        return F.when(i % 2 == 0, F.sin(angle)).otherwise(F.cos(angle))

    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), channel)


def add_vectors(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def first_channels(vec: Column | str, n: int = 3) -> Column:
    return F.slice(_col(vec), 1, n)


def as_float(vec: Column | str) -> Column:
    return _col(vec).cast("array<float>")


def random_user(key: Column | str, seed: int = 0, size: int = 5) -> Column:
    """Five long values per key, the same on every run."""
    return F.array(*[F.xxhash64(_col(key), F.lit(seed), F.lit(i)) for i in range(size)])
