import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailseq.functions import vectors as V


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else
                                 F.array(*[F.lit(float(x)) for x in v]).cast("array<double>").alias(k)
                                 for k, v in values.items()])
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize("vec,expected", [
    ([0.0, 0.0, 0.0], True), ([-0.0, 0.0, 0.0], True), ([0.0, 1e-300, 0.0], False), ([], False), ([0.0, 0.0], False),
])
def test_padding_is_the_full_length_zero_vector(spark, vec, expected):
    assert one(spark, V.is_padding("v", 3), v=vec) is expected


def test_l2_normalize_and_its_floor(spark):
    assert one(spark, V.l2_normalize("v"), v=[3.0, 4.0]) == pytest.approx([0.6, 0.8])
    assert one(spark, V.l2_normalize("v"), v=[0.0, 0.0]) == [0.0, 0.0]
    assert one(spark, V.l2_normalize("v"), v=[1e-13, 0.0]) == pytest.approx([0.1, 0.0])


def test_min_max_scale_of_an_empty_range_is_null(spark):
    assert one(spark, V.min_max_scale("v", F.lit(1.0), F.lit(3.0)), v=[1.0, 2.0, 3.0]) == [0.0, 0.5, 1.0]
    assert one(spark, V.min_max_scale("v", F.lit(1.0), F.lit(1.0)), v=[1.0, 1.0]) == [None, None]


def test_cosine_with_a_zero_vector_is_zero(spark):
    assert one(spark, V.cosine_similarity("a", "b"), a=[1.0, 1.0], b=[2.0, 2.0]) == pytest.approx(1.0)
    assert one(spark, V.cosine_similarity("a", "b"), a=[0.0, 0.0], b=[2.0, 2.0]) == 0.0


def test_hard_shrink_keeps_only_what_exceeds_the_threshold(spark):
    assert one(spark, V.hard_shrink("v", 0.01), v=[0.01, -0.01, 0.011, -2.0]) == [0.0, 0.0, 0.011, -2.0]


def test_positional_features_match_the_formula(spark):
    got = one(spark, V.positional_features(F.lit(5), 6))
    angles = [5 * math.exp(-(i - i % 2) * math.log(10000.0) / 6) for i in range(6)]
    assert got == pytest.approx([math.sin(a) if i % 2 == 0 else math.cos(a) for i, a in enumerate(angles)])


def test_float_cast_and_slice(spark):
    assert one(spark, V.as_float("v"), v=[1e-60, 1.5]) == [0.0, 1.5]
    assert one(spark, V.first_channels("v", 3), v=[1.0, 2.0, 3.0, 4.0]) == [1.0, 2.0, 3.0]


def test_random_users_are_repeatable(spark):
    users = [tuple(r.u) for r in spark.range(50).select(V.random_user("id").alias("u")).collect()]
    again = [tuple(r.u) for r in spark.range(50).repartition(3).select(V.random_user("id").alias("u")).collect()]
    assert all(len(u) == 5 for u in users) and len(set(users)) == 50 and set(users) == set(again)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(-9, 9), st.floats(-9, 9)), min_size=1, max_size=8))
def test_distances_match_numpy(spark, pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert one(spark, V.squared_distance("a", "b"), a=a, b=b) == pytest.approx(
        float(((np.array(a) - np.array(b)) ** 2).sum()))
    assert one(spark, V.dot("a", "b"), a=a, b=b) == pytest.approx(float(np.dot(a, b)))
    assert one(spark, V.l2_norm("a"), a=a) == pytest.approx(float(np.linalg.norm(a)))
