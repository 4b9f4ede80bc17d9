import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailseq.operators import profile
from trailseq.plans import jobs

RNG = random.Random(3)
LISTS = [[RNG.randint(1, 3) for _ in range(RNG.randint(1, 9))] for _ in range(301)]


@pytest.fixture(scope="module")
def histories(spark):
    return spark.createDataFrame([(h,) for h in LISTS], "history array<bigint>")


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "id int, vec array<double>")


def test_length_stats(histories):
    lengths = [len(h) for h in LISTS]
    row = profile.history_length_stats(histories).first()
    assert (row.n, row.median_length) == (301, statistics.median(lengths))
    assert row.mean_length == pytest.approx(statistics.mean(lengths))


def test_even_count_median_interpolates(spark):
    df = spark.createDataFrame([([1],), ([1, 2],)], "history array<bigint>")
    assert profile.history_length_stats(df).first().median_length == 1.5


def test_unique_ratio_and_stats(histories):
    unique = {tuple(h) for h in LISTS}
    row = profile.unique_history_ratio(histories).first()
    assert (row.n_unique, row.n_all) == (len(unique), 301)
    assert row.ratio == pytest.approx(len(unique) / 301)
    stats = profile.unique_history_stats(histories).first()
    assert stats.mean_length == pytest.approx(statistics.mean(len(h) for h in unique))


def test_empty_input_gives_nulls(spark):
    df = spark.createDataFrame([], "history array<bigint>")
    assert tuple(profile.history_length_stats(df).first()) == (0, None, None)
    assert tuple(profile.unique_history_ratio(df).first())[:3] == (0, 0, None)


def test_unpadded_lengths(spark):
    rows = [([[0.0, 0.0], [1.0, 0.0], [0.0, 0.0], [2.0, 2.0]],), ([[0.0, 0.0]],)]
    df = spark.createDataFrame(rows, "value array<array<double>>")
    assert tuple(profile.unpadded_length_stats(df, 2).first()) == (2, 1.0, 1.0)


def test_channel_range_sums_and_scaling(spark):
    df = vectors(spark, [[1, -2, 3], [0.5, 0, 2]])
    row = profile.channel_range(df).first()
    assert (row.min_channel, row.max_channel) == (-2.0, 3.0)
    assert {r.id: r.channel_sum for r in profile.vector_sums(df).collect()} == {0: 2.0, 1: 2.5}
    got = {r.id: r.channel_sum for r in profile.normalized_sums(df).collect()}
    assert got == pytest.approx({0: (2 + 6) / 5, 1: (2.5 + 6) / 5})


def test_scaling_with_equal_channels_is_null(spark):
    assert profile.normalized_sums(vectors(spark, [[1, 1]])).first().channel_sum is None


@pytest.mark.parametrize("bins", [1, 7, 10])
def test_histogram_matches_numpy(spark, bins):
    values = [RNG.gauss(0, 3) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    counts, edges = np.histogram(values, bins)
    got = {r.bin: (r.n, r.bin_low, r.bin_high) for r in profile.histogram(df, "x", bins).collect()}
    for i, n in enumerate(counts):
        if n:
            assert got[i][0] == n and got[i][1:] == pytest.approx((edges[i], edges[i + 1]))
        else:
            assert i not in got


def test_auto_bins_match_numpy(spark, histories):
    lengths = [len(h) for h in LISTS]
    edges = np.histogram_bin_edges(np.array(lengths, float), "auto")
    counts = profile.length_counts(histories)
    got = profile.histogram(counts, "length", "auto", n="n").collect()
    assert got[0].bin_high - got[0].bin_low == pytest.approx(edges[1] - edges[0])
    assert sum(r.n for r in got) == 301


def test_histogram_of_one_value_and_given_edges(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    row = profile.histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r.bin, r.bin_low, r.bin_high, r.n) for r in row] == [(0, 1.5, 2.0, 0), (1, 2.0, 2.5, 5)]
    row = profile.histogram(df, "x", 4, low=0, high=4).orderBy("bin").collect()
    assert [(r.bin, r.bin_low, r.bin_high, r.n) for r in row] == [
        (0, 0.0, 1.0, 0), (1, 1.0, 2.0, 0), (2, 2.0, 3.0, 5), (3, 3.0, 4.0, 0)]


@pytest.mark.parametrize("cut", [0.0, 3.0])
def test_density_matches_the_formula(spark, histories, cut):
    x = np.array([len(h) for h in LISTS], float)
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - cut * h, x.max() + cut * h, 50)
    expected = np.exp(-0.5 * ((grid[:, None] - x[None]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    rows = profile.kernel_density(profile.length_counts(histories), "length", 50, n="n", cut=cut)
    got = sorted((r.grid_no, r.x, r.density) for r in rows.collect())
    assert [r[1] for r in got] == pytest.approx(list(grid))
    assert [r[2] for r in got] == pytest.approx(list(expected))


def test_profile_jobs_run(spark, histories):
    tables = jobs.profile_histories(histories)
    assert sum(r.n for r in tables["unique_histogram"].collect()) == tables["unique_ratio"].first().n_unique
    values = spark.createDataFrame([([[0.0, 0.0], [1.0, 3.0], [2.0, 2.0]],)] * 3, "value array<array<double>>")
    tables = {k: v.collect() for k, v in jobs.profile_sequences(values, 2, bins=4).items()}
    assert sum(r.n for r in tables["channel_histogram"]) == 12
    assert sum(r.n for r in tables["normalized_sum_histogram"]) == 6
