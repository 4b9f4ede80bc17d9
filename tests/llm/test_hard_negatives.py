import random

import pytest
from trailseq.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, anchors, positives=5, negatives=5):
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, la, va in anchors:
        scored = sorted(((-dot(va, v), i, label) for i, label, v in rows if i != a))
        for minus_p, p, _ in [s for s in scored if s[2] == la][:positives]:
            fit = [(m, i) for m, i, label in scored if label != la and 80 * -minus_p <= 100 * -m <= 100 * -minus_p]
            out |= {(a, p, k + 1, i, -minus_p, -m) for k, (m, i) in enumerate(fit[:negatives])}
    return out


def mined(spark, rows, anchors, **options):
    schema = "vec_id bigint, label bigint, q array<bigint>"
    return {tuple(r) for r in hn.mine(
        spark.createDataFrame(rows, schema), spark.createDataFrame(anchors, schema), **options).collect()}


@pytest.mark.parametrize("spread", [3, 60])
def test_against_brute_force(spark, monkeypatch, spread):
    """Small numbers give many ties; blocks, shares and chunks are cut small."""
    rng = random.Random(spread)
    rows = [(i, rng.randrange(3), [rng.randrange(-spread // 3, spread) for _ in range(4)]) for i in range(400)]
    rows += [(i, 1, [2, 2, 2, 2]) for i in range(400, 500)]  # one very common vector
    rng.shuffle(rows)
    anchors = [r for r in rows if r[0] % 20 == 0]
    want = brute(rows, anchors)
    assert mined(spark, rows, anchors) == want and want
    monkeypatch.setattr(hn, "ANCHOR_BYTES", 4 * 8 * 6)
    monkeypatch.setattr(hn, "SHARE_ROWS", 40)
    monkeypatch.setattr(hn, "CHUNK_ROWS", 7)
    assert mined(spark, rows, anchors) == want
    assert mined(spark, rows, anchors, positives=2, negatives=9) == brute(rows, anchors, 2, 9)


def test_negative_scores_few_rows_and_large_numbers(spark):
    big = 1 << 25  # squares beyond what doubles hold exactly
    rows = [(0, 1, [1, 0]), (1, 1, [-1, 0]), (2, 2, [-1, 5]), (3, 3, [1]), (100, 4, [big, 1, 3]), (101, 4, [big, 0, 1]),
            (102, 5, [big, 1, 0]), (103, 5, [big, 0, 0]), (200, 6, [1, 1])]
    anchors = [r for r in rows if r[0] % 100 == 0]
    assert mined(spark, rows, anchors) == brute(
        [(i, k, (v + [0, 0, 0])[:3]) for i, k, v in rows], [(i, k, (v + [0, 0, 0])[:3]) for i, k, v in anchors])
    assert mined(spark, rows, []) == set() == mined(spark, [], [])


def test_quantized_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [0.5, 0.5]), (3, 1, None), (4, 1, [nan, 0.0]), (5, 1, [inf, 0.0]),
            (6, 1, [0.1, None]), (7, 2, []), (None, 1, [0.5, 0.5]), (8, 3, [0.25, 0.0]), (8, 3, [0.25, 0.0]),
            (8, 2, [1.0, 1.0])]
    got = {tuple(map(str, r)) for r in hn.quantized(spark.createDataFrame(rows, SCHEMA).withColumn(
        "q", hn.F.lit("x")).withColumn("part", hn.F.lit(1))).collect()}
    assert got == {("1", "1", "[128, -1]"), ("7", "2", "[]"), ("8", "2", "[256, 256]")}
    empty = spark.createDataFrame([], SCHEMA)
    assert hn.quantized(empty).count() == 0
