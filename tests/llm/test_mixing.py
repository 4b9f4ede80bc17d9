import re
from math import exp, log

import pytest
import odd
from trailseq.llm import mixing

SCHEMA = "doc_id bigint, text string, source string"


def shares(sources, weights=mixing.WEIGHTS, most=3):
    """Targets by resharing the excess again and again; ``sources`` holds sizes in the order of the sources."""
    target = [0.0] * len(sources)
    open_, rest = set(range(len(sources))), float(sum(sources))
    while open_:
        total = sum(weights[k % len(weights)] for k in open_)
        full = [k for k in open_ if most * sources[k] <= rest * weights[k % len(weights)] / total]
        for k in full or open_:
            target[k] = most * sources[k] if full else rest * weights[k % len(weights)] / total
        if not full:
            break
        open_ -= set(full)
        rest -= sum(target[k] for k in full)
    return target


def balanced(sizes, target, most=3):
    """Rates by bisection for the one multiplier."""
    total = lambda m: sum(s * min(most, exp(min(m * s, 2))) for s in sizes)
    least = min(s for s in sizes if s)
    low, high = min(0, log(target / sum(sizes)) / least), log(most) / least
    for _ in range(300):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < target else (low, middle)
    return [min(most, exp(min(high * s, 2))) for s in sizes]


def docs_of(spark, plan):
    rows = [(1000 * k + i, " ".join(["w"] * n), source) for k, (source, sizes) in enumerate(plan) for i, n in enumerate(sizes)]
    return spark.createDataFrame(rows, SCHEMA)


PLAN = [("b", [40, 30, 30, 5, 5, 5, 1, 1, 1, 0]), ("a", [3, 2, 1, 1]), (None, [100, 90, 7, 6, 5, 4, 3, 2, 1, 1]),
        ("c", [200, 50, 50, 50, 11, 11, 11, 3, 2, 1]), ("ä", [0, 0]), ("Z", [10] * 30)]


def test_targets_rates_and_copies(spark):
    got = mixing.mix(docs_of(spark, PLAN)).collect()
    in_order = sorted(PLAN, key=lambda p: (p[0] is None, (p[0] or "").encode()))
    want = dict(zip([p[0] for p in in_order], shares([sum(p[1]) for p in in_order])))
    rows = {r.doc_id: r for r in got}
    assert len(got) == sum(len(p[1]) for p in PLAN)
    for k, (source, sizes) in enumerate(PLAN):
        own = [rows[1000 * k + i] for i in range(len(sizes))]
        assert [r["size"] for r in own] == sizes and {r.source_size for r in own} == {sum(sizes)}
        assert all(r.target == pytest.approx(want[source]) for r in own)
        assert all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in own)
        assert abs(sum(r.taken for r in own) - want[source]) <= max(1, min([s for s in sizes if s], default=0) / 2)
        if 0 < want[source] < 3 * sum(sizes):
            # small documents make up for what large ones are rounded by, so only these are near their rates
            rates = balanced(sizes, want[source])
            assert all(abs(r.copies - rate) < 1.6 for r, rate in zip(own, rates) if r["size"] >= max(sizes) / 4)


def test_multipliers_solve_the_dual(spark):
    cells = spark.createDataFrame([(f"={k}", s, n) for k, of in enumerate(
        [[(1, 50), (7, 9), (400, 2)], [(1000, 1), (1, 1)], [(5, 10)], [(3, 4), (20_000, 1), (100, 30)]])
        for s, n in of], "source_key string, size bigint, n bigint")
    goals = mixing.targets(cells)
    solved = {r.source_key: r for r in mixing.multipliers(cells, goals).collect()}
    for key, of in cells.toPandas().groupby("source_key"):
        row = solved[key]
        if row.multiplier == float("inf"):
            assert row.target == 3 * row.source_size
        else:
            total = sum(n * s * min(3.0, exp(min(2, row.multiplier * s))) for s, n in zip(of["size"], of["n"]))
            assert total == pytest.approx(row.target, rel=1e-6)


def test_copies_of_equal_sizes_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED_ROWS", 16)  # pieces within one size
    docs = docs_of(spark, [("a", [10] * 300), ("b", [10] * 301), ("c", [9] * 100)]).repartition(5)
    got = mixing.mix(docs).collect()
    for k in range(3):
        own = [r.copies for r in got if r.doc_id // 1000 == k]
        assert max(own) - min(own) <= 1
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_odd_rows(spark):
    docs = odd.documents(spark).withColumn("size", mixing.F.lit(5)).withColumn("copies", mixing.F.lit("x"))
    got = mixing.mix(docs).collect()
    assert len(got) == len(odd.ROWS)
    words = {i: len(re.findall(mixing.WORD, t or "")) for i, t, _ in odd.ROWS}
    assert all(r["size"] in (words[r.doc_id], 0) for r in got if r.doc_id is not None)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix(odd.empty(spark)).count() == 0
    bare = spark.createDataFrame([(1, None, None), (2, "", "a"), (None, " ", "a")], SCHEMA)
    assert {(r["size"], r.target, r.taken) for r in mixing.mix(bare).collect()} == {(0, 0.0, 0)}
