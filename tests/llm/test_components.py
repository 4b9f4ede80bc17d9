import math
import random

import pytest
from trailseq.llm.components import components


@pytest.mark.parametrize("order", ["ascending", "random", "descending after the first"])
def test_chains_take_about_log_rounds(spark, order):
    n = 1000
    names = list(range(n))
    if order == "random":
        random.Random(5).shuffle(names)
    elif order != "ascending":
        names = [0, *range(n - 1, 0, -1)]
    rounds = []
    found = components(spark.createDataFrame(list(zip(names, names[1:])), "a bigint, b bigint").coalesce(1), rounds.append)
    assert {r.component for r in found.collect()} == {0} and found.count() == n
    assert rounds[-1] <= 2 * math.log2(n), rounds[-1]


def test_against_search_in_random_graphs(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(5, 5), (500, 500)]
    mates = {}
    for a, b in links:
        mates.setdefault(a, set()).add(b)
        mates.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(mates):
        if node not in want:
            open_ = [node]
            while open_:
                x = open_.pop()
                if x not in want:
                    want[x] = node
                    open_ += mates[x]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    assert {r.node: r.component for r in components(frame).collect()} == want
    assert components(frame.where("false")).count() == 0
