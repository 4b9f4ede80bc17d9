import random

import pytest

import odd
from trailseq.llm import substring_dedup


def brute(docs):
    first, out = {}, {}
    n = substring_dedup.WINDOW
    words = {i: t.encode().split() for i, t in docs}
    for i in sorted(words):
        for k in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][k:k + n]), i)
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < i:
                gone[k:k + n] = [True] * n
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("group", [20_000, 2])
def test_against_brute_force(spark, monkeypatch, group):
    """With and without lengthened keys."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rng = random.Random(group)
    base = odd.random_texts(12, seed=4, words=120, vocabulary=9)
    docs = []
    for i in range(70):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choice(base).split()
            a = rng.randrange(len(w) + 1)
            parts += w[a:a + rng.randrange(5, 60)]
        docs.append((i, " ".join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, "x " * 200), (103, "x " * 90)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got} == brute(docs)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == [*(c for c in docs.columns if c != "n_removed"), "n_words", "n_removed"]
    rows = got.collect()
    assert len(rows) == len(odd.ROWS)
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append((r.text, r.n_words, r.n_removed))
    assert texts[1] == texts[2] == texts[3] == [("", 0, 0)]
    n = len(odd.SAME.split())
    assert texts[8] == [(" ".join(odd.SAME.split()), n, 0)]
    assert texts[9] == [("", n, n)] * 2 and ("", n, n) in texts[None]
    assert texts[11][0][2] == n and texts[7][0][1] == len(odd.LONG.split())
    assert substring_dedup.remove_repeats(odd.empty(spark)).count() == 0
