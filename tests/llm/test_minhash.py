import random

import numpy as np
import odd
import pytest
from trailseq.llm import minhash
from trailseq.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    n = minhash.WORDS
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(docs):
    sets, parent = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def near_copies(seed, groups=8, size=12, edits=5):
    rng, docs = random.Random(seed), []
    for base in odd.random_texts(groups, seed=seed, words=140, vocabulary=900):
        for _ in range(size):
            words = base.split()
            for _ in range(rng.randrange(edits)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(["New", "WORDS", "here"])
            docs.append(" ".join(words))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [512, 3])
def test_components_against_all_pairs(spark, monkeypatch, block):
    """Also with chains, where most links aren't to a centre, and with buckets cut into small blocks."""
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", block)
    docs = near_copies(7, edits=9) + [(500, "a b c"), (501, "A B C"), (502, "a b c d"), (503, None), (504, ""), (505, " ")]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(docs)


def test_estimate_is_near_the_similarity():
    """Collision-corrected counts of equal bit fields against exact similarities."""
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        errors = []
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, 600).astype(np.uint64)
            n = int(600 * share)
            a, b = pool[:(600 + n) // 2], pool[(600 - n) // 2:]
            sets = [np.unique(a), np.unique(b)]
            exact = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
            words = minhash.signatures(minhash.minima(sets))
            x = words[0] ^ words[1]
            for shift in range(1, minhash.BITS):
                x = x | ((words[0] ^ words[1]) >> np.uint64(shift))
            differing = np.bitwise_count(x & minhash._FIELDS).sum() / minhash._HASHES
            errors.append((1 - differing - 1 / 16) / (1 - 1 / 16) - exact)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_connected_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {x: x for pair in links for x in pair}
    for _ in parent:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == parent
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_rows(spark):
    rows = minhash.near_duplicates(odd.documents(spark)).collect()
    assert len(rows) == len(odd.ROWS)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.component_id, r.kept, r.n_shingles > 0))
    assert by_id[1] == [(1, True, False)] and by_id[2] == [(2, True, False)] and by_id[3] == [(3, True, False)]
    assert by_id[9] == [(8, False, True)] * 2 and by_id[8] == [(8, True, True)] and by_id[7] == [(7, True, True)]
    assert sorted(by_id[None], key=str) == [(8, False, True), (None, True, False)]
    assert minhash.near_duplicates(odd.empty(spark)).count() == 0
