import itertools
import math
import zlib
from collections import Counter

import numpy as np
import odd
from trailseq.llm import hmm


def by_paths(model, symbols):
    """Likelihood and expected counts by summing over all state paths."""
    states, total = len(model.start), 0.0
    start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape)
    for path in itertools.product(range(states), repeat=len(symbols)):
        p = model.start[path[0]] * model.emit[symbols[0], path[0]]
        for t in range(1, len(symbols)):
            p *= model.move[path[t - 1], path[t]] * model.emit[symbols[t], path[t]]
        total += p
        start[path[0]] += p
        for t, s in enumerate(symbols):
            emit[s, path[t]] += p
            if t:
                move[path[t - 1], path[t]] += p
    return total, start / total, move / total, emit / total


def random_model(rng, symbols=5, states=3):
    model = hmm.Model.initial(rng.random(symbols) + 0.1, states)
    model.move = rng.random((states, states))
    model.move /= model.move.sum(axis=1, keepdims=True)
    return model


def test_forward_and_counts_against_all_paths():
    rng = np.random.default_rng(1)
    model = random_model(rng)
    texts = [rng.integers(0, 5, n) for n in (1, 5, 3, 6)]
    want = [by_paths(model, t) for t in texts]
    assert np.allclose(model.log10(texts), [math.log10(w[0]) for w in want])
    got = hmm.expected_counts(model, *hmm._stretches(texts))
    for k in range(3):
        assert np.allclose(got[k], sum(w[k + 1] for w in want), atol=1e-5)


def test_long_texts_are_cut_for_training_only():
    rng = np.random.default_rng(2)
    model, text = random_model(rng), rng.integers(0, 5, 1000)
    _, _, emissions = hmm.expected_counts(model, *hmm._stretches([text]))
    assert abs(emissions.sum() - 1000) < 0.1
    assert -2000 < model.log10([text])[0] < 0


def test_probabilities_of_short_texts_sum_to_one(spark):
    """With all words of a tiny vocabulary, and the unseen share, the model is a distribution over next symbols."""
    rng = np.random.default_rng(3)
    model = random_model(rng, symbols=4)
    total = sum(10 ** model.log10([np.array(s)])[0] for s in itertools.product(range(4), repeat=3))
    assert abs(total - 1) < 1e-9


def test_scores(spark):
    texts = odd.random_texts(150, seed=5, words=60, vocabulary=300)
    docs = [(i, t.upper() if i % 3 else t) for i, t in enumerate(texts)] + [(500, None), (501, ""), (502, odd.LONG)]
    got = {r.doc_id: r for r in hmm.score(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    words = {i: (t or "").lower().split() for i, t in docs}
    training = [i for i in words if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for i in training for w in words[i])
    n, v = sum(counts.values()) + len(training), len(counts) + 1
    for i, own in words.items():
        row, below = got[i], math.log10(n + 0.1 * (v + 1))
        base = sum(math.log10(counts[w] + 0.1) - below for w in own) + math.log10(len(training) + 0.1) - below
        assert abs(row.base_score - base) < 1e-6 * max(1, abs(base))
        assert row.n_tokens == len(own) + 1 and row.n_known == 1 + sum(counts[w] > 0 for w in own)
        assert row.train_tokens == n and row.held_out == (i not in training) and row.score < 0


def test_learns_topics(spark):
    """Two kinds of text with words of their own: the hidden states must beat the unigram base on held-out texts."""
    kinds = odd.random_texts(2, seed=1, words=40), [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(kinds[1][(i * k + i % 2 * 15) % 15 + i % 2 * 15] for k in range(1, 60))) for i in range(200)]
    got = hmm.score(spark.createDataFrame(rows, "doc_id bigint, text string"), states=4).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 5 * len(got)


def test_odd_rows(spark):
    assert hmm.score(odd.documents(spark)).count() == len(odd.ROWS)
    assert hmm.score(odd.empty(spark)).count() == 0
    untrained = hmm.score(odd.documents(spark).where("doc_id is null")).collect()
    assert all(r.held_out and r.train_tokens == 0 and r.score == r.base_score for r in untrained)
