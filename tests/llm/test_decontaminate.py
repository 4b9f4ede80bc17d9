import os
import random
import subprocess
import sys

import numpy as np
import odd
import pytest
from trailseq.llm import common, decontaminate


def sellers(item, words):
    before = [0] * (len(words) + 1)
    for i, x in enumerate(item):
        now = [i + 1]
        for j, y in enumerate(words):
            now.append(min(before[j] + (x != y), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_alignment_is_exact():
    rng = random.Random(3)
    for _ in range(200):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 9))])
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(14))], dtype=int)
        edits, start, length = decontaminate.align(a, b)
        assert edits == sellers(a, b)
        # the stretch found has that distance: padding it with other words can't be better
        assert sellers(a, b[start:start + length]) == edits


def keys_of(words, repetition):
    at = np.zeros(1, dtype=np.int64)
    size = np.full(1, len(words))
    return decontaminate.sample_keys(words, at, size, at, size, repetition)[0]


def test_few_edits_leave_most_keys_and_other_windows_share_none():
    rng = np.random.default_rng(0)
    same = other = 0
    for _ in range(60):
        window = common.mix(rng.integers(0, 1000, 40).astype(np.uint64))
        edited, foreign = window.copy(), common.mix(rng.integers(5000, 9000, 40).astype(np.uint64))
        edited[20] = 7
        for r in range(decontaminate.REPETITIONS):
            same += keys_of(window, r) == keys_of(edited, r)
            other += keys_of(window, r) == keys_of(foreign, r)
    assert same > 0.85 * 60 * decontaminate.REPETITIONS and other == 0


def passages(rng, size, kind, n=30):
    """n items of ``size`` words and texts that hold them with as many edits of a kind as allowed."""
    vocabulary = [f"w{i}" for i in range(3000)]
    items, texts = [[rng.choice(vocabulary) for _ in range(size)] for _ in range(n)], []
    for item in items:
        edits = decontaminate.allowed(size)
        if kind == "evenly":
            own = [rng.choice(vocabulary) if k % 5 == 4 else w for k, w in enumerate(item)]
        else:
            own, left = list(item), edits
            while left:
                at, what = rng.randrange(len(own)), kind if kind != "mixed" else rng.choice(["delete", "insert", "replace"])
                own[at:at + (what != "insert")] = [] if what == "delete" else [rng.choice(vocabulary)]
                left -= 1
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(50)] + own + [rng.choice(vocabulary) for _ in range(50)]))
    return [" ".join(i) for i in items], texts


@pytest.mark.parametrize("kind", ["delete", "insert", "replace", "mixed", "evenly"])
@pytest.mark.parametrize("size", [5, 10, 30, 60, 120, 200, 400])
def test_recall_by_size_and_kind_of_edit(size, kind):
    items, texts = passages(random.Random(size), size, kind)
    found = decontaminate.Items(list(range(len(items))), items).search(texts)
    assert sum(k in [f["item_id"] for f in of] for k, of in enumerate(found)) >= 0.9 * len(items)


def test_candidates_come_from_the_keys(monkeypatch):
    items, texts = passages(random.Random(1), 40, "mixed")
    searched = decontaminate.Items(list(range(len(items))), items)
    real, junk = decontaminate.sample_keys, np.random.default_rng(0)
    assert all(searched.search(texts))
    monkeypatch.setattr(decontaminate, "sample_keys", lambda words, start, *rest: junk.integers(
        1, 1 << 60, len(start)).astype(np.uint64))
    assert not any(searched.search(texts))
    monkeypatch.setattr(decontaminate, "sample_keys", real)


@pytest.mark.parametrize("text", ["copies", "one word"])
def test_memory_stays_bounded_where_seeds_abound(text):
    """2 MB of copies of an item, or of one word, in a process of its own."""
    code = f"""
import random, resource
from trailseq.llm import decontaminate
rng = random.Random(2)
item = " ".join("x" if {text!r} == "one word" else f"word{{rng.randrange(900)}}" for _ in range(400))
items = decontaminate.Items([1, 2], [item, "a b c d e f"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = items.search([(item + " ") * (2_000_000 // len(item))])
assert [f["item_id"] for f in found[0]] == [1] and found[0][0]["edits"] == 0
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert not out.returncode, out.stderr[-2000:]
    assert int(out.stdout) < 300_000, out.stdout


def mutated(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at:at + (kind != 1)] = [] if kind == 2 else [rng.choice(vocabulary)]
    return words


def test_recall_and_precision(spark):
    """All passages within the allowed edits are found, and nothing else, against alignments of all pairs."""
    rng = random.Random(4)
    items = [(i, t) for i, t in enumerate(odd.random_texts(12, seed=8, words=60, vocabulary=400)) if len(t.split()) >= 4]
    vocabulary = [w for _, t in items for w in t.split()]
    filler = odd.random_texts(150, seed=9, words=80, vocabulary=400)
    docs = []
    for k, text in enumerate(filler):
        words = text.split()
        if k % 2:
            _, item = rng.choice(items)
            at, own = rng.randrange(len(words) + 1), item.split()
            words[at:at] = mutated(rng, own, rng.randrange(decontaminate.allowed(len(own)) + 2), vocabulary)
        docs.append((k, " ".join(words)))
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string")).collect()
    own = {(r.doc_id, r.item_id): r.edits for r in got}
    want = {(d, i): e for d, t in docs for i, item in items
            if (e := sellers(item.split(), t.split())) <= decontaminate.allowed(len(item.split()))}
    assert len(want) > 40 and own == want


def test_blocks_and_odd_rows(spark):
    docs = odd.documents(spark)
    items = [(1, odd.SAME), (2, " ".join(odd.LONG.split()[1000:1040])), (3, None), (None, odd.SAME), (4, "a b c"), (5, ""),
             (6, odd.SAME)]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, found int")
    whole = decontaminate.mark(docs, benchmark)
    assert whole.columns == [*(c for c in docs.columns if c != "found"), "found"]
    rows = whole.collect()
    assert len(rows) == len(odd.ROWS)
    found = {r.doc_id: sorted(f.item_id for f in r.found) for r in rows if r.text != odd.SAME or r.doc_id == 8}
    assert found[8] == found[11] == [1, 6] and found[7] == [2] and found[1] == found[2] == found[None] == []
    small = decontaminate.mark(docs, benchmark, block_chars=100).collect()
    assert sorted(map(str, ((r.doc_id, sorted(r.found)) for r in small))) == sorted(
        map(str, ((r.doc_id, sorted(r.found)) for r in rows)))
    assert decontaminate.clean(docs, benchmark).columns == docs.columns
    assert decontaminate.mark(odd.empty(spark), benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.where("false")).count() == len(odd.ROWS)


def test_short_items_by_a_full_fifth_and_exactly_below_five_words():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [[rng.choice(vocabulary) for _ in range(size)] for size in range(1, 22) for _ in range(2)]
    texts = []
    for k in range(300):
        item = rng.choice(items)
        own = mutated(rng, item, rng.randrange(len(item) // 5 + 2), vocabulary)
        around = [[rng.choice(vocabulary + ["x", "y", "z"]) for _ in range(rng.randrange(6))] for _ in range(2)]
        texts.append(around[0] + own + around[1])
    got = decontaminate.Items(list(range(len(items))), [" ".join(i) for i in items]).search([" ".join(t) for t in texts])
    for text, found in zip(texts, got):
        assert {f["item_id"]: f["edits"] for f in found} == {
            k: e for k, item in enumerate(items) if (e := sellers(item, text)) <= len(item) // 5}
    at_bound = {len(items[f["item_id"]]) for found in got for f in found if f["edits"] == len(items[f["item_id"]]) // 5}
    assert at_bound >= {1, 2, 3, 5, 6, 7, 10, 11, 15}
