import random

import odd
from trailseq.llm import line_dedup


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(before[j] + (x != y), before[j + 1] + 1, now[j] + 1))
        before = now
    return before[-1]


def brute(docs):
    """What stays of every text: lines go that equal an earlier line, or are long enough and within one edit of one."""
    lines = [(i, k, line) for i, t in docs for k, line in enumerate((t or "").split("\n")) if t is not None]
    least, out = line_dedup.LEAST_CHARS, {}
    for i, k, line in lines:
        gone = any((i2, k2) < (i, k) and (other == line != "" or (
            min(len(line), len(other)) >= least and abs(len(other) - len(line)) < 2 and distance(other, line) <= 1))
            for i2, k2, other in lines)
        out.setdefault(i, []).append(None if gone else line)
    return {i: "\n".join(x for x in parts if x is not None) for i, parts in out.items()}


def test_against_all_pairs(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abé 😀") for _ in range(rng.randrange(10, 30))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at, what = rng.randrange(len(line)), rng.randrange(3)
                line[at:at + (what != 1)] = [] if what == 2 else [rng.choice("abé 😀")]
            lines.append("".join(line))
        docs.append((i, "\n".join(lines)))
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    want = brute(docs)
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_lines == dict(docs)[r.doc_id].count("\n") + 1 for r in got)


def test_odd_rows(spark):
    docs = odd.documents(spark)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*(c for c in docs.columns if c != "n_removed"), "n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == len(odd.ROWS)
    texts = {}
    for r in rows:
        texts.setdefault(r.doc_id, []).append((r.text, r.n_removed))
    assert texts[1] == [(None, 0)] and texts[2] == [("", 0)] and texts[14] == [("a\n\nb\n\n\nc", 0)]
    assert texts[8] == [(odd.SAME, 0)] and texts[7] == [(odd.LONG, 0)]
    assert texts[9] == [("", 2)] * 2  # repeated rows don't remove each other, but 8 is earlier
    assert ("", 2) in texts[None]  # a NULL id comes last
    assert texts[15] == [("One line that is long enough to count.", 2)]
    assert line_dedup.dedup_lines(odd.empty(spark)).count() == 0


def test_short_lines_go_only_if_they_repeat_exactly(spark):
    rng = random.Random(5)
    base = ["Les.", "Let.", "a", " ", "", "elevenchars", "twelve chars", "twelve char"]
    docs = [(i, "\n".join(rng.choice(base) for _ in range(rng.randrange(1, 4)))) for i in range(12)]
    docs += [(19, "twelve chars"), (20, "new\nnew\n\n\nnews"), (21, "twelve chart"), (22, "elevenchar")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert {i: r.text for i, r in got.items()} == brute(docs)
    assert (got[20].text, got[20].n_removed) == ("new\n\n\nnews", 1)
    assert got[21].n_removed == 1 and got[22].n_removed == 0
