import itertools
import random
import re
from collections import Counter

import odd
import pytest
from trailseq.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int, text string"


def masks(docs, labels):
    out = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)}
        mine = [(q, x) for j, q, x in labels if j == i and i is not None]
        out.append((source or "", {k for k in fails if fails[k]}, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    return out


def walked(rows, filters="ABCDE"):
    """Every order applied to the rows one by one."""
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations(filters)):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                shapley[letter] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(letter in r[1] for r in own) - len(gone), sum(r[1] == {letter} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_against_every_order(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["One", "two", "three", "f#ur", "Five", "six", "é"][:rng.randrange(1, 8)]) + rng.choice(["", str(k)])
                      for k in range(rng.randrange(80))) for _ in range(60)]
    docs = [(i, rng.choice(texts), rng.choice(["x", "y", None])) for i in range(150)]
    docs += [(None, texts[0], "x"), (3, texts[1], "z"), (3, texts[1], "z"), (900, None, "x"), (901, "", "x")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 150, 2)] + [(4, 1, None), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, True) for d in docs], "doc_id bigint, text string, source string, failed int, good boolean")
    failed = filter_audit.failures(frame, spark.createDataFrame([(*x, "t") for x in labels], LABELS))
    got = {tuple(r) for r in filter_audit.audit(failed).collect()}
    assert got == walked(masks(docs, labels))


def test_other_numbers_of_filters(spark):
    rows = [("p", m, m % 2 == 0, m == 3) for m in range(8) for _ in range(m + 1)]
    failed = spark.createDataFrame(rows, "part string, failed int, good boolean, toxic boolean")
    as_sets = [(p, {x for k, x in enumerate("xyz") if m >> k & 1}, g, t) for p, m, g, t in rows]
    assert {tuple(r) for r in filter_audit.audit(failed, "xyz").collect()} == walked(as_sets, "xyz")
    one = filter_audit.audit(failed.selectExpr("part", "failed & 1 AS failed", "good", "toxic"), "x").collect()
    assert len(one) == 1 and one[0].removed == one[0].shapley == one[0].unique_fails
    with pytest.raises(ValueError, match="different"):
        filter_audit.audit(failed, "aa")


def test_odd_rows(spark):
    docs = odd.documents(spark)
    none = spark.createDataFrame([], LABELS)
    got = filter_audit.audit(filter_audit.failures(docs, none)).collect()
    assert len(got) == 600 and all(r.kept + r.removed <= len(odd.ROWS) for r in got)
    assert {tuple(r) for r in got} == walked(masks([(i, t, "src") for i, t, _ in odd.ROWS], []))
    assert filter_audit.audit(filter_audit.failures(odd.empty(spark), none)).count() == 0
