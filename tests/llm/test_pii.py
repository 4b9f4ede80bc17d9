import hashlib
import random
import re
import time

import odd
import pytest
from trailseq.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def expected(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def query(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return queries.personal_data(spark, str(tmp_path)).collect()


def test_base_spans_against_python(spark, tmp_path):
    rng = random.Random(5)
    pieces = ["a", "@", ".", "b.c", "1", "25", "+", "+1 ", "-", " ", "(", ")", "é", "😀", "4111 1111 1111 1111",
              "256.1.1.1", "x@y.z", "_", "\n", "1.2.3.4.5.6.7.8"]
    texts = {i: "".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for i in range(800)}
    texts |= {900: None, 901: "", 902: "1" * 30_000, 903: "x" * 50_000 + "@b.c", 904: "+" + "(" * 10_000 + "1"}
    rows = query(spark, tmp_path, spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    assert len(rows) == len(texts)
    for row in rows:
        want = expected(texts[row.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), texts[row.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == w[0] for w in want) for k in PATTERNS]
        assert not listed or set(listed.split(",")) <= set(row.spans.split(","))


def test_contexts_discover_identifiers(spark, tmp_path):
    rows = [(i, f"Ask us. Tel: +49 30 1234{i:03d} any time") for i in range(20)]
    rows += [(100, "Ask us. Tel: 030-5551234 any time"), (101, "In the year 030-5551234 it was so"), (102, None)]
    found = {r.doc_id: r for r in query(spark, tmp_path, spark.createDataFrame(rows, "doc_id bigint, text string"))}
    assert found[100].spans == "phone:13:24" and found[100].n_phone == 0 and found[100].n_added == 1
    assert found[101].spans == "" and all(found[i].n_phone == 1 for i in range(20))


def test_spaced_numbers_and_contexts_of_discovered_identifiers(spark, tmp_path):
    """Seeds teach 'Tel:'; what it discovers teaches 'Durchwahl' in the next round, which no seed stands next to."""
    rows = [(i, f"Ask us. Tel: +49 30 1234{i:03d} any time") for i in range(20)]
    rows += [(100 + i, f"Tel: 030 555 12{i:02d} Durchwahl") for i in range(12)]
    rows += [(200 + i, f"so it was, 040 777 34{i:02d} Durchwahl") for i in range(3)]
    rows += [(300, "from 1914 to 1918 and 12 34 56 78 9 too"), (301, "(030) 555 1234 Durchwahl")]
    found = {r.doc_id: r for r in query(spark, tmp_path, spark.createDataFrame(rows, "doc_id bigint, text string"))}
    assert all(found[100 + i].spans == "phone:5:17" for i in range(12))
    assert all(found[200 + i].spans == "phone:11:23" for i in range(3))
    assert found[301].spans == "phone:0:14" and found[300].spans == ""


def scored(texts):
    """Confidence of patterns by plain loops over the instances that the operator has found."""
    instances, words = [], {}
    for text, found in texts:
        for w in re.split(r"\s+", text):
            w = re.sub("[0-9]", "0", w.lower())
            words[w] = words.get(w, 0) + 1
        instances += [(i["kind"], i["value"], i["seed"], c) for i in found for c in i["contexts"]]
    known = {}
    for kind, value, seed, _ in instances:
        known[kind, value] = known.get((kind, value), False) or seed
    score = {k: float(s) for k, s in known.items()}
    trusted = {k for k, s in known.items() if s}
    pairs = {(k, v, c): sum(1 for x in instances if (x[0], x[1], x[3]) == (k, v, c)) for k, v, _, c in instances}
    for _ in range(pii.ROUNDS):
        confidence, count = {}, {}
        for kind, context in {(k, c) for k, _, c in pairs}:
            own = {v: n for (k, v, c), n in pairs.items() if (k, c) == (kind, context)}
            count[kind, context] = sum((kind, v) in trusted for v in own)
            if count[kind, context]:
                every = max(sum(own.values()), words.get(context[1:], 0))
                confidence[kind, context] = sum(score[kind, v] * n for v, n in own.items()) / (every + 1)
        for kind, value in known:
            if not known[kind, value]:
                miss = 1.0
                for c in {c for k, v, c in pairs if (k, v) == (kind, value)}:
                    miss *= 1 - confidence.get((kind, c), 0.0)
                score[kind, value] = 1 - miss
        trusted = {k for k in known if known[k] or score[k] >= pii.CONFIDENCE}
    return {k: v for k, v in confidence.items() if v >= pii.CONFIDENCE and count[k] >= pii.LEAST_SEEDS}


def test_pattern_scores_against_plain_loops(spark):
    rng = random.Random(11)
    cues, texts = ["Tel:", "call", "Mail", "von", "the", "fax"], []
    for _ in range(150):
        cue, seed = rng.choice([("Tel:", f"+49 30 {rng.randrange(10**6, 10**7)}"), ("Mail", f"a{rng.randrange(40)}@b.de")])
        look = rng.choice([f"030-{rng.randrange(10**6, 10**7)}", f"0{rng.randrange(10, 99)} 555 {rng.randrange(1000, 9999)}", "x", "12"])
        if rng.random() < 0.15:
            seed = look
        texts.append(" ".join([cue, seed, rng.choice(cues[1:]), rng.choice([look, "word"]), rng.choice(cues[3:])]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = pii.spans(docs)
    by_doc = {r.doc_id: r.instances for r in found.collect()}
    want = scored([(t, by_doc[i]) for i, t in enumerate(texts)])
    got = {(r.kind, r.context): r.confidence for r in pii.patterns(docs, found).collect()}
    assert got == pytest.approx(want) and want


def test_free_spans_against_all_pairs(spark):
    rng = random.Random(3)
    rows = []
    for k in range(60):
        cut = sorted(rng.sample(range(3000), 2 * rng.randrange(600)))
        spans = [(a, b, "v", "", "") for a, b in zip(cut[::2], cut[1::2])]
        taken = [(a, a + rng.randrange(1, 40)) for a in (rng.randrange(3000) for _ in range(rng.choice([0, 1, 5, 400])))]
        rows.append((k, spans, taken))
    frame = spark.createDataFrame(rows, f"k int, spans {pii._SPANS}, taken array<struct<start: int, end: int>>")
    got = {r.k: sorted((s.start, s.end) for s in r.free) for r in frame.select(
        "k", pii._free(pii.F.col("spans"), pii.F.col("taken")).alias("free")).collect()}
    assert got == {k: sorted((s[0], s[1]) for s in spans if not any(a < s[1] and s[0] < b for a, b in taken))
                   for k, spans, taken in rows}


def test_many_matches_in_one_text_take_seconds(spark):
    text = " ".join(f"w{k} 10.0.{k % 256}.{k % 250} x{k}@y.de" for k in range(30_000))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    began = time.time()
    row, = pii.find(docs).select("doc_id", *(pii.F.size(k).alias(k) for k in pii.PATTERNS)).collect()
    assert (row.email, row.ip) == (30_000, 30_000) and time.time() - began < 90


def test_odd_rows(spark):
    found = pii.find(odd.documents(spark))
    assert found.count() == len(odd.ROWS)
    assert pii.find(odd.empty(spark)).count() == 0
