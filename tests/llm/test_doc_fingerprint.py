import base64
import hashlib

import numpy as np
import odd
import pyarrow as pa
from trailseq.llm import doc_fingerprint as fp


def paragraphs(text):
    return set(fp.paragraphs([text])[0].tolist())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_peeling_recovers_differences():
    rng = np.random.default_rng(1)
    for n, differing in ((50, 3), (400, 300)):
        shared = rng.integers(1, 1 << 62, n).astype(np.uint64)
        extra = rng.integers(1, 1 << 62, differing).astype(np.uint64)
        a, b = np.concatenate([shared, extra[:differing // 3]]), np.concatenate([shared, extra[differing // 3:]])
        owner = lambda x: np.zeros(len(x), dtype=np.int64)
        assert fp.differences(a, owner(a), b, owner(b), 1)[0] == differing
        tables = fp.sketch(a, owner(a), 1, 1024).minus(fp.sketch(b, owner(b), 1, 1024))
        ended, found = tables.peel()
        assert ended[0] and set(np.concatenate([f[1] for f in found]).tolist()) == set(extra.tolist())


def test_stored_fingerprints_subtract():
    """The text form holds the cells: equal cells for equal texts, and it decodes to the sketch."""
    text = odd.SAME + "\n" + odd.random_texts(1, words=90)[0]
    digests, owner = fp.paragraphs([text])
    n, cells = fp.stored(digests, owner, 1)[0].split(":")
    raw = base64.b64decode(cells)
    assert int(n) == len(digests) and len(raw) == fp.HASHES * fp.STORED * 16
    count = np.frombuffer(raw[:fp.HASHES * fp.STORED * 4], dtype="<i4")
    assert count.sum() == fp.HASHES * len(digests)


def check(spark, docs):
    got = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    docs = sorted((i, t or "") for i, t in docs)
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        n = len(text) // 4
        version = text[:len(text) - n] + following[:n]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(version.encode()).hexdigest()
        assert abs(row.near_edited - jaccard(paragraphs(text), paragraphs(version))) < 1e-9
        assert abs(row.near_next - jaccard(paragraphs(text), paragraphs(following))) < 1e-9
        assert row.fingerprint == fp.stored(*fp.paragraphs([text]), 1)[0]
        assert row.edited_fingerprint == fp.stored(*fp.paragraphs([version]), 1)[0]


def test_against_plain_sets(spark):
    texts = [t.replace("a", "\n", 1) for t in odd.random_texts(120, seed=6, words=200)]
    check(spark, [(3 * i - 50, t) for i, t in enumerate(texts)] + [(1000, odd.LONG), (1001, odd.LONG), (1002, None)])
    check(spark, [(5, "only one text, which follows itself")])


def test_odd_rows(spark):
    rows = fp.fingerprints(odd.documents(spark)).collect()
    assert len(rows) == len(odd.ROWS)
    assert {r.fingerprint for r in rows if r.doc_id in (8, 9)} == {fp.stored(*fp.paragraphs([odd.SAME]), 1)[0]}
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd.ROWS)
    assert fp.fingerprints(odd.empty(spark)).count() == 0


def test_tasks_compare_little_at_once(monkeypatch):
    """Arrays of a comparison take many times its texts, and a worker that keeps them fills its executor."""
    texts = [(t + "\n") * 60 for t in odd.random_texts(400, seed=8, words=60)]
    seen, released, compare = [], [], fp.compare
    monkeypatch.setattr(fp, "compare", lambda i, t, f: seen.append(sum(map(len, t))) or compare(i, t, f))
    monkeypatch.setattr(fp.common, "release_memory", lambda: released.append(1))
    rows = pa.RecordBatch.from_pydict({"part": [0] * len(texts), "doc_id": list(range(len(texts))), "text": texts})
    got = pa.Table.from_batches(fp._within([rows]))
    assert sum(map(len, texts)) > 2_000_000 and got.column("doc_id").to_pylist() == list(range(len(texts) - 1))
    assert max(seen) <= 500_000 + max(map(len, texts)) and released == [1]
    one = fp.compare(list(range(len(texts) - 1)), texts[:-1], texts[1:])
    assert got.to_pylist() == one.to_pylist()
