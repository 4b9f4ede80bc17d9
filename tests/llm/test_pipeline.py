import os

import duckdb
import odd
import pytest
from trailseq.llm import decontaminate, langid, oracle, packing, queries

import __spark_entry__ as entry
import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.ALL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(oracle.ALL[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(str, found.fetchall()))
    got = queries.ALL[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == want


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept, with plain Python for what it must decide."""
    from test_line_dedup import brute as lines_left
    from test_minhash import brute as components_of
    from test_decontaminate import sellers
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text.encode().lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = pipeline.written_table(stage(spark, docs, SF), f"test-{name}")
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == set(before)
            assert out.groupBy("sequence_id").agg({"length": "sum"}).where(f"`sum(length)` > {packing.LENGTH}").count() == 0
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "language_id":
            model = langid.train(docs)
            want = {i: t for i, t in before.items() if any(c.isalpha() for c in t or "")
                    and model.rates([t])[0].max() >= pipeline.LEAST_SCORE}
        elif name == "line_dedup":
            left = lines_left(list(before.items()))
            want = {i: left[i] for i in before if left[i] == before[i] or left[i].split()}
        elif name == "near_duplicates":
            want = {i: t for i, t in before.items() if components_of_cached(components_of, before)[i][2]}
        else:
            want = {i: t for i, t in before.items() if not any(
                sellers(item, t.encode().lower().split()) <= decontaminate.allowed(len(item)) for item in items
                if any(w in t.lower() for w in (b" ".join(item[k:k + 4]).decode() for k in range(len(item) - 3))))}
        assert after == want, name
        docs = out


_FOUND = {}


def components_of_cached(components_of, docs):
    key = id(docs)
    if key not in _FOUND:
        _FOUND.clear()
        _FOUND[key] = components_of(list(docs.items()))
    return _FOUND[key]


def test_empty_and_odd_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, docs in (("empty", odd.empty(spark)), ("odd", odd.documents(spark))):
        docs = docs.select(*columns)
        for stage_name, stage in pipeline.STAGES:
            docs = pipeline.written_table(stage(spark, docs, str(tmp_path)), f"test-{name}-{stage_name}")
        assert docs.columns[0] == "doc_id" and (docs.count() == 0) == (name == "empty")
