"""Every query of the core against its SQL on the smallest tables; optional subpackages test their own."""

import pytest

import __spark_entry__ as spark_entry
import check
from trailseq.plans import queries

TABLES = spark_entry.ENTRY_TABLES


@pytest.fixture(scope="module")
def con():
    return check.connect(TABLES)


@pytest.mark.parametrize("name", sorted(queries.ALL))
def test_query_matches_sql(spark, con, name):
    status, n, _, _ = check.compare(spark, con, name, TABLES)
    assert status in ("ok", "rows-only") and n > 0


def test_names_agree_and_entry_runs(spark):
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    df = spark_entry.entry(spark)
    assert df.columns == ["seq_id", "pos", "pred_item", "true_item", "similarity"] and df.count() > 0
