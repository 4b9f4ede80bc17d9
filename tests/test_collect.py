from pyspark.sql import functions as F

from trailseq.operators import collect
from trailseq.plans import jobs
from trailseq.sources import json_lines, publish, schemas
from trailseq.streaming import collector


def contexts(spark, rows):
    """Rows of (ids, integers, lists)."""
    return spark.createDataFrame([((i, n, ls),) for i, n, ls in rows], schemas.EVENT_CONTEXT)


ROWS = [
    ({4: 40, 82: 820, 99: 1}, {22: 7, 141: 1}, {145: [1, 2, 3]}),
    ({}, {}, {145: [5, 5, 5, 5]}),
    ({4: 40}, {}, {145: [1, 2]}),      # too short
    ({4: 40}, {}, {145: []}),          # empty
    ({4: 40}, {}, {144: [1, 2, 3]}),   # no history
]


def collected_rows(df):
    return sorted((tuple(r.user), tuple(r.history)) for r in df.collect())


EXPECTED = sorted([
    ((40, 0, 0, 0, 0, 0, 0, 820, 7, 1), (1, 2, 3)),
    ((0,) * 10, (5, 5, 5, 5)),
])


def test_fingerprint_order_defaults_and_length_filter(spark):
    got = collect.collect_histories(contexts(spark, ROWS))
    assert got.schema.simpleString() == "struct<user:array<bigint>,history:array<bigint>>"
    assert collected_rows(got) == EXPECTED


def test_null_environment_and_null_maps_are_dropped(spark):
    df = spark.createDataFrame([(None,), ((None, None, None),)], schemas.EVENT_CONTEXT)
    assert collect.collect_histories(df).count() == 0


def test_distinct_keeps_equal_histories_of_other_readers(spark):
    df = spark.createDataFrame([([1], [1, 2, 3]), ([1], [1, 2, 3]), ([2], [1, 2, 3])], schemas.USER_HISTORY)
    assert collected_rows(collect.distinct_histories(df)) == [((1,), (1, 2, 3)), ((2,), (1, 2, 3))]


def test_last_value_per_key(spark):
    df = spark.createDataFrame([("a", [1], 1), ("a", [2], 3), ("a", [3], 2), ("b", [4], 0)],
                               "user string, history array<bigint>, at bigint")
    got = {r.user: r.history for r in collect.last_per_key(df, "user", "history", "at").collect()}
    assert got == {"a": [2], "b": [4]}


def test_stream_equals_batch_and_appends_new_files_once(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    contexts(spark, ROWS).repartition(3).write.parquet(source)
    jobs.collect_job(spark, source, out, log)
    assert collected_rows(json_lines.read_histories(spark, out)) == EXPECTED
    jobs.collect_job(spark, source, out, log)  # nothing new
    assert collected_rows(json_lines.read_histories(spark, out)) == EXPECTED
    contexts(spark, ROWS[:1]).write.mode("append").parquet(source)
    jobs.collect_job(spark, source, out, log)
    assert collected_rows(json_lines.read_histories(spark, out)) == sorted(EXPECTED + EXPECTED[1:])


def test_stream_plan_has_no_state_and_no_shuffle(spark, tmp_path):
    source = str(tmp_path / "in")
    contexts(spark, ROWS).write.parquet(source)
    query = collector.start_collector(
        collector.read_contexts(spark, source), str(tmp_path / "out"), str(tmp_path / "log"),
        fmt="parquet", available_now=True)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"] == []
    assert collected_rows(spark.read.schema(schemas.USER_HISTORY).parquet(
        *publish.data_paths(spark, str(tmp_path / "out")))) == EXPECTED
