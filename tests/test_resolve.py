from pyspark.sql import functions as F

from trailseq.operators import resolve
from trailseq.sources import schemas

VECS = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.5, 0.5]), (4, [0.0, 0.0]), (9, [])]


def lookup(spark, rows=VECS):
    return spark.createDataFrame(rows, schemas.LOOKUP)


def histories(spark, *lists):
    return spark.createDataFrame([([i], h) for i, h in enumerate(lists)], schemas.USER_HISTORY)


def as_rows(df):
    return sorted([(e.item_id, tuple(e.vec)) for e in r.value] for r in df.collect())


def test_decode_features_gives_empty_where_the_feature_is_absent(spark):
    df = spark.createDataFrame(
        [(1, {"bert": "[1, 2.5]"}), (2, {"other": "[1]"}), (3, {}), (4, None)], schemas.FEATURE_RECORD)
    got = {r.item_id: r.vec for r in resolve.decode_features(df).collect()}
    assert got == {1: [1.0, 2.5], 2: [], 3: [], 4: []}


def test_order_repeats_misses_and_empties(spark):
    got = resolve.resolve_histories(histories(spark, [3, 7, 1, 9, 3, 2]), lookup(spark))
    assert as_rows(got) == [[(3, (0.5, 0.5)), (1, (1.0, 0.0)), (3, (0.5, 0.5)), (2, (0.0, 1.0))]]


def test_sequences_equal_after_resolving_are_one(spark):
    got = resolve.resolve_histories(histories(spark, [1, 2, 3], [1, 2, 3], [1, 7, 2, 3], [3, 2, 1]), lookup(spark))
    assert [[i for i, _ in r] for r in as_rows(got)] == [[1, 2, 3], [3, 2, 1]]


def test_too_short_after_resolving_is_dropped_and_null_history_too(spark):
    got = resolve.resolve_histories(histories(spark, [1, 2, 7, 9], None, [], [1, 2, 4]), lookup(spark))
    assert [[i for i, _ in r] for r in as_rows(got)] == [[1, 2, 4]]


def test_padded_variant_pads_misses_and_drops_empties(spark):
    got = resolve.resolve_histories_padded(histories(spark, [1, 7, 9, 2], [7, 9, 8]), lookup(spark), dim=2)
    assert as_rows(got) == [[(1, (1.0, 0.0)), (7, (0.0, 0.0)), (2, (0.0, 1.0))]]


def test_lookup_table_holds_read_items_with_a_vector(spark):
    read = histories(spark, [1, 7, 9, 2], [1, 4, 4])
    got = {r.item_id: r.vec for r in resolve.lookup_table(read, lookup(spark)).collect()}
    assert got == {1: [1.0, 0.0], 2: [0.0, 1.0], 4: [0.0, 0.0]}
    left = {r.item_id: r.vec for r in resolve.lookup_left(resolve.distinct_items(read), lookup(spark)).collect()}
    assert left == {1: [1.0, 0.0], 2: [0.0, 1.0], 4: [0.0, 0.0], 7: [], 9: []}


def test_shuffle_join_gives_the_same_rows(spark):
    lists = [[(i * k) % 11 for k in range(1, 9)] for i in range(40)]
    vectors = lookup(spark, [(i, [float(i), 1.0]) for i in range(8)])
    small = as_rows(resolve.resolve_histories(histories(spark, *lists), vectors))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert as_rows(resolve.resolve_histories(histories(spark, *lists), vectors)) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_lookup_costs_no_shuffle_of_vectors(spark):
    df = resolve.resolve_histories(histories(spark, [1, 2, 3]), lookup(spark))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert [line for line in plan.splitlines() if " Exchange " in line and "vec" in line] == []


def test_a_hot_item_does_not_change_the_result(spark):
    lists = [[1, 2, i % 3 + 1, 3] for i in range(300)] + [[1] * 5]
    got = as_rows(resolve.resolve_histories(histories(spark, *lists), lookup(spark)))
    assert sorted([i for i, _ in r] for r in got) == [[1, 1, 1, 1, 1], [1, 2, 1, 3], [1, 2, 2, 3], [1, 2, 3, 3]]


def test_shuffle_join_splits_a_hot_item(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.lit(7).cast("bigint")
        read = spark.range(6000).select(F.array(hot, "id", hot, F.col("id") + 1, hot).alias("history"))
        vectors = spark.range(6002).select(
            F.col("id").alias("item_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"))
        df = resolve.resolve_histories(read, vectors)
        rows = df.select("items").collect()
        df.collect()
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r["items"]) for r in rows} == {(7, i, 7, i + 1, 7) for i in range(6000)}
    finally:
        for key in settings:
            spark.conf.unset(key)
