import random

import pytest
from pyspark.sql import functions as F

from trailseq.functions import sequences as S
from trailseq.operators import numbering, prepare

D = 2
PAD = (0.0, 0.0)


def seqs(spark, lists):
    rows = [(f"s{i:04d}", [list(map(float, v)) for v in vs]) for i, vs in enumerate(lists)]
    return spark.createDataFrame(rows, "seq_id string, value array<array<double>>")


def plain_prepare(vs, n=18):
    clipped = vs[-n:]
    while clipped and clipped[-1] == PAD:
        clipped = clipped[:-1]
    if sum(v != PAD for v in clipped) < 2:
        return None
    return [PAD] * (n - len(clipped)) + clipped


def test_prepare_on_random_rows(spark):
    rng = random.Random(7)
    lists = [[PAD if rng.random() < 0.3 else (rng.random(), 1.0) for _ in range(rng.randint(0, 26))]
             for _ in range(150)]
    lists += [[], [PAD] * 20, [(1.0, 1.0)] * 18, [(1.0, 1.0)] * 19, [(1.0, 1.0), (2.0, 1.0)] + [PAD] * 18,
              [(1.0, 0.0), PAD, (2.0, 0.0), PAD], [(1.0, 0.0), (-0.0, 0.0)]]
    got = {r.seq_id: r for r in prepare.prepare_sequences(seqs(spark, lists), D).collect()}
    for i, vs in enumerate(lists):
        expected, row = plain_prepare(vs), got.get(f"s{i:04d}")
        if expected is None:
            assert row is None
        else:
            value = [tuple(v) for v in row.value]
            assert value == expected and len(value) == 18
            assert list(row["mask"]) == [v == PAD for v in expected]
            assert row.n_real == sum(v != PAD for v in expected)


def test_clip_comes_before_stripping(spark):
    vs = [(9.0, 9.0), (8.0, 8.0)] + [(1.0, 1.0)] * 16 + [PAD, PAD]
    row = prepare.prepare_sequences(seqs(spark, [vs]), D).first()
    assert [tuple(v) for v in row.value] == [PAD] * 2 + [(1.0, 1.0)] * 16


def test_windows_and_masks(spark):
    value = [(float(i), 1.0) for i in range(18)]
    prepared = prepare.prepare_sequences(seqs(spark, [value]), D)
    w = prepare.shifted_windows(prepared).first()
    firsts = [[int(v[0]) for v in part] for part in (w.encoder, w.source, w.target)]
    assert firsts == [list(range(16)), list(range(1, 17)), list(range(2, 18))]
    assert w.source_mask == [False] * 16
    short = prepare.shifted_windows(prepared, decoder_length=4).first()
    assert [int(v[0]) for v in short.source] == [13, 14, 15, 16]
    assert [int(v[0]) for v in short.target] == [14, 15, 16, 17]


def test_long_form_and_length_error(spark):
    value = [(float(i), 1.0) for i in range(18)]
    long = prepare.sequence_long(seqs(spark, [value]))
    assert long.schema["vec"].dataType.simpleString() == "array<float>"
    assert sorted((r.pos, r.vec[0]) for r in long.collect()) == [(i, float(i)) for i in range(18)]
    shifted = prepare.shifted_long(long).collect()
    assert sorted((r.vec[0], r.next_vec[0]) for r in shifted) == [(float(i), i + 1.0) for i in range(17)]
    with pytest.raises(Exception, match="18 vectors"):
        prepare.sequence_long(seqs(spark, [value[:5]])).collect()


def test_padding_removed_anywhere_and_take_last(spark):
    vs = [PAD, (1.0, 1.0), PAD, (2.0, 1.0), PAD]
    row = seqs(spark, [vs]).select(S.remove_padding("value", D).alias("v"), S.take_last("value", 18).alias("all"),
                                   S.take_last("value", 2).alias("two")).first()
    assert [v[0] for v in row.v] == [1.0, 2.0] and len(row["all"]) == 5 and [v[0] for v in row.two] == [2.0, 0.0]


def test_running_mean(spark):
    row = seqs(spark, [[(2.0, 0.0), (4.0, 6.0), (0.0, 0.0)]]).select(S.running_mean("value", D).alias("m")).first()
    assert row.m == [[2.0, 0.0], [3.0, 3.0], [2.0, 2.0]]


def test_hash_split_is_stable_disjoint_and_near_the_share(spark):
    df = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    first = {r.id: r.split for r in df.withColumn("split", prepare.hash_split("k")).collect()}
    again = {r.id: r.split for r in df.repartition(7).withColumn("split", prepare.hash_split("k")).collect()}
    assert first == again and set(first.values()) == {"train", "validation"}
    assert 0.87 < sum(v == "train" for v in first.values()) / 4000 < 0.93


def test_random_split_by_content(spark):
    df = spark.range(3000)
    a = {r.id: r.split for r in prepare.random_split(df, 0.9, 1).collect()}
    b = {r.id: r.split for r in prepare.random_split(df.repartition(5), 0.9, 1).collect()}
    assert a == b and 0.87 < sum(v == "train" for v in a.values()) / 3000 < 0.93
    assert a != {r.id: r.split for r in prepare.random_split(df, 0.9, 2).collect()}


def test_row_numbers_with_a_hot_leading_key(spark):
    rows = [(0 if i % 3 == 0 else i, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").repartition(5)
    got = sorted((r.row_no, r.a, r.b) for r in numbering.row_numbers(df, "a", "b").collect())
    assert got == [(n + 1, a, b) for n, (a, b) in enumerate(sorted(rows))]


@pytest.mark.parametrize("n,batch,drop,expected", [
    (10, 4, True, [0] * 4 + [1] * 4 + [2]), (10, 4, False, [0] * 4 + [1] * 4 + [2] * 2),
    (9, 4, True, [0] * 4 + [1] * 4), (1, 4, True, []), (0, 4, True, []),
])
def test_batches_leave_the_last_row_out(spark, n, batch, drop, expected):
    got = numbering.batch_numbers(spark.range(n), "id", batch_size=batch, drop_last_row=drop)
    assert [r.batch_no for r in sorted(got.collect())] == expected


def test_prefix_split_rounds_down(spark):
    got = sorted((r.id, r.split) for r in numbering.prefix_split(spark.range(9), "id").collect())
    assert [s for _, s in got] == ["train"] * 7 + ["test"] * 2
    sizes = {r.split: (r.samples, r.batches) for r in numbering.split_sizes(
        numbering.prefix_split(spark.range(9), "id"), 3).collect()}
    assert sizes == {"train": (7, 2), "test": (2, 0)}


def test_ids_first_equals_preparing_vectors(spark):
    """Deciding on ids and attaching at most 18 vectors gives the rows of preparing resolved vectors."""
    import random

    from trailseq.functions.vectors import is_padding
    from trailseq.operators import resolve

    rng = random.Random(4)
    lookup = [(i, [0.0, 0.0] if i % 4 == 0 else [float(i), 1.0]) for i in range(1, 30)] + [(99, [])]
    histories = [([k], [rng.choice([*range(1, 34), 99]) for _ in range(rng.randrange(0, 45))]) for k in range(120)]
    table = spark.createDataFrame(lookup, "item_id bigint, vec array<double>")
    frame = spark.createDataFrame(histories, "user array<bigint>, history array<bigint>")
    known = table.where(F.size("vec") > 0)
    ids = prepare.prepare_ids(resolve.sequences_with_padding(frame, known.select("item_id", is_padding("vec", 2).alias("is_pad"))))
    got = prepare.attach_vectors(ids, known, 2)
    resolved = prepare.vectors_only(resolve.resolve_histories(frame, table)).drop("items")
    want = prepare.prepare_sequences(resolved, 2)
    rows = lambda df: sorted((r.seq_id, r.value, r["mask"], r.n_real) for r in df.select(
        "seq_id", "value", "mask", "n_real").collect())
    assert rows(got) == rows(want) and len(rows(got)) > 50
    # what is collected and shuffled are ids and flags
    text = ids.select("seq_id", prepare.hash_split("seq_id"))._jdf.queryExecution().optimizedPlan().toString()
    collected = [line for line in text.splitlines() if "collect_list" in line]
    assert collected and not any("vec" in line for line in collected)


def test_vectors_of_another_length_are_an_error(spark):
    rows = spark.createDataFrame([("a", [[1.0, 2.0], [1.0]])], "seq_id string, value array<array<double>>")
    with pytest.raises(Exception, match="does not have length 2"):
        prepare.prepare_sequences(rows, 2).collect()
