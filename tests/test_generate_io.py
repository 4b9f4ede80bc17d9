import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from trailseq.operators import generate, prepare, resolve
from trailseq.plans import jobs, queries
from trailseq.session import scratch_path, scratch_root, written_table
from trailseq.sources import json_lines, partitions, schemas

DIM = 12


def values(df):
    return np.array([r.value for r in df.orderBy("seq_no").collect()])


@pytest.mark.parametrize("validation", [False, True])
def test_alternating_and_uninteresting(spark, validation):
    keys = generate.sequence_keys(spark, 4)
    flip = 0 if validation else 1
    alt = [(18 - p if p % 2 == flip else p) / 18 for p in range(18)]
    dull = [0.5 if p % 2 == flip else p / 18 for p in range(18)]
    for make, expected in ((generate.alternating, alt), (generate.uninteresting, dull)):
        got = values(make(keys, validation=validation, dim=DIM))
        assert got.shape == (4, 18, DIM) and np.allclose(got, np.array(expected)[None, :, None])


@pytest.mark.parametrize("validation", [False, True])
def test_channel_dependent_without_noise(spark, validation):
    got = values(generate.channel_dependent(
        generate.sequence_keys(spark, 2), validation=validation, dim=DIM, noise=False))
    flip, every = (0, 4) if validation else (1, 3)
    for p in range(18):
        for c in range(1, DIM + 1):
            falling = (18 - p) / (3 if c % every == 0 else 18)
            rising = p / (1 if validation else 18)
            assert got[0, p, c - 1] == pytest.approx(falling if p % 2 == flip else rising)


def test_noise_is_standard_normal_repeatable_and_differs_per_draw(spark):
    keys = generate.sequence_keys(spark, 60)
    noisy = values(generate.channel_dependent(keys, dim=DIM, seed=3))
    clean = values(generate.channel_dependent(keys, dim=DIM, noise=False))
    scale = values(generate.channel_dependent(keys, dim=DIM, noise=False))
    draws = (noisy - clean) * np.where((np.arange(18) % 2 == 1)[:, None] & (np.arange(1, DIM + 1) % 3 == 0), 3, 18)
    assert abs(draws.mean()) < 0.03 and abs(draws.std() - 1) < 0.03
    assert len(np.unique(draws.round(9))) == draws.size
    again = values(generate.channel_dependent(keys.repartition(7), dim=DIM, seed=3))
    assert np.array_equal(noisy, again)
    assert not np.array_equal(noisy, values(generate.channel_dependent(keys, dim=DIM, seed=4)))


def test_noise_of_whole_arrays_is_that_of_the_hashes(spark):
    keys = generate.sequence_keys(spark, 30).withColumn("seq_no", F.when(F.col("seq_no") != 4, F.col("seq_no") - 9))
    draws = lambda p: F.transform(
        F.sequence(F.lit(1), F.lit(DIM)), lambda c: generate.gaussian(F.col("seq_no"), p, c, seed=5))
    single = keys.select("seq_no", F.transform(F.sequence(F.lit(0), F.lit(17)), draws).alias("value"))
    noisy, clean = (generate.uninteresting(keys, dim=DIM, noise=n, scaled=False, seed=5) for n in (True, False))
    want = np.where((np.arange(18) % 2 == 1)[:, None], 0.0, values(single))
    assert np.allclose(values(noisy) - values(clean), want, rtol=0, atol=1e-13)


def test_draws_of_noise_are_not_sent_to_all(spark):
    """Their plans look small at any size, so that the query ended in the driver's memory."""
    plan = queries.gen_noise(spark, spark_entry.ENTRY_TABLES)._jdf.queryExecution().toString()
    assert "SortMergeJoin [c_custkey" in plan and "BroadcastHashJoin [c_custkey" not in plan


def test_first_position_of_the_alternating_train_set_is_padding(spark):
    made = generate.alternating(generate.sequence_keys(spark, 1), dim=DIM).withColumnRenamed("seq_no", "seq_id")
    row = prepare.prepare_sequences(made, DIM).first()
    assert row["mask"] == [True] + [False] * 17 and row.n_real == 17


def test_json_pairs_and_values_round_trip(spark, tmp_path):
    rows = [([1, 2], [3, 4, 5]), ([2], [])]
    path = str(tmp_path / "h")
    json_lines.write_pairs(spark.createDataFrame(rows, schemas.USER_HISTORY), path)
    line = next(l for f in sorted(os.listdir(path)) if f.endswith(".json") for l in open(f"{path}/{f}"))
    assert line.startswith('{"_1":')
    open(f"{path}/notes.txt", "w").write("not json\n")
    got = json_lines.read_histories(spark, path, strict=True, with_file=True, suffix=".json")
    assert sorted((r.user, r.history) for r in got.collect()) == sorted(rows)
    assert all(".json" in r.file for r in got.collect())


def test_a_line_without_history_is_null(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"_1":[1]}\n{"_1":[2],"_2":[1,2,3]}\n')
    got = json_lines.read_histories(spark, str(tmp_path / "x.json"))
    assert sorted((r.user, r.history) for r in got.collect()) == [([1], None), ([2], [1, 2, 3])]


def test_strict_reading_fails_on_broken_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"_1":[1],"_2":[2]}\n{"_1":[1],\n')
    with pytest.raises(Exception):
        json_lines.read_histories(spark, str(tmp_path / "x.json"), strict=True).collect()


@pytest.mark.parametrize("names,numeric,expected", [
    (["9", "10"], False, "9"), (["9", "10"], True, "10"), (["2024-01", "2023-12"], False, "2024-01")])
def test_latest_partition(spark, tmp_path, names, numeric, expected):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id bigint, part string")
    path = str(tmp_path / "t")
    df.write.partitionBy("part").parquet(path)
    stored = partitions.read_partitioned(spark, path, df.schema, "part")
    newest = partitions.latest_partition(stored, "part", numeric)
    assert [r.part for r in newest.collect()] == [expected]
    assert "PartitionFilters: [isnotnull(part" in newest._jdf.queryExecution().toString()


def test_jobs_on_files_end_to_end(spark, tmp_path):
    collected, features = str(tmp_path / "collected"), [
        (i, {"bert": str([float(i), 1.0])}) for i in range(1, 9)] + [(9, {})]
    lists = [([u], [(u + k) % 9 + 1 for k in range(3 + u % 5)]) for u in range(30)]
    json_lines.write_pairs(spark.createDataFrame(lists, schemas.USER_HISTORY), collected)
    table = spark.createDataFrame(features, schemas.FEATURE_RECORD)
    jobs.resolve_job(spark, collected, table, str(tmp_path / "resolved"))
    jobs.lookup_job(spark, collected, table, str(tmp_path / "lookup"))
    jobs.split_job(spark, str(tmp_path / "resolved"), str(tmp_path / "split"), dim=2)
    lookup = {r.item_id for r in json_lines.read_lookup(spark, str(tmp_path / "lookup")).collect()}
    assert lookup == set(range(1, 9))
    expected = {tuple(i for i in h if i != 9) for _, h in lists}
    expected = {h for h in expected if len(h) > 2}
    resolved = json_lines.read_resolved(spark, str(tmp_path / "resolved"))
    assert sorted(tuple(e.item_id for e in r.value) for r in resolved.collect()) == sorted(expected)
    version, = (tmp_path / "split" / "_versions").iterdir()
    parts = [json_lines.read_values(spark, str(tmp_path / "split" / f"split={s}")).collect()
             for s in ("train", "validation") if (version / f"split={s}").exists()]
    rows = [r for p in parts for r in p]
    assert len(rows) == len(expected) and all(len(r.value) == 18 for r in rows)


def test_written_table_lives_below_the_shared_folder(spark):
    df = written_table(spark.range(5), "five")
    assert sorted(r.id for r in df.collect()) == list(range(5))
    assert all(scratch_root(spark) in f and "/five-" in f for f in df.inputFiles())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
