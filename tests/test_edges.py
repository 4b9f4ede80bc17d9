"""Inputs that must fail loudly or must not lose rows, and running from another folder."""

import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trailseq.operators import prepare, profile, resolve
from trailseq.plans import jobs
from trailseq.session import ship_package
from trailseq.sources import json_lines, partitions, schemas


@pytest.mark.parametrize("train", [0.0, 0.5, 0.9, 1.0])
def test_hash_split_at_its_edges(spark, train):
    rows = spark.range(2000).select(prepare.hash_split(F.col("id"), train).alias("s")).collect()
    share = sum(r.s == "train" for r in rows) / 2000
    assert share == train if train in (0.0, 1.0) else abs(share - train) < 0.05


def test_hash_split_checks_its_share_and_null_keys(spark):
    with pytest.raises(ValueError):
        prepare.hash_split("k", 1.5)
    null = spark.range(1).select(F.lit(None).cast("string").alias("k"))
    assert null.select(prepare.hash_split("k", 0.9).alias("s")).first().s == "validation"
    assert null.select(prepare.hash_split("k", 1.0).alias("s")).first().s == "train"


def test_compressed_json_is_read(spark, tmp_path):
    rows = spark.createDataFrame([([1, 2], [3, 4, 5])], schemas.USER_HISTORY)
    json_lines.write_pairs(rows, f"{tmp_path}/gz", compression="gzip")
    assert json_lines.read_histories(spark, f"{tmp_path}/gz").count() == 1
    assert json_lines.read_histories(spark, f"{tmp_path}/gz", suffix=".json").count() == 0


@pytest.mark.parametrize("line", ['{"_1":[1],"_2":[1,2', '{"_1":[1],"_2":[1,"x",3]}'])
def test_jobs_fail_on_broken_lines(spark, tmp_path, line):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"_1":[1],"_2":[1,2,3]}\n' + line + "\n")
    features = spark.createDataFrame([(1, {"bert": "[1.0]"})], "item_id bigint, features map<string,string>")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        jobs.resolve_job(spark, f"{tmp_path}/in", features, f"{tmp_path}/out")


def test_absent_feature_is_empty_and_a_broken_one_an_error(spark):
    schema = "item_id bigint, features map<string,string>"
    fine = spark.createDataFrame([(1, {"bert": "[1.0, 2]"}), (2, {"x": "y"}), (3, None)], schema)
    assert [r.vec for r in resolve.decode_features(fine).orderBy("item_id").collect()] == [[1.0, 2.0], [], []]
    for text in ("[1, 2", '[1,"x"]', '{"a":1}', "[1,null]", ""):
        broken = spark.createDataFrame([(1, {"bert": text})], schema)
        with pytest.raises(PySparkException, match="not an array of numbers"):
            resolve.decode_features(broken).collect()


def test_histogram_has_its_empty_bins(spark):
    rows = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    assert [r.n for r in profile.histogram(rows, "x", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 1]
    assert profile.histogram(rows.where("false"), "x", 5).count() == 0


def test_newest_partition_from_the_listing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "9"), (2, "10"), (3, "old")], "v bigint, day string")
    rows.write.partitionBy("day").parquet(f"{tmp_path}/t")
    read = lambda numeric: partitions.read_latest(spark, f"{tmp_path}/t", rows.schema, "day", numeric=numeric)
    assert [r.v for r in read(False).collect()] == [3] and [r.v for r in read(True).collect()] == [2]
    plan = read(True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Subquery" not in plan and "Exchange" not in plan
    stored = partitions.read_partitioned(spark, f"{tmp_path}/t", rows.schema, "day")
    assert [r.v for r in partitions.latest_partition(stored, "day", numeric=True).collect()] == [2]


def test_last_file_wins_per_reader(spark, tmp_path):
    for name, rows in (("a", [([1], [1, 2, 3]), ([2], [1, 2, 3, 4])]), ("b", [([1], [5, 6, 7, 8, 9])])):
        json_lines.write_pairs(spark.createDataFrame(rows, schemas.USER_HISTORY), f"{tmp_path}/{name}")
    found = {tuple(r.user): r.history for r in jobs.last_histories(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).collect()}
    assert found == {(1,): [5, 6, 7, 8, 9], (2,): [1, 2, 3, 4]}
    assert jobs.profile_files_job(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])["length_stats"].first().n == 2


def test_package_reaches_workers_from_a_foreign_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        "print('ROWS', e.entry(s).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]


def test_shipping_twice_is_one_archive(spark):
    ship_package(spark)
    before = len(list(spark.sparkContext._python_includes))
    ship_package(spark)
    assert len(list(spark.sparkContext._python_includes)) == before
