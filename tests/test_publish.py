import os

import pytest
from pyspark.sql import functions as F

from trailseq.plans import jobs
from trailseq.sources import json_lines, publish, schemas
from trailseq.streaming import collector


def pairs(spark, n, first=0):
    return spark.range(first, first + n).select("id", F.array(F.col("id").cast("double")).alias("vec"))


def ids(spark, path):
    return sorted(r.item_id for r in json_lines.read_lookup(spark, path).collect())


def test_readers_see_the_old_version_until_the_new_one_is_whole(spark, tmp_path):
    path = f"{tmp_path}/lookup"
    json_lines.publish_pairs(pairs(spark, 5), path)
    before = json_lines.read_lookup(spark, path)
    broken = pairs(spark, 50).withColumn("vec", F.when(F.col("id") < 40, F.col("vec")).otherwise(
        F.raise_error(F.lit("the job dies")).cast("array<double>")))
    with pytest.raises(Exception, match="the job dies"):
        json_lines.publish_pairs(broken.repartition(4), path)
    assert ids(spark, path) == [0, 1, 2, 3, 4]
    publish.remove_unused(spark, path)
    assert ids(spark, path) == [0, 1, 2, 3, 4] and len(os.listdir(f"{path}/_versions")) == 1
    json_lines.publish_pairs(pairs(spark, 3, first=7), path)
    assert ids(spark, path) == [7, 8, 9]
    assert sorted(r.item_id for r in before.collect()) == [0, 1, 2, 3, 4]  # a reader that had begun goes on
    json_lines.publish_pairs(pairs(spark, 1), path)
    json_lines.publish_pairs(pairs(spark, 2), path)
    assert ids(spark, path) == [0, 1] and len(os.listdir(f"{path}/_versions")) == 2


def test_a_writer_that_dies_before_the_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/split"
    rows = spark.range(10).select("id", F.when(F.col("id") < 7, "train").otherwise("validation").alias("split"))
    json_lines.publish_split(rows, path, fmt="json")
    monkeypatch.setattr(publish, "_name_once", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        json_lines.publish_split(rows.where("id > 5"), path, fmt="json")
    part = json_lines.read_json_lines(spark, f"{path}/split=train", schemas.T.StructType().add("id", "long"))
    assert part.count() == 7
    assert spark.read.json(publish.data_paths(spark, path)).count() == 10


def test_two_publishers_make_one_version_after_the_other(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/lookup"
    json_lines.publish_pairs(pairs(spark, 1), path)
    real, calls = publish._name_once, []

    def beaten(spark_, file, content):
        if not calls:  # another job takes the number first
            calls.append(file)
            json_lines.publish_pairs(pairs(spark_, 2), path)
        return real(spark_, file, content)

    monkeypatch.setattr(publish, "_name_once", beaten)
    json_lines.publish_pairs(pairs(spark, 3), path)
    assert ids(spark, path) == [0, 1, 2]


def contexts(spark, path, first):
    rows = [({}, {}, {145: [k, k + 1, k + 2]}) for k in range(first, first + 4)]
    spark.createDataFrame([(r,) for r in rows], schemas.EVENT_CONTEXT).write.mode("append").parquet(path)


def test_a_replayed_batch_writes_nothing_twice(spark, tmp_path, monkeypatch):
    source, out, log = (f"{tmp_path}/{n}" for n in ("contexts", "collected", "log"))
    contexts(spark, source, 0)
    jobs.collect_job(spark, source, out, log)
    contexts(spark, source, 10)
    real = json_lines.append_pairs

    def dies_after_writing(*args):
        real(*args)
        raise RuntimeError("killed before the stream noted the batch")

    monkeypatch.setattr(collector.json_lines, "append_pairs", dies_after_writing)
    with pytest.raises(Exception, match="killed"):
        jobs.collect_job(spark, source, out, log)
    monkeypatch.setattr(collector.json_lines, "append_pairs", real)
    jobs.collect_job(spark, source, out, log)  # Spark hands the batch over again
    assert sorted(r.history[0] for r in json_lines.read_histories(spark, out).collect()) == [*range(4), *range(10, 14)]
    assert len(os.listdir(f"{out}/_versions")) == 2


def test_a_batch_that_dies_while_writing_is_written_again(spark, tmp_path, monkeypatch):
    source, out, log = (f"{tmp_path}/{n}" for n in ("contexts", "collected", "log"))
    contexts(spark, source, 0)
    real = publish._name_once
    monkeypatch.setattr(publish, "_name_once", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(Exception, match="killed"):
        jobs.collect_job(spark, source, out, log)
    monkeypatch.setattr(publish, "_name_once", real)
    jobs.collect_job(spark, source, out, log)
    assert sorted(r.history[0] for r in json_lines.read_histories(spark, out).collect()) == [0, 1, 2, 3]
    assert publish.remove_unused(spark, out) == 1
