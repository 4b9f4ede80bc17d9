"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "trailseq", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs count on; cluster sizes stay with spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Bring this package to the Python workers, once per application.

    Functions given to ``mapInArrow`` and the like are pickled by name, so the workers must be able to import them
    wherever the driver was started.
    """
    if getattr(spark.sparkContext, "_trailseq_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="trailseq-"), "trailseq.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._trailseq_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="trailseq-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between runs."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete what this application has written to the shared folder; for when its results have been stored.

    DataFrames that were returned but not yet stored read these tables, so a job can't do it by itself. Returns
    the number of tables deleted.
    """
    gone = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def written_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored files.

    Cuts the lineage: a lost executor re-reads files instead of recomputing the plan, and values that
    depend on row placement are fixed from here on.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
