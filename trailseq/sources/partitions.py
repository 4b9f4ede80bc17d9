"""Newest partition of a directory tree."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, partition: str,
                     fmt: str = "parquet") -> DataFrame:
    """A ``partition=value`` tree; the partition column stays the directory name as a string."""
    full = T.StructType([f for f in schema.fields if f.name != partition]).add(partition, T.StringType())
    return spark.read.schema(full).format(fmt).load(path)


def newest_name(spark: SparkSession, path: str, partition: str, numeric: bool = False) -> str | None:
    """The highest directory name below ``path``, from one listing; no file of any partition is touched.

    ``numeric=True`` compares numbers and passes over names that aren't numbers.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    prefix = f"{partition}="
    names = [unquote(n[len(prefix):]) for n in (s.getPath().getName() for s in found if s.isDirectory())
             if n.startswith(prefix) and n != f"{prefix}__HIVE_DEFAULT_PARTITION__"]
    if numeric:
        names = [n for n in names if n.lstrip("+-").isdigit()]
    return max(names, key=(lambda n: (int(n), n)) if numeric else None, default=None)


def read_latest(spark: SparkSession, path: str, schema: T.StructType, partition: str, fmt: str = "parquet",
                numeric: bool = False) -> DataFrame:
    """The rows of the newest partition of a tree; the others are pruned by the name. No partition: no rows."""
    newest = newest_name(spark, path, partition, numeric)
    return read_partitioned(spark, path, schema, partition, fmt).where(F.col(partition) == F.lit(newest))


def latest_partition(df: DataFrame, partition: str, numeric: bool = False) -> DataFrame:
    """Rows of the partition with the highest name.

    Names compare as strings, so ``9`` is above ``10``; ``numeric=True`` compares them as numbers and passes
    over names that aren't. For any DataFrame: the maximum is a scalar subquery, which visits every partition once;
    ``read_latest`` takes it from the directory listing instead.
    """
    name = F.col(partition)
    top = F.max_by(name, name.try_cast("bigint")) if numeric else F.max(name)
    newest = df.select(partition).agg(top.alias("newest"))
    return df.where(name == newest.scalar())
