"""JSON-lines tables. On disk, pairs are named ``_1`` and ``_2``; in Spark they have real names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailseq.sources import publish, schemas


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    strict: bool = False, with_file: bool = False, suffix: str | None = None) -> DataFrame:
    """One file, one directory or a list of them, compressed or not, never inferring a schema.

    Published tables are read in their current version (see ``publish``). ``suffix`` (such as ``.json``) leaves files with other names out. ``strict`` fails on a line that doesn't parse; otherwise
    its columns are NULL.
    """
    reader = spark.read.schema(schema)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if strict:
        reader = reader.option("mode", "FAILFAST")
    paths = [found for one in ([path] if isinstance(path, str) else path) for found in publish.data_paths(spark, one)]
    df = reader.json(paths)
    return df.select("*", F.col("_metadata.file_path").alias("file")) if with_file else df


def _pair_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField(f"_{i + 1}", field.dataType) for i, field in enumerate(schema.fields)
    ])


def read_pairs(spark: SparkSession, path: str | list[str], schema: T.StructType,
               strict: bool = False, with_file: bool = False, suffix: str | None = None) -> DataFrame:
    df = read_json_lines(spark, path, _pair_schema(schema), strict, with_file, suffix)
    renamed = [F.col(f"_{i + 1}").alias(field.name) for i, field in enumerate(schema.fields)]
    return df.select(*renamed, *(["file"] if with_file else []))


def _stored_pairs(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_{i + 1}") for i, c in enumerate(df.columns)])


def write_pairs(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Plain files; ``overwrite`` deletes first, so prefer ``publish_pairs`` for what others read."""
    _stored_pairs(df).write.mode(mode).json(path, compression=compression)


def publish_pairs(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Replace the pairs at ``path``, all at once or not at all."""
    publish.publish(_stored_pairs(df), path, lambda w, p: w.json(p, compression=compression))


def append_pairs(df: DataFrame, path: str, key: str, fmt: str = "json") -> bool:
    """Add the pairs of one batch, once however often it is replayed."""
    return publish.append_once(_stored_pairs(df) if fmt == "json" else df, path, key, lambda w, p: w.format(fmt).save(p))


def read_histories(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_pairs(spark, path, schemas.USER_HISTORY, **options)


def read_lookup(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    return read_pairs(spark, path, schemas.LOOKUP, **options)


def read_values(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Trainable sequences: one column ``value``."""
    return read_json_lines(spark, path, schemas.TRAINABLE, **options)


def read_resolved(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Resolved histories; the pairs inside ``value`` are ``_1``/``_2`` on disk."""
    stored = T.StructType([T.StructField("value", T.ArrayType(_pair_schema(schemas.LOOKUP)))])
    df = read_json_lines(spark, path, stored, **options)
    return df.withColumn("value", F.col("value").cast(schemas.RESOLVED["value"].dataType))


def publish_resolved(df: DataFrame, path: str) -> None:
    stored = T.ArrayType(_pair_schema(schemas.LOOKUP))
    publish.publish(df.select(F.col("value").cast(stored).alias("value")), path, lambda w, p: w.json(p))


def publish_split(df: DataFrame, path: str, split_column: str = "split", fmt: str = "parquet") -> None:
    """Both parts in one pass: one directory per split label, which become current together."""
    publish.publish(df, path, lambda w, p: w.partitionBy(split_column).format(fmt).save(p))
