"""Row numbers over a whole table without a one-task window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailseq.session import written_table


def row_numbers(rows: DataFrame, *keys: str, name: str = "row_no", carry: tuple[str, ...] = ()) -> DataFrame:
    """Number the rows 1..N in the order of ``keys``, which together must be unique.

    Only the keys move, with the (narrow) columns to ``carry``. They are written first, because range
    partitioning reads its input twice, and then range-partitioned (a composite key splits inside one hot
    value), sorted per partition and written again, which fixes each row's place. The count of rows before
    a partition comes from a table of one row per partition.
    """
    narrow = written_table(rows.select(*keys, *carry), "row-keys")
    placed = written_table(
        narrow.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("slot", F.monotonically_increasing_id()),
        "row-numbers",
    )
    placed = placed.select(
        *keys, *carry,
        F.shiftright("slot", 33).alias("part"),
        F.col("slot").bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"),
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select(
        *keys, *carry, (F.col("start") + F.col("offset") + 1).alias(name))


def ranks_within(rows: DataFrame, key: str, *order: str, carry: tuple[str, ...] = (), name: str = "rank") -> DataFrame:
    """Number the rows of each ``key`` (a whole number or NULL) 0..n-1 in the order of ``order``, wherever a key is hot.

    Rows are range-partitioned by key and order, which splits a hot key, and sorted; a task numbers the runs of equal keys
    that it sees. Only the first key of a partition may have begun before: its number of rows in earlier partitions
    comes from a table of one row per partition. One shuffle, and one table, which fixes the places. Only
    ``key``, ``order`` and ``carry`` are kept. Rows of equal key and order are numbered in any order.
    """
    columns = [key, *order, *carry]
    dealt = rows.select(*columns).repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    kept = [key, *carry]
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("part", T.IntegerType()),
                           T.StructField("local", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(batch.schema.get_field_index(key))
            known = column.is_valid().to_numpy(zero_copy_only=False)
            keys = column.fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.concatenate(([True], (keys[1:] != keys[:-1]) | (known[1:] != known[:-1])))
            at = np.arange(n)
            local = at - np.maximum.accumulate(np.where(starts, at, 0))
            if last == (bool(known[0]), int(keys[0])):
                first_run = int(np.append(np.flatnonzero(starts[1:]) + 1, n)[0])
                local[:first_run] += seen
            last, seen = (bool(known[-1]), int(keys[-1])), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept),
                 pa.array(np.full(n, part, dtype=np.int32)), pa.array(local)], names=schema.names)

    placed = written_table(dealt.mapInArrow(number, schema), "ranks")
    ends = placed.groupBy("part").agg(
        F.min(F.struct(key)).alias("first"), F.max(F.struct(F.col(key).alias("key"), "local")).alias("last"))
    in_order = Window.orderBy("part")
    so_far = F.sum(F.col("last.local") + 1).over(Window.partitionBy("last.key").orderBy("part"))
    begun = ends.withColumn("so_far", so_far).select(
        F.col("part").alias("__part"), F.col(f"first.{key}").alias("__key"), F.lag("last.key").over(in_order).alias("previous"),
        F.lag("so_far").over(in_order).alias("begun")).where("begun is not null and previous <=> __key")
    return placed.join(F.broadcast(begun), (F.col("part") == F.col("__part")) & F.col(key).eqNullSafe(F.col("__key")), "left").select(
        *kept, (F.col("local") + F.coalesce("begun", F.lit(0))).alias(name))


def batch_numbers(rows: DataFrame, *keys: str, batch_size: int = 256,
                  drop_last_row: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """Consecutive blocks of ``batch_size`` rows, numbered from 0.

    ``drop_last_row`` leaves the last row of the whole table out, as the original batching does.
    """
    numbered = row_numbers(rows, *keys, carry=carry)
    if drop_last_row:
        numbered = numbered.where(
            F.col("row_no") < numbered.agg(F.max("row_no").alias("n")).scalar())
    return numbered.select(
        *keys, *carry, F.floor((F.col("row_no") - 1) / batch_size).cast("bigint").alias("batch_no"))


def prefix_split(rows: DataFrame, *keys: str, fraction: float = 0.8) -> DataFrame:
    """The first ``int(N * fraction)`` rows in key order are ``train``, the others ``test``."""
    numbered = row_numbers(rows, *keys)
    total = numbered.agg(F.max("row_no").alias("n"))
    train = total.select(F.floor(F.col("n") * fraction).alias("n_train")).scalar()
    return numbered.select(
        *keys, F.when(F.col("row_no") <= train, "train").otherwise("test").alias("split"))


def split_sizes(split: DataFrame, batch_size: int = 256) -> DataFrame:
    """Rows and whole batches per part."""
    return split.groupBy("split").agg(
        F.count("*").alias("samples"),
        F.floor(F.count("*") / batch_size).cast("bigint").alias("batches"),
    )
