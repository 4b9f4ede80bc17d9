"""Resolved histories to fixed-length sequences, windows, masks and splits. All row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailseq.functions import sequences as S
from trailseq.functions.vectors import DEFAULT_DIM, as_float
from trailseq.operators.resolve import join_vectors


def prepare_sequences(sequences: DataFrame, dim: int = DEFAULT_DIM, length: int = S.INTERNAL_LENGTH,
                      min_real: int = 2, value: str = "value") -> DataFrame:
    """Clip to the last ``length`` vectors, strip trailing padding, pad on the left.

    Rows need ``min_real`` vectors that are not padding. Clipping comes first: items older than the clip
    are not fetched back when trailing padding goes. Padding between items stays. Every row comes out with
    exactly ``length`` vectors. ``value`` is an array of vectors; other columns pass through. Adds ``mask``
    (true = padding) and ``n_real``.
    """
    wrong = F.exists(value, lambda v: F.coalesce(F.size(v) != dim, F.lit(True)))
    checked = F.when(wrong, F.raise_error(F.lit(f"a vector does not have length {dim}"))).otherwise(F.col(value))
    clipped = sequences.withColumn(value, checked).withColumn(value, S.take_last(value, length))
    masked = clipped.withColumn("mask", S.padding_mask(value, dim))
    counted = masked.withColumn("n_real", S.count_real("mask")).where(F.col("n_real") >= min_real)
    stripped = (
        counted.withColumn("kept", S.last_real_index("mask"))
        .withColumn(value, S.left_pad(F.slice(value, F.lit(1), F.col("kept")), length, dim))
        .withColumn("mask", F.concat(
            F.array_repeat(F.lit(True), F.lit(length) - F.col("kept")),
            F.slice("mask", F.lit(1), F.col("kept"))))
    )
    return stripped.drop("kept")


def prepare_ids(sequences: DataFrame, length: int = S.INTERNAL_LENGTH, min_real: int = 2) -> DataFrame:
    """The decisions of ``prepare_sequences`` on ids alone: ``seq_id``, ``items``, ``mask``, ``n_real``.

    ``sequences`` has ``seq_id``, ``items`` and ``pads``, as ``resolve.sequences_with_padding`` gives them. ``items`` comes
    out clipped and stripped, at most ``length`` of them; ``mask`` is that of the padded sequence. Whatever needs
    no vector (numbering, splits, masks, lengths) works on this table.
    """
    clipped = sequences.select("seq_id", S.take_last("items", length).alias("items"), S.take_last("pads", length).alias("pads"))
    counted = clipped.withColumn("n_real", S.count_real("pads")).where(F.col("n_real") >= min_real)
    kept = counted.withColumn("kept", S.last_real_index("pads"))
    return kept.select(
        "seq_id", F.slice("items", F.lit(1), F.col("kept")).alias("items"),
        F.concat(F.array_repeat(F.lit(True), F.lit(length) - F.col("kept")),
                 F.slice("pads", F.lit(1), F.col("kept"))).alias("mask"),
        "n_real")


def attach_vectors(prepared: DataFrame, lookup: DataFrame, dim: int = DEFAULT_DIM,
                   length: int = S.INTERNAL_LENGTH) -> DataFrame:
    """``seq_id``, ``value``, ``mask``, ``n_real``: the vectors of prepared ids, padded on the left.

    ``lookup`` should be stored. At most ``length`` vectors a sequence are joined and collected, however long its history was.
    """
    n = int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = prepared.repartition(n, "seq_id").select(
        "seq_id", "mask", "n_real", F.posexplode("items").alias("pos", "item_id"))
    return (
        join_vectors(items, lookup, "seq_id")
        .groupBy("seq_id").agg(
            F.sort_array(F.collect_list(F.struct("pos", "vec"))).alias("rows"),
            F.any_value("mask").alias("mask"), F.any_value("n_real").alias("n_real"))
        .select("seq_id", S.left_pad(F.col("rows.vec"), length, dim).alias("value"), "mask", "n_real")
    )


def vectors_only(resolved: DataFrame) -> DataFrame:
    """The bridge between resolving and preparing: pairs of id and vector become vectors."""
    return resolved.withColumn("value", S.vectors_of("value"))


def shifted_windows(prepared: DataFrame, decoder_length: int = S.SEQ_LENGTH,
                    seq_length: int = S.SEQ_LENGTH) -> DataFrame:
    """Encoder source, decoder source and target of each sequence, and the mask of the decoder source."""
    rest = [c for c in prepared.columns if c not in ("value", "mask")]
    mask = [S.decoder_mask("mask", seq_length).alias("source_mask")] if "mask" in prepared.columns else []
    return prepared.select(
        *rest,
        S.encoder_source("value", seq_length).alias("encoder"),
        S.decoder_source("value", decoder_length, seq_length).alias("source"),
        S.target("value", decoder_length, seq_length).alias("target"),
        *mask,
    )


def sequence_long(prepared: DataFrame, key: str = "seq_id", length: int = S.INTERNAL_LENGTH) -> DataFrame:
    """One row per position, 0-based, float vectors. Sequences of another length are an error."""
    same_length = F.assert_true(
        F.size("value") == length, F.lit(f"every sequence must hold {length} vectors"))
    checked = prepared.withColumn("value", F.when(same_length.isNull(), F.col("value")))
    return checked.select(key, F.posexplode("value").alias("pos", "vec")).withColumn("vec", as_float("vec"))


def shifted_long(long: DataFrame, key: str = "seq_id") -> DataFrame:
    """Each position with the vector that follows it; a window per sequence, at most its length."""
    order = Window.partitionBy(key).orderBy("pos")
    return long.withColumn("next_vec", F.lead("vec").over(order)).where(F.col("next_vec").isNotNull())


def hash_split(key: Column | str, train: float = 0.9) -> Column:
    """``train`` or ``validation`` from the first 16 bits of an MD5 of the key: repeatable, no shuffle.

    A NULL key is in validation, but for ``train=1.0``, which puts every row into train.
    """
    if not 0 <= train <= 1:
        raise ValueError("train must be between 0 and 1")
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    bits = F.coalesce(F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int"), F.lit(65535))
    return F.when(bits < int(train * 65536), "train").otherwise("validation")


def random_split(rows: DataFrame, train: float = 0.9, seed: int = 0) -> DataFrame:
    """A seeded split by the whole content of the row, for rows without a key.

    Unlike ``DataFrame.randomSplit`` it does not depend on partitioning or row order, so a recomputed
    task puts the same rows into the same part.
    """
    if not 0 <= train <= 1:
        raise ValueError("train must be between 0 and 1")
    bucket = F.pmod(F.xxhash64(F.lit(seed), *rows.columns), F.lit(1_000_000)) / 1_000_000
    return rows.withColumn("split", F.when(bucket < train, "train").otherwise("validation"))
