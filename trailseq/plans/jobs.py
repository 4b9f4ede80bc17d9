"""The user-facing jobs: collect, resolve, lookup, prepare and split, profile, evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.functions import vectors
from trailseq.functions.sequences import SEQ_LENGTH
from trailseq.functions.vectors import DEFAULT_DIM
from trailseq.operators import collect, evaluate, nearest, numbering, prepare, profile, resolve
from trailseq.session import written_table
from trailseq.sources import json_lines
from trailseq.streaming import collector


def collect_job(spark: SparkSession, contexts_path: str, out_path: str, checkpoint: str) -> None:
    """Read all new context files, append their histories once, stop."""
    contexts = collector.read_contexts(spark, contexts_path)
    collector.start_collector(contexts, out_path, checkpoint, available_now=True).awaitTermination()


def resolve_job(spark: SparkSession, collected_path: str, features: DataFrame, out_path: str) -> None:
    histories = json_lines.read_histories(spark, collected_path, strict=True)
    occurring = resolve.occurring_features(features, resolve.distinct_items(histories))
    resolved = resolve.resolve_histories(histories, written_table(resolve.decode_features(occurring), "vectors"))
    json_lines.publish_resolved(resolved, out_path)


def lookup_job(spark: SparkSession, collected_path: str, features: DataFrame, out_path: str) -> None:
    histories = json_lines.read_histories(spark, collected_path, strict=True)
    json_lines.publish_pairs(resolve.lookup_of_features(histories, features), out_path)


def split_job(spark: SparkSession, resolved_path: str, out_path: str, dim: int = DEFAULT_DIM,
              fmt: str = "json", train: float = 0.9, seed: int = 0) -> None:
    resolved = json_lines.read_resolved(spark, resolved_path, strict=True)
    ready = prepare.prepare_sequences(prepare.vectors_only(resolved), dim).select("value")
    json_lines.publish_split(prepare.random_split(ready, train, seed), out_path, fmt=fmt)


def last_histories(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``user``, ``history`` of a tree of history files: per reader the row of the file whose path is last."""
    rows = json_lines.read_histories(spark, path, strict=True, with_file=True)
    # a reader's rows of one file have no order; the longer, then the larger history counts as the later one
    rows = rows.withColumn("at", F.struct("file", F.size("history").alias("n"), "history"))
    return collect.last_per_key(rows, "user", "history", "at")


def profile_files_job(spark: SparkSession, path: str | list[str]) -> dict[str, DataFrame]:
    """The history part of the profile over files, last file per reader first."""
    return profile_histories(last_histories(spark, path))


def profile_histories(histories: DataFrame) -> dict[str, DataFrame]:
    """The tables of the history part of the profile, from two small stored count tables."""
    copies = profile.history_copies(histories)
    counts = written_table(
        copies.groupBy(F.size("history").cast("bigint").alias("length"))
        .agg(F.sum("copies").alias("n"), F.count("*").alias("n_unique")), "lengths")
    unique = counts.select("length", F.col("n_unique").alias("n"))
    totals = counts.agg(F.coalesce(F.sum("n_unique"), F.lit(0)).alias("n_unique"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("n_all"))
    return {
        "length_stats": profile.stats_of_counts(counts),
        "length_histogram": profile.histogram(counts, "length", "auto", n="n"),
        "length_density": profile.kernel_density(counts, "length", n="n"),
        "unique_ratio": profile.ratio_of_counts(totals),
        "unique_stats": profile.stats_of_counts(unique),
        "unique_histogram": profile.histogram(unique, "length", "auto", n="n"),
        "unique_density": profile.kernel_density(unique, "length", n="n"),
    }


def profile_sequences(sequences: DataFrame, dim: int = DEFAULT_DIM, bins: int = 100) -> dict[str, DataFrame]:
    """The tables of the vector part of the profile, over a stored table with a ``value`` column.

    Lengths take one scan and the four histograms at most three; densities come from their bins.
    """
    counts = written_table(profile.unpadded_length_counts(sequences, dim), "unpadded")
    real = profile.real_vectors(sequences, dim)
    tables = {
        "unpadded_stats": profile.stats_of_counts(counts),
        "unpadded_histogram": profile.histogram(counts, "length", "auto", n="n"),
        "unpadded_density": profile.kernel_density(counts, "length", n="n"),
        "channel_range": profile.channel_range(real),
    }
    for name, binned in profile.vector_histograms(real, bins).items():
        tables[f"{name}_histogram"] = binned
        middles = binned.select(((F.col("bin_low") + F.col("bin_high")) / 2).alias("middle"), "n")
        tables[f"{name}_density"] = profile.kernel_density(middles, "middle", n="n")
    return tables


def scored_windows(prepared: DataFrame, dim: int = DEFAULT_DIM, predictor=None,
                   decoder_length: int = SEQ_LENGTH, inputs: tuple[str, ...] = ("source",),
                   normalize: bool = False) -> DataFrame:
    """``seq_id``, ``prediction``, ``target`` from the given model or, without one, from the running mean."""
    return evaluate.score_sequences(
        prepared, predictor or evaluate.running_mean, length=decoder_length, dim=dim, inputs=inputs,
        normalize=normalize).select("seq_id", "prediction", "target")


def loss_by_batch(prepared: DataFrame, dim: int = DEFAULT_DIM, predictor=None, batch_size: int = 256,
                  kinds: tuple[str, ...] = ("weighted_rmse",), drop_last_row: bool = True,
                  decoder_length: int = SEQ_LENGTH, inputs: tuple[str, ...] = ("source",),
                  normalize: bool = False) -> DataFrame:
    """Losses per batch of sequences in ``seq_id`` order.

    Each sequence is reduced to a few error sums where it is; only those are numbered and grouped.
    """
    errors = evaluate.window_errors(
        prepared, predictor or evaluate.running_mean, length=decoder_length, dim=dim, inputs=inputs, kinds=kinds,
        normalize=normalize)
    sums = tuple(c for c in errors.columns if c != "seq_id")
    batches = numbering.batch_numbers(
        errors, "seq_id", batch_size=batch_size, drop_last_row=drop_last_row, carry=sums)
    return evaluate.batch_losses(batches, kinds)


def decoded_items(prepared: DataFrame, lookup: DataFrame, dim: int = DEFAULT_DIM, predictor=None,
                  decoder_length: int = SEQ_LENGTH, inputs: tuple[str, ...] = ("source",), normalize: bool = False,
                  shrink: float | None = None, **limits) -> DataFrame:
    """Predicted and actual item of every target position.

    ``shrink`` sets predicted channels of at most that size to zero before decoding.
    """
    scored = scored_windows(prepared, dim, predictor, decoder_length, inputs, normalize)
    flat = evaluate.flatten_predictions(scored, "seq_id")
    if shrink is not None:
        flat = flat.withColumn("prediction", vectors.hard_shrink("prediction", shrink))
    return nearest.nearest_items(
        flat, lookup, {"prediction": "pred_item", "target": "true_item"}, ["seq_id", "pos"], dim, **limits)


def evaluate_job(prepared: DataFrame, lookup: DataFrame, dim: int = DEFAULT_DIM, predictor=None,
                 batch_size: int = 256, decoder_length: int = SEQ_LENGTH, inputs: tuple[str, ...] = ("source",),
                 normalize: bool = False, shrink: float | None = None) -> dict[str, DataFrame]:
    """Loss and accuracy of a model. The options say what the model gets and what happens to its output."""
    stored = written_table(prepared, "evaluated")
    shape = {"decoder_length": decoder_length, "inputs": inputs, "normalize": normalize}
    return {
        "loss": evaluate.mean_loss(loss_by_batch(stored, dim, predictor, batch_size, **shape)),
        "accuracy": evaluate.accuracy(decoded_items(stored, lookup, dim, predictor, shrink=shrink, **shape)),
    }
