"""One registered query per operator, each over the whole given tables.

Vectors are reported as a checksum over all channels (channel number times value) instead of as arrays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.functions import sequences as S
from trailseq.functions import vectors as V
from trailseq.operators import collect, evaluate, generate, nearest, numbering, prepare, profile, resolve
from trailseq.plans import driver_tables as tables
from trailseq.plans import jobs
from trailseq.session import scratch_path, written_table
from trailseq.sources import json_lines, partitions, publish, schemas
from trailseq.streaming import collector

DIM = tables.DIM
Query = Callable[[SparkSession, str], DataFrame]


def _checksum(vec: Column | str) -> Column:
    vec = F.col(vec) if isinstance(vec, str) else vec
    return F.round(V.add_up(F.transform(vec, lambda x, i: x * (i + 1))), 6)


def _text(items: Column | str) -> Column:
    return F.array_join(items, ",")


def _vectors_of_value(df: DataFrame, value: str = "value") -> DataFrame:
    return df.select("seq_id", F.posexplode(value).alias("pos", "vec"))


def _long_checksums(df: DataFrame, value: str = "value") -> DataFrame:
    return _vectors_of_value(df, value).select("seq_id", "pos", _checksum("vec").alias("checksum"))


# --- sources, sinks, streaming -------------------------------------------------------------------------

def stream_collect(spark: SparkSession, sf: str) -> DataFrame:
    contexts = scratch_path(spark, "contexts")
    tables.event_contexts(spark, sf).select("environment").write.parquet(contexts)
    out, checkpoint = scratch_path(spark, "collected"), scratch_path(spark, "collected-log")
    jobs.collect_job(spark, contexts, out, checkpoint)
    return json_lines.read_histories(spark, out).select(
        _text("user").alias("reader"), _text("history").alias("history"))


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lookup-json")
    json_lines.publish_pairs(tables.lookup(spark, sf), path, compression="gzip")
    return json_lines.read_lookup(spark, path, strict=True).select(
        "item_id", F.size("vec").alias("n"), _checksum("vec").alias("checksum"))


def history_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two directories of history files read as one table: rows and items per directory."""
    pieces = tables.reader_pieces(spark, sf).select(
        F.array("user_id").alias("user"), "history", F.when(F.col("piece") == 0, "a").otherwise("b").alias("part"))
    root = scratch_path(spark, "histories")
    json_lines.write_pairs(pieces.where(F.col("part") == "a").select("user", "history"), f"{root}/a")
    json_lines.write_pairs(pieces.where(F.col("part") == "b").select("user", "history"), f"{root}/b")
    both = json_lines.read_histories(spark, [f"{root}/a", f"{root}/b"], with_file=True)
    source = F.regexp_extract("file", r"/([ab])/[^/]*$", 1)
    return both.groupBy(source.alias("directory")).agg(
        F.count("*").alias("n"), F.sum(F.size("history")).cast("bigint").alias("items"))


def file_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths of histories read from a tree of files, the row of a reader's last file winning."""
    pieces = tables.reader_pieces(spark, sf).select(
        F.array("user_id").alias("_1"), F.col("history").alias("_2"),
        F.lpad(F.col("piece").cast("string"), 9, "0").alias("part"))
    root = scratch_path(spark, "history-files")
    pieces.write.partitionBy("part").json(root)
    return _stats(profile.history_length_stats(jobs.last_histories(spark, root)))


def latest_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Newest day directory by name (``9`` above ``10``) and by number."""
    path = scratch_path(spark, "days")
    days = tables.reading_events(spark, sf).select(
        "event_id", "item_id", F.dayofmonth("ts").cast("string").alias("day"))
    days.write.partitionBy("day").parquet(path)
    by_name = partitions.read_latest(spark, path, days.schema, "day").withColumn("rule", F.lit("name"))
    by_number = partitions.read_latest(spark, path, days.schema, "day", numeric=True).withColumn(
        "rule", F.lit("number"))
    return by_name.unionByName(by_number)


# --- collecting ----------------------------------------------------------------------------------------

def user_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_contexts(spark, sf).select(
        "user_id", "piece", "event_type",
        _text(collect.user_fingerprint()).alias("fingerprint"))


def collect_histories(spark: SparkSession, sf: str) -> DataFrame:
    return tables.collected(spark, sf).select(
        _text("user").alias("reader"), _text("history").alias("history"))


def distinct_histories(spark: SparkSession, sf: str) -> DataFrame:
    return collect.distinct_histories(tables.collected(spark, sf)).select(
        _text("user").alias("reader"), _text("history").alias("history"))


def last_history_per_user(spark: SparkSession, sf: str) -> DataFrame:
    pieces = tables.reader_pieces(spark, sf).select("user_id", "piece", "history")
    return collect.last_per_key(pieces, "user_id", "history", "piece").select(
        "user_id", _text("history").alias("history"))


# --- resolving -----------------------------------------------------------------------------------------

def feature_decode(spark: SparkSession, sf: str) -> DataFrame:
    return tables.vectors(spark, sf).select(
        "item_id", F.size("vec").alias("n"), _checksum("vec").alias("checksum"))


def distinct_items(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.distinct_items(tables.collected(spark, sf))


def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    items = written_table(resolve.distinct_items(tables.collected(spark, sf)), "items")
    occurring = resolve.occurring_features(tables.features(spark, sf), items)
    return resolve.lookup_left(items, resolve.decode_features(occurring)).select(
        "item_id", F.size("vec").alias("n"), _checksum("vec").alias("checksum"))


def lookup_table(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.lookup_of_features(tables.collected(spark, sf), tables.features(spark, sf)).select(
        "item_id", F.size("vec").alias("n"), _checksum("vec").alias("checksum"))


def _resolved_rows(resolved: DataFrame) -> DataFrame:
    return resolved.select("seq_id", F.posexplode("value").alias("pos", "e")).select(
        "seq_id", "pos", "e.item_id", _checksum("e.vec").alias("checksum"))


def resolve_histories(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved_rows(tables.resolved(spark, sf))


def resolve_histories_padded(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved_rows(resolve.resolve_histories_padded(
        tables.collected(spark, sf), written_table(tables.vectors(spark, sf), "vectors"), DIM))


# --- sequences -----------------------------------------------------------------------------------------

def prepare_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return tables.prepared(spark, sf).select(
        "seq_id", F.col("n_real").alias("n_real"), F.posexplode("value").alias("pos", "vec")).select(
        "seq_id", "n_real", "pos", _checksum("vec").alias("checksum"))


def trainable_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared sequences published as JSON lines of one column and read back."""
    path = scratch_path(spark, "trainable")
    publish.publish(tables.prepared(spark, sf).select("value"), path, lambda w, p: w.json(p))
    vectors = json_lines.read_values(spark, path, strict=True).select(F.posexplode("value").alias("pos", "vec"))
    return vectors.groupBy("pos", _checksum("vec").alias("checksum")).agg(F.count("*").alias("n"))


def padding_mask(spark: SparkSession, sf: str) -> DataFrame:
    def bits(mask: Column | str) -> Column:
        return F.array_join(F.transform(mask, lambda m: F.when(m, "1").otherwise("0")), "")

    return tables.prepared_ids(spark, sf).select(
        "seq_id", bits("mask").alias("mask"), bits(S.decoder_mask("mask")).alias("source_mask"))


def sequence_long(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.sequence_long(tables.prepared(spark, sf)).select(
        "seq_id", "pos", _checksum(F.col("vec").cast("array<double>")).alias("checksum"))


def shifted_windows(spark: SparkSession, sf: str) -> DataFrame:
    windows = prepare.shifted_windows(tables.prepared(spark, sf))
    zipped = F.posexplode(F.arrays_zip("encoder", "source", "target"))
    return windows.select("seq_id", zipped.alias("pos", "w")).select(
        "seq_id", "pos", _checksum("w.encoder").alias("encoder"), _checksum("w.source").alias("source"),
        _checksum("w.target").alias("target"))


def short_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Decoder windows of length 4."""
    windows = prepare.shifted_windows(tables.prepared(spark, sf), decoder_length=4)
    return windows.select("seq_id", F.posexplode(F.arrays_zip("source", "target")).alias("pos", "w")).select(
        "seq_id", "pos", _checksum("w.source").alias("source"), _checksum("w.target").alias("target"))


def shifted_long(spark: SparkSession, sf: str) -> DataFrame:
    long = prepare.sequence_long(tables.prepared(spark, sf))
    return prepare.shifted_long(long).select(
        "seq_id", "pos", _checksum(F.col("vec").cast("array<double>")).alias("checksum"),
        _checksum(F.col("next_vec").cast("array<double>")).alias("next_checksum"))


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    ready = tables.prepared_ids(spark, sf).select("seq_id", "n_real", prepare.hash_split("seq_id").alias("split"))
    path = scratch_path(spark, "split")
    json_lines.publish_split(ready, path)
    return spark.read.schema(ready.schema).parquet(*publish.data_paths(spark, path))


def prefix_split(spark: SparkSession, sf: str) -> DataFrame:
    return numbering.prefix_split(tables.prepared_ids(spark, sf), "seq_id")


def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return numbering.split_sizes(prefix_split(spark, sf), batch_size=64)


def batch_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return numbering.batch_numbers(tables.prepared_ids(spark, sf), "seq_id", batch_size=64)


# --- profile -------------------------------------------------------------------------------------------

def _stats(df: DataFrame) -> DataFrame:
    return df.select("n", F.round("mean_length", 8).alias("mean_length"), "median_length")


def history_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(profile.history_length_stats(tables.collected(spark, sf)))


def unique_history_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return profile.unique_history_ratio(tables.collected(spark, sf)).withColumn("ratio", F.round("ratio", 8))


def unique_history_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(profile.unique_history_stats(tables.collected(spark, sf)))


def unpadded_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return _stats(profile.stats_of_counts(profile.real_length_counts(tables.prepared_ids(spark, sf))))


def _real_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return profile.real_vectors(tables.prepared(spark, sf), DIM, "seq_id")


def _stored_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """For profiles that read the vectors twice, first for their range."""
    return written_table(_real_vectors(spark, sf), "vectors")


def channel_range(spark: SparkSession, sf: str) -> DataFrame:
    return profile.channel_range(_real_vectors(spark, sf))


def vector_sums(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vector_sums(_real_vectors(spark, sf)).withColumn(
        "channel_sum", F.round("channel_sum", 6))


def normalized_sums(spark: SparkSession, sf: str) -> DataFrame:
    return profile.normalized_sums(_real_vectors(spark, sf)).withColumn(
        "channel_sum", F.round("channel_sum", 6))


def _bins(df: DataFrame) -> DataFrame:
    return df.select("bin", F.round("bin_low", 6).alias("bin_low"), F.round("bin_high", 6).alias("bin_high"), "n")


def length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    counts = written_table(profile.length_counts(tables.collected(spark, sf)), "lengths")
    return _bins(profile.histogram(counts, "length", 10, n="n"))


def length_histogram_auto(spark: SparkSession, sf: str) -> DataFrame:
    counts = written_table(profile.length_counts(tables.collected(spark, sf)), "lengths")
    return _bins(profile.histogram(counts, "length", "auto", n="n"))


def unique_length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    unique = tables.collected(spark, sf).select("history").distinct()
    counts = written_table(profile.length_counts(unique), "lengths")
    return _bins(profile.histogram(counts, "length", 10, n="n"))


def unpadded_histogram(spark: SparkSession, sf: str) -> DataFrame:
    counts = written_table(profile.real_length_counts(tables.prepared_ids(spark, sf)), "lengths")
    return _bins(profile.histogram(counts, "length", 10, n="n"))


def _vector_histogram(spark: SparkSession, sf: str, kind: str, bins: int) -> DataFrame:
    return profile.vector_histograms(_stored_vectors(spark, sf), bins, (kind,))[kind]


def channel_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _bins(_vector_histogram(spark, sf, "channel", 20))


def normalized_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _bins(_vector_histogram(spark, sf, "normalized", 20))


def sum_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _bins(_vector_histogram(spark, sf, "sum", 20))


def sum_histogram_auto(spark: SparkSession, sf: str) -> DataFrame:
    """Automatic bins of a continuous column, from its exact quartiles."""
    sums = written_table(profile.vector_sums(_real_vectors(spark, sf)), "sums")
    return _bins(profile.histogram(sums, "channel_sum", "auto"))


def length_kde(spark: SparkSession, sf: str) -> DataFrame:
    counts = profile.length_counts(tables.collected(spark, sf))
    return profile.kernel_density(counts, "length", n="n").select(
        "grid_no", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


def channel_kde(spark: SparkSession, sf: str) -> DataFrame:
    """Density of all channels from 100 bins."""
    binned = _vector_histogram(spark, sf, "channel", 100)
    middles = binned.select(((F.col("bin_low") + F.col("bin_high")) / 2).alias("middle"), "n")
    return profile.kernel_density(middles, "middle", n="n").select(
        "grid_no", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


# --- functions -----------------------------------------------------------------------------------------

def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    scored = jobs.scored_windows(tables.prepared(spark, sf), DIM)
    return evaluate.flatten_predictions(scored, "seq_id")


def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf).select(
        "seq_id", "pos", _checksum(V.l2_normalize("prediction")).alias("checksum"))


def hard_shrink(spark: SparkSession, sf: str) -> DataFrame:
    shrunk = tables.lookup(spark, sf).select("item_id", V.hard_shrink("vec", 0.01).alias("vec"))
    return shrunk.select(
        "item_id", F.size(F.filter("vec", lambda x: x == 0)).alias("zeros"), _checksum("vec").alias("checksum"))


def positional_features(spark: SparkSession, sf: str) -> DataFrame:
    long = _vectors_of_value(tables.prepared(spark, sf))
    encoded = V.add_vectors("vec", V.positional_features("pos", DIM))
    return long.select("seq_id", "pos", _checksum(encoded).alias("checksum"))


def first_channels(spark: SparkSession, sf: str) -> DataFrame:
    """The first three channels of every target vector."""
    firsts = V.first_channels("target", 3)
    return _predictions(spark, sf).select("seq_id", "pos", firsts.alias("f")).select(
        "seq_id", "pos", *[F.round(F.col("f")[i], 6).alias(f"channel_{i + 1}") for i in range(3)])


# --- evaluation ----------------------------------------------------------------------------------------

def mean_prediction(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf).select("seq_id", "pos", _checksum("prediction").alias("checksum"))


def score_sequences(spark: SparkSession, sf: str) -> DataFrame:
    """The model hook with a running mean written for arrays of sequences."""
    def running_mean(source):
        import numpy as np

        return source.cumsum(axis=1) / np.arange(1, source.shape[1] + 1)[None, :, None]

    scored = jobs.scored_windows(tables.prepared(spark, sf), DIM, running_mean)
    return evaluate.flatten_predictions(scored, "seq_id").select(
        "seq_id", "pos", _checksum("prediction").alias("checksum"), _checksum("target").alias("target"))


def score_encoder_decoder(spark: SparkSession, sf: str) -> DataFrame:
    """The hook with all inputs: where the decoder source is padding, the mean of the encoder source is predicted."""
    def model(encoder, source, source_mask):
        import numpy as np

        return np.where(source_mask[:, :, None], encoder.mean(axis=1, keepdims=True), source)

    scored = jobs.scored_windows(tables.prepared(spark, sf), DIM, model, inputs=evaluate.INPUTS)
    return evaluate.flatten_predictions(scored, "seq_id").select(
        "seq_id", "pos", _checksum("prediction").alias("checksum"))


def short_sequence_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Losses of the running mean over decoder windows of length 4."""
    losses = jobs.loss_by_batch(tables.prepared(spark, sf), DIM, batch_size=64, decoder_length=4)
    return losses.select("batch_no", F.round("weighted_rmse", 8).alias("weighted_rmse"))


def sequence_loss(spark: SparkSession, sf: str) -> DataFrame:
    losses = jobs.loss_by_batch(tables.prepared(spark, sf), DIM, batch_size=64)
    return evaluate.mean_loss(losses).select(
        "batches", F.round("loss", 8).alias("loss"), F.round("perplexity", 8).alias("perplexity"))


def sequence_loss_variants(spark: SparkSession, sf: str) -> DataFrame:
    losses = jobs.loss_by_batch(
        tables.prepared(spark, sf), DIM, batch_size=64, kinds=evaluate.LOSS_KINDS)
    return losses.select("batch_no", *[F.round(k, 8).alias(k) for k in evaluate.LOSS_KINDS])


def nearest_item(spark: SparkSession, sf: str) -> DataFrame:
    decoded = jobs.decoded_items(tables.prepared(spark, sf), tables.lookup(spark, sf), DIM)
    return decoded.select("seq_id", "pos", "pred_item", "true_item",
                          F.round("pred_item_similarity", 8).alias("similarity"))


def exact_item(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest.exact_items(_predictions(spark, sf), tables.lookup(spark, sf), "target", "item_id")
    return found.select("seq_id", "pos", "item_id", "found")


def decode_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    decoded = jobs.decoded_items(tables.prepared(spark, sf), tables.lookup(spark, sf), DIM)
    return evaluate.accuracy(decoded).withColumn("accuracy", F.round("accuracy", 8))


# --- synthetic sequences, one per customer -------------------------------------------------------------

def _generated(make, spark: SparkSession, sf: str, **options) -> DataFrame:
    keys = tables.table(spark, sf, "customer").select("c_custkey")
    parts = [
        make(keys, "c_custkey", validation=v, dim=DIM, **options).select(
            "c_custkey", F.lit(name).alias("part"), F.posexplode("value").alias("pos", "vec"))
        for v, name in ((False, "train"), (True, "validation"))
    ]
    return parts[0].unionByName(parts[1]).select(
        "c_custkey", "part", "pos", _checksum("vec").alias("checksum"))


def gen_alternating(spark: SparkSession, sf: str) -> DataFrame:
    return _generated(generate.alternating, spark, sf)


def gen_uninteresting(spark: SparkSession, sf: str) -> DataFrame:
    return _generated(generate.uninteresting, spark, sf)


def gen_embedding(spark: SparkSession, sf: str) -> DataFrame:
    return _generated(generate.channel_dependent, spark, sf, noise=False)


def gen_noise(spark: SparkSession, sf: str) -> DataFrame:
    """What holds of the noise at every position: how many values, and whether mean, spread and repeats are a normal one's.

    Bounds are five standard errors of the mean and of the mean square; two draws with one seed agree. Draws are large, and
    their plans look small: vectors meet as 128-bit digests, in a join that sends neither side to all.
    """
    keys = tables.table(spark, sf, "customer").select("c_custkey")

    def drawn(partitions: int | None = None) -> DataFrame:
        noisy = generate.alternating(
            keys, "c_custkey", dim=DIM, noise=True, scaled=False, seed=1, partitions=partitions)
        return noisy.select("c_custkey", F.posexplode_outer("value").alias("pos", "vec"))

    def digests(name: str, partitions: int | None = None) -> DataFrame:
        digest = F.struct(F.xxhash64("vec", F.lit(0)), F.xxhash64("vec", F.lit(1)))
        return drawn(partitions).select("c_custkey", "pos", digest.alias(name))

    level = F.when(F.col("pos") % 2 == 1, 18 - F.col("pos")).otherwise(F.col("pos"))
    noise = drawn().select("pos", F.explode_outer("vec").alias("x")).select("pos", (F.col("x") - level).alias("x"))
    moments = noise.groupBy("pos").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.avg(F.col("x") * F.col("x")).alias("square"))
    # keys dealt otherwise: equal plans would be run once and agree with themselves
    again = digests("again", int(spark.conf.get("spark.sql.shuffle.partitions")) + 1).hint("merge")
    repeats = digests("first").join(again, ["c_custkey", "pos"]).groupBy("pos").agg(
        F.bool_and(F.col("first") == F.col("again")).alias("repeats"))
    return moments.join(repeats, "pos").select(
        "pos", "n", (F.abs("mean") * F.sqrt("n") < 5).alias("centred"),
        (F.abs(F.col("square") - 1) * F.sqrt(F.col("n") / 2) < 5).alias("unit_spread"), "repeats")


def random_users(spark: SparkSession, sf: str) -> DataFrame:
    """Users of five values per customer: how many there are in each nation, how many differ, and how many values do."""
    users = tables.table(spark, sf, "customer").select("c_nationkey", V.random_user("c_custkey").alias("user"))
    return users.groupBy("c_nationkey").agg(
        F.count("*").alias("n"), F.count_distinct("user").alias("users"),
        F.sum(F.size("user")).alias("n_values")).join(
        users.select("c_nationkey", F.explode("user").alias("value")).groupBy("c_nationkey").agg(
            F.count_distinct("value").alias("values")), "c_nationkey")


ALL: dict[str, Query] = {
    f.__name__: f for f in (
        decode_accuracy, collect_histories, user_fingerprint, distinct_histories, last_history_per_user,
        stream_collect, json_roundtrip, history_files, file_profile, latest_partition,
        feature_decode, distinct_items, lookup_left, lookup_table, resolve_histories,
        resolve_histories_padded,
        prepare_sequences, trainable_roundtrip, padding_mask, sequence_long, shifted_windows, short_windows, shifted_long, hash_split,
        prefix_split, split_sizes, batch_numbers,
        history_length_stats, unique_history_ratio, unique_history_stats, unpadded_lengths, channel_range,
        vector_sums, normalized_sums, length_histogram, length_histogram_auto, unique_length_histogram,
        unpadded_histogram, channel_histogram,
        normalized_histogram, sum_histogram, sum_histogram_auto, length_kde, channel_kde,
        l2_normalize, hard_shrink, positional_features, first_channels,
        mean_prediction, score_sequences, score_encoder_decoder, short_sequence_loss, sequence_loss, sequence_loss_variants, nearest_item, exact_item,
        gen_alternating, gen_uninteresting, gen_embedding, gen_noise, random_users,
    )
}
