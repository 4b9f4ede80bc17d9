"""Replace item ids by vectors, keeping reading order.

Ids are small and vectors are large, so everything that can be decided on ids (which items resolve, which
sequences are equal) is decided before a vector is attached. Id lists are then spread by a content key; the
exploded items carry only that key and their position, and go back together by the same key. A lookup of bounded size
is sent to the items, and vectors are never shuffled. Beyond that size the vectors of the most frequent items are sent,
and only the others meet their items in a shuffle, where no item is hot any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailseq.functions.vectors import DEFAULT_DIM, zero_vector
from trailseq.session import written_table

MIN_RESOLVED = 3
FEATURE = "bert"
#: Bytes of vectors that are sent to all executors at most, and to how many parts of all rows an item is hot at least.
SENT_BYTES = 64 << 20
HOT_PARTS = 20_000
#: Item ids (of 8 bytes) up to which they are sent to all feature records.
BROADCAST_ITEMS = 1_000_000
#: Bits of the filter for more items; at most 8 MB of them.
BITS_PER_ITEM, MOST_BITS, BLOOM_HASHES = 10, 1 << 26, 4


def decode_features(features: DataFrame, feature: str = FEATURE) -> DataFrame:
    """Feature records to ``item_id``, ``vec``; the vector is empty where the feature is absent.

    A feature that is there but isn't an array of numbers is an error, not a missing item. A feature is parsed once:
    conditions on ``vec`` can't be moved in front of the explode, where they would parse it again.
    """
    raw = F.col("features")[feature]
    broken = F.raise_error(F.concat(F.lit(f"feature {feature} of item "), F.coalesce(
        F.col("item_id").cast("string"), F.lit("NULL")), F.lit(" is not an array of numbers: "), F.left(raw, F.lit(80))))

    def checked(decoded: Column) -> Column:
        whole = F.coalesce(~F.exists(decoded, lambda x: x.isNull()), F.lit(False))
        return F.when(raw.isNull(), F.array().cast("array<double>")).when(whole, decoded).otherwise(
            broken.cast("array<double>"))

    once = F.transform(F.array(F.from_json(raw, "array<double>")), checked)
    return features.select("item_id", F.explode(once).alias("vec"))


def occurring_features(features: DataFrame, items: DataFrame) -> DataFrame:
    """The feature records of ``items`` (item_id, distinct), not yet parsed.

    Items up to BROADCAST_ITEMS go to the records, which then stay where they are. More items leave a Bloom filter of
    bounded size, which drops most other records before the rest meets the items in a shuffled join.
    """
    stored = written_table(items.select("item_id"), "items")
    n = stored.count()
    if n <= BROADCAST_ITEMS:
        return features.join(F.broadcast(stored), "item_id", "left_semi")
    bits = min(1 << (BITS_PER_ITEM * n - 1).bit_length(), MOST_BITS)
    if bits >= 2 * n:  # a filter that is fuller lets nearly everything pass
        features = features.where(might_contain(bloom_filter(stored, "item_id", bits), "item_id", bits))
    return features.join(stored, "item_id", "left_semi")


def _bit_places(column: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(column), F.lit(k)), F.lit(bits)) for k in range(BLOOM_HASHES)]


def bloom_filter(rows: DataFrame, column: str, bits: int) -> Column:
    """A Bloom filter of ``column`` as 64-bit words, to be used as a scalar: partial words are merged per task."""
    places = rows.select(F.explode(F.array(*_bit_places(column, bits))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("word"))
    dense = rows.sparkSession.range(max(bits >> 6, 1)).join(words, "id", "left").select(
        "id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))
    return dense.agg(F.sort_array(F.collect_list(F.struct("id", "word"))).alias("w")).select("w.word").scalar()


def might_contain(words: Column, column: str, bits: int) -> Column:
    """False only for values that are not in the filter; NULL is in none."""
    inside = F.lit(True)
    for place in _bit_places(column, bits):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        inside = inside & (word.bitwiseAND(F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))) != 0)
    return F.col(column).isNotNull() & inside


def distinct_items(histories: DataFrame) -> DataFrame:
    return histories.select(F.explode("history").alias("item_id")).distinct()


def lookup_left(items: DataFrame, vectors: DataFrame) -> DataFrame:
    """Every item with its vector; empty for items without a record. Joined by key, not by position."""
    empty = F.array().cast("array<double>")
    return items.join(vectors, "item_id", "left").select(
        "item_id", F.coalesce("vec", empty).alias("vec"))


def lookup_table(histories: DataFrame, vectors: DataFrame) -> DataFrame:
    """``item_id``, ``vec`` of the items that occur in a history and have a vector."""
    return (
        vectors.where(F.size("vec") > 0)
        .join(distinct_items(histories), "item_id", "left_semi")
        .select("item_id", "vec")
    )


def lookup_of_features(histories: DataFrame, features: DataFrame, feature: str = FEATURE) -> DataFrame:
    """``lookup_table`` from feature records; only the records of items that occur are parsed."""
    occurring = occurring_features(features, distinct_items(histories))
    return decode_features(occurring, feature).where(F.size("vec") > 0)


def _in_reading_order(*fields: str) -> Column:
    return F.sort_array(F.collect_list(F.struct("pos", *fields)))


def sequence_key(items: Column | str) -> Column:
    """A stable name of an id list, usable for regrouping, ordering and splitting."""
    return F.sha2(F.to_json(items), 256)


def _spread_items(lists: DataFrame, name: str) -> DataFrame:
    """One row per item of distinct id lists: ``key``, ``pos``, ``item_id``, partitioned by ``key``.

    Id lists are tiny next to what they become, so they are spread with a given number of partitions,
    which adaptive execution keeps instead of merging them by the bytes of the ids.
    """
    n = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        lists.select(sequence_key(name).alias("key"), name)
        .repartition(n, "key")
        .select("key", F.posexplode(name).alias("pos", "item_id"))
    )


def _kept_items(histories: DataFrame, condition_side: DataFrame, how: str, min_items: int) -> DataFrame:
    """Distinct id lists after the items that do not resolve are gone: ids only, no vectors."""
    items = _spread_items(histories.select("history").distinct(), "history")
    return (
        items.join(condition_side.select("item_id"), "item_id", how)
        .groupBy("key").agg(_in_reading_order("item_id").alias("kept"))
        .select(F.col("kept.item_id").alias("items"))
        .where(F.size("items") >= min_items)
        .distinct()
    )


def sequences_with_padding(histories: DataFrame, flags: DataFrame, min_items: int = MIN_RESOLVED) -> DataFrame:
    """The sequences of ``resolve_histories`` without their vectors: ``seq_id``, ``items`` and ``pads``.

    ``flags`` has ``item_id`` and ``is_pad`` (whether its vector is padding) of every item that has a vector.
    """
    items = _spread_items(histories.select("history").distinct(), "history")
    return (
        items.join(flags.select("item_id", "is_pad"), "item_id")
        .groupBy("key").agg(_in_reading_order("item_id", "is_pad").alias("kept"))
        .select(F.col("kept.item_id").alias("items"), F.col("kept.is_pad").alias("pads"))
        .where(F.size("items") >= min_items)
        .distinct()
        .select(sequence_key("items").alias("seq_id"), "items", "pads")
    )


def join_vectors(items: DataFrame, lookup: DataFrame, by: str | None = None) -> DataFrame:
    """``items`` with ``vec`` of their item_id, NULL for items that ``lookup`` (stored, one row per item) doesn't have.

    A lookup of at most SENT_BYTES is broadcast; of a larger one, the vectors of the items that occur, if these fit. Both leave
    ``items`` partitioned by ``by``, so that its rows can go back together without moving a vector. Otherwise
    only the vectors of hot items are broadcast: fewer items than
    fit into SENT_BYTES (and than HOT_PARTS) have more than that fraction of all rows. The others are
    joined by a shuffle, in which an item has few rows.
    """
    lookup = lookup.select("item_id", "vec")
    n, size = lookup.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    vector_bytes = 8 * max(size, 1) + 16
    if n * vector_bytes <= SENT_BYTES:
        return items.join(F.broadcast(lookup), "item_id", "left")
    items = written_table(items, "items-to-join")
    counts = written_table(
        items.groupBy("item_id").agg(F.count("*").alias("n")).where("item_id is not null"), "item-counts")
    if counts.count() * vector_bytes <= SENT_BYTES:
        occurring = written_table(lookup.join(F.broadcast(counts.select("item_id")), "item_id", "left_semi"), "occurring-vectors")
        if by:
            items = items.repartition(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)
        return items.join(F.broadcast(occurring), "item_id", "left")
    most = max(1, min(HOT_PARTS, SENT_BYTES // vector_bytes))
    hot = written_table(
        counts.where(F.col("n") * most > items.count()).select("item_id").join(lookup, "item_id", "left"), "hot-items")
    rare = items.join(F.broadcast(hot.select("item_id")), "item_id", "left_anti").join(
        lookup.hint("shuffle_merge"), "item_id", "left")
    return items.join(F.broadcast(hot), "item_id").unionByName(rare)


def _attach(sequences: DataFrame, lookup: DataFrame, vec: Column) -> DataFrame:
    """Vectors for distinct ``items`` lists; the one place where vectors move."""
    return (
        join_vectors(_spread_items(sequences, "items"), lookup, "key")
        .select("key", "pos", "item_id", vec.alias("vec"))
        .groupBy("key").agg(_in_reading_order("item_id", "vec").alias("rows"))
        .select(F.col("key").alias("seq_id"), F.col("rows.item_id").alias("items"),
                F.arrays_zip(F.col("rows.item_id").alias("item_id"), F.col("rows.vec").alias("vec")).alias("value"))
    )


def resolve_histories(histories: DataFrame, lookup: DataFrame, min_items: int = MIN_RESOLVED) -> DataFrame:
    """Distinct resolved sequences: ``seq_id``, ``items``, ``value`` (array of ``item_id``, ``vec``).

    Items without a vector are dropped; sequences left with fewer than ``min_items`` items are too.
    ``lookup`` holds one row per item and should be stored, as it is read more than once.
    """
    known = lookup.where(F.size("vec") > 0)
    return _attach(_kept_items(histories, known, "left_semi", min_items), known, F.col("vec"))


def resolve_histories_padded(histories: DataFrame, lookup: DataFrame, dim: int = DEFAULT_DIM,
                             min_items: int = MIN_RESOLVED) -> DataFrame:
    """As ``resolve_histories``, but an item without a record becomes padding instead of being dropped.

    An item whose record has an empty vector is still dropped.
    """
    empty = lookup.where(F.size("vec") == 0)
    kept = _kept_items(histories, empty, "left_anti", min_items)
    return _attach(kept, lookup, F.coalesce(F.col("vec"), zero_vector(dim)))
