"""The jobs' inputs, derived from the ``events`` and ``embeddings`` tables.

* item of an event: ``6 * props.k + length(event_type) - 4``
* history: the items of a reader in order of ``ts, event_id``, cut into consecutive pieces of 24, so a
  reader with any number of events gives many short histories and never one long array
* context: one per history and event type in it (the same history is seen again and again); the list is
  absent when the piece has no ``view`` event; attributes are counts and extremes of the piece
* feature record: one per embedding; no vector where ``label`` is 9, the zero vector where it is 8
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.functions.vectors import is_padding
from trailseq.operators import collect, numbering, prepare, resolve
from trailseq.session import written_table

DIM = 64
PIECE = 24


# Given schemas save the schema inference job of every read.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


ITEM = ("cast(get_json_object(props, '$.k') AS bigint) AS k",
        "cast(get_json_object(props, '$.k') AS bigint) * 6 + length(event_type) - 4 AS item_id")


def reading_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("user_id", "ts", "event_id", "event_type", "value", *ITEM)


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their rank per reader; a reader with a third of all events is numbered in many tasks."""
    events = table(spark, sf_dir, "events")
    ranked = numbering.ranks_within(events, "user_id", "ts", "event_id", carry=("event_type", "value", "props"))
    return ranked.selectExpr("user_id", "event_type", "value", *ITEM, "rank")


def reader_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per reader and piece: the history and the attributes of its events."""
    events = numbered_events(spark, sf_dir).withColumn("piece", F.expr(f"rank div {PIECE}"))
    counts = [F.expr(f"count_if(event_type = '{t}') AS n_{t}")
              for t in ("click", "error", "purchase", "signup", "view")]
    return events.groupBy("user_id", "piece").agg(
        F.expr("sort_array(collect_list(struct(rank, item_id))).item_id AS history"),
        F.expr("sort_array(collect_set(event_type)) AS types"),
        *counts,
        F.expr("min(k) AS min_k"), F.expr("max(k) AS max_k"),
        F.expr("cast(floor(max(value)) AS int) AS top_value"),
    )


def event_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id``, ``piece``, ``event_type`` and the ``environment`` struct."""
    names = ("n_click", "n_error", "n_purchase", "n_signup", "n_view", "min_k", "max_k", "user_id")
    ids = ", ".join(f"{code}, {name}" for code, name in zip(collect.ID_CODES, names, strict=True))
    purchase, signup = collect.INTEGER_CODES
    return reader_pieces(spark, sf_dir).selectExpr(
        "user_id", "piece", "explode(types) AS event_type",
        f"""named_struct(
            'ids', map_filter(map({ids}), (k, v) -> v > 0),
            'integers', map_filter(map({purchase}, if(n_purchase > 0, top_value, NULL), {signup}, if(n_signup > 0, 1, NULL)),
                                   (k, v) -> v IS NOT NULL),
            'lists', if(n_view > 0, map({collect.HISTORY_CODE}, cast(history AS array<int>)), map())
        ) AS environment""")


def collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect.collect_histories(event_contexts(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS item_id",
        f"""if(label = 9, map('label', cast(label AS string)), map(
            'label', cast(label AS string),
            '{resolve.FEATURE}', to_json(if(label = 8, array_repeat(0D, {DIM}), cast(embedding AS array<double>)))
        )) AS features""")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.decode_features(features(spark, sf_dir))


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item with a vector, also those nobody has read."""
    return vectors(spark, sf_dir).where(F.size("vec") > 0)


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_histories(collected(spark, sf_dir), written_table(vectors(spark, sf_dir), "vectors"))


def prepared_ids(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    """``seq_id``, ``items`` (at most 18), ``mask``, ``n_real``; no vectors."""
    known = lookup(spark, sf_dir) if known is None else known
    flags = known.select("item_id", is_padding("vec", DIM).alias("is_pad"))
    return prepare.prepare_ids(resolve.sequences_with_padding(collected(spark, sf_dir), flags))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``seq_id``, ``value`` (18 vectors), ``mask``, ``n_real``."""
    known = written_table(lookup(spark, sf_dir), "lookup")
    return prepare.attach_vectors(prepared_ids(spark, sf_dir, known), known, DIM)
