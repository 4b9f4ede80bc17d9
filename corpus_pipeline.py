"""The corpus pipeline: language ID, line dedup, near-duplicates, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.llm import common, decontaminate, langid, line_dedup, minhash, packing, queries
from trailseq.session import ship_package, written_table

#: A text of whose 4-grams the best language knows less than this share is in none of the languages.
LEAST_SCORE = 0.2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that are in one of the learned languages; texts without a letter are in none."""
    ship_package(spark)
    scored = langid.predict(docs, langid.train(docs))
    return scored.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that an earlier line equals or nearly equals, and documents of which only white space is left."""
    ship_package(spark)
    kept = line_dedup.dedup_lines(docs)
    empty = F.regexp_like("text", F.lit(r"^\s*$"))
    kept = kept.where((F.col("n_removed") == 0) | ~empty)
    changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component; rows without an id stay."""
    ship_package(spark)
    dropped = written_table(minhash.near_duplicates(docs.select("doc_id", "text")).where(
        "not kept and doc_id is not null").select("doc_id").distinct(), "dropped")
    return docs.join(common.checked_side(dropped, minhash.BROADCAST_ROWS), "doc_id", "left_anti").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that contain no benchmark item."""
    ship_package(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences."""
    ship_package(spark)
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", lines_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The learned language filter and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
