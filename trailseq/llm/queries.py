"""Registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailseq.llm import common, decontaminate, doc_fingerprint, filter_audit, hard_negatives, hmm, langid, line_dedup, minhash, mixing, packing, pii, substring_dedup, warc

from trailseq.session import written_table


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(common.table(spark, sf_dir, "documents"))


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the records back and list what they say."""
    return warc.index(warc.read(spark, warc.write(common.table(spark, sf_dir, "pages"))))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return doc_fingerprint.fingerprints(common.table(spark, sf_dir, "documents"))


def text_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and hidden Markov log10 probability of every document."""
    return hmm.score(common.table(spark, sf_dir, "documents"))


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    return packing.pack(common.table(spark, sf_dir, "documents"), tokenizer_path())


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.find(common.table(spark, sf_dir, "documents"))
    base = {k: F.col(k) for k in pii.PATTERNS}
    both = {k: F.concat(F.col(k), pii.added_of(k)) for k in pii.PATTERNS}
    return found.select(
        "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in pii.PATTERNS),
        F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(both).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"))


def lines_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines that no earlier line equals or is within one edit of, as a digest."""
    kept = line_dedup.dedup_lines(common.table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain, each with its place and number of edits."""
    return decontaminate.contaminated(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that no repeated window of 13 words covers, as a digest."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return minhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector has another label than the table says."""
    embeddings = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = written_table(hard_negatives.quantized(embeddings.withColumn("label", label)), "quantized")
    return hard_negatives.mine(rows, rows.where("vec_id % 100 = 0"))


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source, in all their orders."""
    return filter_audit.audit(filter_audit.failures(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")))


def edited_text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op7's rows: lengths, and digests of the edited texts."""
    return document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def unigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op8's rows: folds, counts and the base score."""
    return text_likelihood(spark, sf_dir).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


ALL = {
    "op1_bootstrapped_pii": personal_data,
    "op2_deletion_neighbourhood": lines_deduplicated,
    "op3_language_bitmask": language_id,
    "op4_content_addressed_warc": warc_archive,
    "op5_suffix_trees": repeats_removed,
    "op6_cgk_decontamination": benchmark_passages,
    "op7_paragraph_sketch": document_fingerprints,
    "op8_hidden_markov": text_likelihood,
    "op9_bounded_packing": packed_sequences,
    "op10_bbit_minhash": near_duplicates,
    "op11_entropy_balancing": source_mixture,
    "op12_slot_negatives": hard_negative_mining,
    "op13_potential_audit": filter_interactions,
    "edited_text_digests": edited_text_digests,
    "unigram_scores": unigram_scores,
}
