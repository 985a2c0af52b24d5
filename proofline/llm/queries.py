"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.llm import (
    block_dedup,
    exact_dedup,
    hard_negatives,
    language_id,
    line_quality,
    packing,
    periodic_runs,
    piece_stream,
    preference,
    revisits,
    simhash,
    suffix_dedup,
    tree_bpe,
)
from proofline.llm.staging import documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    predicted = language_id.identify(docs, language_id.fit(docs))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without any string of 400 bytes that occurs elsewhere."""
    return suffix_dedup.digest_columns(suffix_dedup.repeated_strings(documents(spark, sf_dir), keep_first=False))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    groups = exact_dedup.exact_groups(documents(spark, sf_dir), exact_dedup.even_half())
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of windows of 4096 tokens."""
    return packing.pack(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), with_ids=False)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; the field is fitted on ``labels``."""
    docs = documents(spark, sf_dir)
    field = line_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_quality.judge(docs, field)


def op6_block_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 50 words that an earlier document has."""
    return block_dedup.digest_columns(block_dedup.repeated_passages(documents(spark, sf_dir)))


def op7_piece_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and checksum of every document's ids, and the digest of what they decode to."""
    return piece_stream.digests(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every not-modified record derived from ``pages`` with its original's payload and merged headers."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = revisits.resolve(revisits.records_of_pages(pages))
    shown = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return found.select(
        "record_id", "canonical_url", "original_id", "outcome", shown.alias("headers"), F.sha2("payload", 256).alias("payload_sha256")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    groups = simhash.near_groups(documents(spark, sf_dir))
    return groups.select("doc_id", simhash.hexadecimal("fingerprint").alias("fingerprint"), "component_id")


def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A preference pair of every conversation and a rejected version of it."""
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    chosen = talks.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    pairs = preference.format_pairs(chosen, preference.rejected_of(talks))
    return pairs.withColumns({c: preference.mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best scored negatives of every hundredth vector and its positives; every seventh label is moved on."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's ids, and the digest of what they decode to."""
    return tree_bpe.digests(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which end in a loop, and the digest of what is left without repetitions."""
    docs = documents(spark, sf_dir)
    looped = docs.select("doc_id", periodic_runs.looped_tails(F.col("text"), F.col("doc_id")).alias("text"))
    best = F.col("best")
    return periodic_runs.periodic_runs(looped).select(
        "doc_id",
        "n_runs",
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        "runs_sha256",
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; they are installed beside Python, not kept here."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_packing": op4_packing,
    "op5_line_quality": op5_line_quality,
    "op6_block_dedup": op6_block_dedup,
    "op7_piece_stream": op7_piece_stream,
    "op8_revisits": op8_revisits,
    "op9_simhash": op9_simhash,
    "op10_preference": op10_preference,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_tree_bpe": op12_tree_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}
