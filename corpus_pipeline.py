"""From raw documents to packed windows: five stages, each a table that the next one reads.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given; all but the last return the
columns of ``documents``.  Decisions about equal texts and cut strings hold for an id and its text, so texts that share an id are told
apart; of near-duplicates, rows that share an id go or stay together.  Rows with a null ``doc_id`` are dropped or
changed by no duplicate stage; null texts are rejected by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.llm import exact_dedup, language_id, packing, simhash, suffix_dedup
from proofline.llm.queries import vocabulary
from proofline.llm.staging import documents, stage

# A column that no table of documents has.
DIGEST = "_text_digest"
# Bytes of the strings that are cut: fifty words of four letters with their spaces; and of the grams they are met by.
PASSAGE, GRAM = 250, 80


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id``, and text if ``dropped`` has its ``digest``, is not in ``dropped``."""
    if "digest" not in dropped.columns:
        return docs.join(dropped.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    pairs = dropped.select("doc_id", F.col("digest").alias(DIGEST))
    return _digested(docs).join(pairs, ["doc_id", DIGEST], "left_anti").select(*docs.columns)


def _digested(docs: DataFrame) -> DataFrame:
    return docs.withColumn(DIGEST, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in none of the corpus's languages."""
    return language_id.accepted(docs, language_id.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the document with the largest id."""
    groups = exact_dedup.exact_groups(docs, exact_dedup.even_half())
    return _without(docs, groups.filter("not kept").select("doc_id", "digest"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates keep the document with the smallest id."""
    groups = simhash.near_groups(docs)
    return _without(docs, groups.filter("doc_id <> component_id"))


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings that occurred before, in the order of ids; their first copies stay.

    A passage of over fifty words is cut: of ordinary words it has more than ``PASSAGE`` bytes.
    """
    found = suffix_dedup.repeated_strings(docs, keep_first=True, length=PASSAGE, gram=GRAM)
    changed = found.filter("kept_text is not null").select("doc_id", F.col("digest").alias(DIGEST), "kept_text")
    changed = changed.dropDuplicates(["doc_id", DIGEST])
    text = F.coalesce("kept_text", "text")
    columns = {"text": text} | ({"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {})
    return _digested(docs).join(changed, ["doc_id", DIGEST], "left").withColumns(columns).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into windows of tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeated_strings),
    ("packing", pack_windows),
]

# Language models, packing by dynamic programming and XXH64 are beyond SQL; tests compare the stages with
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored before the next one reads it."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
