"""Exact duplicates by record digest, for digests of any frequency.

A digest may belong to a third of all rows, so no step brings the rows of one digest together.
Rows are keyed by (digest, salt), the salt taken from their own position; the first position per
key is found with map-side combining, and only those partial results (at most ``SALTS`` per digest)
meet to find the overall first.  The rows then join back on the same salted key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.functions.sizing import fits_broadcast
from proofline.operators.validation import ACCEPT, REJECT, REPAIR, issue
from proofline.sources.lines import seq_file, seq_line

SALTS = 256


def is_analytical(action: Column) -> Column:
    """Whether rows with this disposition belong to the clean data."""
    return action.isin(ACCEPT, REPAIR)


def _salt() -> Column:
    return F.pmod(F.xxhash64("line_seq"), F.lit(SALTS)).cast("int")


def first_copies(checked: DataFrame, retained: DataFrame | None = None) -> DataFrame:
    """``record_digest, salt, first_seq`` for digests with more than one eligible row.

    ``retained`` (``record_digest, retained_seq``, unique digests) holds records kept in earlier
    batches; they come before anything in this one.
    """
    partial = (
        checked.filter(is_analytical(F.col("first_action")))
        .select("record_digest", "line_seq", _salt().alias("salt"))
        .groupBy("record_digest", "salt")
        .agg(F.min("line_seq").alias("salt_first"), F.count(F.lit(1)).alias("copies"))
    )
    same = Window.partitionBy("record_digest")
    firsts = partial.withColumn("first_seq", F.min("salt_first").over(same)).withColumn(
        "all_copies", F.sum("copies").over(same)
    )
    repeated = F.col("all_copies") > 1
    if retained is not None:
        # Both sides are narrow and hold few rows per digest, whatever a digest's frequency.
        firsts = firsts.join(
            retained.select("record_digest", F.col("retained_seq").alias("earlier_seq")),
            "record_digest",
            "left",
        ).withColumn("first_seq", F.coalesce("earlier_seq", "first_seq"))
        repeated = repeated | F.col("earlier_seq").isNotNull()
    return firsts.filter(repeated).select("record_digest", "salt", "first_seq")


def sent_if_short(copies: DataFrame) -> DataFrame:
    """A written list of copies, to be sent to every task if it is proven short: then rows with their texts are not shuffled for it."""
    return F.broadcast(copies) if fits_broadcast(copies, "record_digest") else copies


def resolve_duplicates(
    checked: DataFrame, retained: DataFrame | None = None, firsts: DataFrame | None = None
) -> DataFrame:
    """Add the duplicate issue, ``final_action`` and where the retained copy stands.

    A run that writes :func:`first_copies` first passes the written table as ``firsts``: its size
    is then known, and while it is small the rows join it without a shuffle.
    """
    eligible = is_analytical(F.col("first_action"))
    # Rows that take no part get a key of their own instead of NULL, which would all meet in one task.
    key = F.when(eligible, F.col("record_digest")).otherwise(F.col("line_seq").cast("string"))
    rows = checked.withColumn("salt", _salt()).withColumn("copy_key", key)
    repeated = (first_copies(checked, retained) if firsts is None else firsts).withColumnRenamed(
        "record_digest", "copy_key"
    )
    resolved = rows.join(repeated, ["copy_key", "salt"], "left").withColumn(
        "retained_seq", F.when(eligible, F.coalesce("first_seq", "line_seq"))
    )
    duplicate = F.coalesce(F.col("retained_seq") != F.col("line_seq"), F.lit(False))
    found = issue(
        "EXACT_DUPLICATE",
        None,
        F.concat(F.lit('"'), F.col("record_digest"), F.lit('"')),
        seq_line(F.col("retained_seq")).cast("string"),
    )
    return resolved.select(
        *[F.col(c) for c in checked.columns if c != "issues"],
        F.when(duplicate, F.concat("issues", F.array(found))).otherwise(F.col("issues")).alias("issues"),
        F.when(duplicate, F.lit(REJECT)).otherwise(F.col("first_action")).alias("final_action"),
        "retained_seq",
        seq_line(F.col("retained_seq")).alias("retained_source_line"),
        seq_file(F.col("retained_seq")).alias("retained_file_no"),
    )


def distinct_records(checked: DataFrame, *columns: str) -> DataFrame:
    """One row per retained record with ``columns`` and its first position ``line_seq``.

    Equal digests mean equal records, so every column taken from the record can be part of the
    grouping key: one aggregation with a long as its only state replaces the join back.
    """
    return (
        checked.filter(is_analytical(F.col("first_action")))
        .groupBy("record_digest", *columns)
        .agg(F.min("line_seq").alias("line_seq"))
    )
