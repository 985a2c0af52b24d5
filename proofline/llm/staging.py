"""Tables written once and read back, and frames that cover any input columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.session import shared_folder


def stage(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage, so a lost executor costs a re-read and not a recomputation, and a table
    used twice is computed once.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id`` and ``text`` alone, whatever other columns there are; a null text is empty."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
