"""Knowledge-base documents: from a folder of Markdown files, or from any table with text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``source_path, file_name, sha256, md_text`` of the ``*.md`` files directly in ``path``.

    The digest covers the bytes; in the text every kind of line end becomes ``\\n``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(path)
    return files.select(
        F.col("path").alias("source_path"),
        F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"),
        F.sha2("content", 256).alias("sha256"),
        F.regexp_replace(F.decode("content", "UTF-8"), r"\r\n?", "\n").alias("md_text"),
    )


def from_table(table: DataFrame) -> DataFrame:
    """The same columns from ``file_name, md_text``."""
    return table.select(
        F.concat(F.lit("docs/"), F.col("file_name")).alias("source_path"),
        "file_name",
        F.sha2("md_text", 256).alias("sha256"),
        "md_text",
    )
