"""The whole log run: check, resolve, publish ledger and clean records, prove conservation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from proofline.functions.messages import ErrorTaxonomy
from proofline.operators.analyses import ANALYSES, run_analysis
from proofline.operators.duplicates import first_copies, resolve_duplicates, sent_if_short
from proofline.operators.ledger import (
    DEFAULT_TAXONOMY,
    clean_from_checked,
    ledger_counts,
    ledger_from_resolved,
    require_counts,
)
from proofline.operators.validation import check_lines
from proofline.schemas import LEDGER_SCHEMA
from proofline.sources.lines import DEFAULT_MAX_LINE_BYTES, LineSet
from proofline.sources.sinks import write_clean, write_ledger, write_table_csv


@dataclass(frozen=True)
class Published:
    """The tables as read back from where they were written."""

    ledger: DataFrame
    clean: DataFrame


def publish(
    source: LineSet,
    root: str,
    max_line_bytes: int = DEFAULT_MAX_LINE_BYTES,
    taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY,
) -> Published:
    """Write the checked lines once, then ledger and clean records from them, below ``root``.

    Lines are parsed a single time: the duplicate search, the ledger and the clean records all
    read the written check result, which also survives the loss of an executor.  The rows are counted while they are
    written; no table is read again to prove that none was lost.
    """
    spark = source.lines.sparkSession
    root = root.rstrip("/")
    lines, book, kept = Observation("lines"), Observation("ledger"), Observation("clean")
    files = _written(source.files, f"{root}/files")
    counted = check_lines(source.lines, max_line_bytes).observe(lines, F.count(F.lit(1)).alias("lines"))
    counted.write.option("compression", "zstd").parquet(f"{root}/checked")
    checked = spark.read.parquet(f"{root}/checked")
    copies = _written(first_copies(checked), f"{root}/copies")
    resolved = resolve_duplicates(checked, firsts=sent_if_short(copies))
    write_ledger(ledger_from_resolved(resolved, files, taxonomy).observe(book, *ledger_counts()), f"{root}/ledger")
    write_clean(clean_from_checked(checked, files, taxonomy), f"{root}/clean", observation=kept)
    require_counts(lines.get["lines"], book.get, kept.get)
    return Published(spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/ledger"), spark.read.parquet(f"{root}/clean"))


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def publish_analyses(run: Published, root: str) -> dict[str, str]:
    """Write the result of every registered analysis as CSV below ``root``; returns the path of each."""
    paths = {}
    for analysis_id in ANALYSES:
        paths[analysis_id] = f"{root.rstrip('/')}/{analysis_id}"
        write_table_csv(run_analysis(analysis_id, run.ledger, run.clean), paths[analysis_id])
    return paths
