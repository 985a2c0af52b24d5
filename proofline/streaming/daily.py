"""Daily run: new text files in, ledger, curated and quarantined rows out.

A streaming query finds the files that arrived since the last run.  Each micro-batch is written
under its batch number and overwrites only that number, so a replay after a failure gives the same
tables.  Later steps read what was written instead of recomputing the batch; what only they need is removed when
the batch is published.  The digests of retained records are kept: a record seen in an earlier batch is a duplicate of it.

Curated rows are partitioned by day, then batch, and registered as a table of Spark's catalog, so that days can be asked for by the
table's name.  A batch replaces the partitions of its own rows only; a replay leaves other days and batches untouched.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.functions.messages import ErrorTaxonomy
from proofline.operators.duplicates import first_copies, is_analytical, resolve_duplicates, sent_if_short
from proofline.operators.history import DigestHistory
from proofline.operators.ledger import DEFAULT_TAXONOMY, clean_from_resolved, ledger_from_resolved
from proofline.operators.validation import check_lines
from proofline.schemas import LEDGER_SCHEMA
from proofline.sources.lines import (
    DEFAULT_MAX_LINE_BYTES,
    digests_of,
    number_lines,
    scan_text,
    scanned_files,
    stage_scan,
    stage_splits,
    with_digests,
)
from proofline.sources.sinks import path_exists, remove_path

# Tables that only the steps of one batch read.
_PASSING = ("scan", "splits", "checked", "copies", "resolved")


@dataclass(frozen=True)
class DailyTables:
    """Where a daily run keeps its tables, all below one shared folder."""

    root: str
    catalog_table: str | None = None

    @property
    def curated_table(self) -> str:
        """The name under which curated rows are registered: the one given, else one made from the folder."""
        return self.catalog_table or f"curated_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}"

    @property
    def history(self) -> DigestHistory:
        return DigestHistory(self.path("digests"))

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


def run_available(
    spark: SparkSession,
    incoming: str,
    tables: DailyTables,
    max_line_bytes: int = DEFAULT_MAX_LINE_BYTES,
    taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY,
    max_files_per_batch: int | None = None,
) -> int:
    """Process everything new in ``incoming`` and stop; returns the number of batches run."""
    # A new source remembers its files in the checkpoint, so every run starts where the last ended.
    stream = scan_text(spark, incoming, streaming=True, max_files=max_files_per_batch)
    done = []

    def process(batch: DataFrame, number: int) -> None:
        ingest_batch(batch, number, tables, max_line_bytes, taxonomy)
        done.append(number)

    query = (
        stream.writeStream.option("checkpointLocation", tables.path("checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(process)
        .start()
    )
    query.awaitTermination()
    # The query's own progress reports are a bounded list; a batch replayed after a failure counts once.
    return len(set(done))


def ingest_batch(
    scanned: DataFrame,
    batch_id: int,
    tables: DailyTables,
    max_line_bytes: int = DEFAULT_MAX_LINE_BYTES,
    taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY,
) -> None:
    """Check, resolve and publish one batch of scanned lines."""
    spark = scanned.sparkSession
    # File numbers go on where the earlier batches ended.
    staged = stage_scan(scanned, _part(tables, "scan", batch_id))
    splits = stage_splits(staged, _part(tables, "splits", batch_id))
    splits = splits.withColumn("file_no", F.col("file_no") + F.lit(_files_before(spark, tables, batch_id)))
    files = with_digests(scanned_files(splits), digests_of(staged, splits))
    files = spark.read.parquet(_overwrite(files, tables, "files", batch_id))
    lines = number_lines(staged, splits)
    checked = spark.read.parquet(_overwrite(check_lines(lines, max_line_bytes), tables, "checked", batch_id))
    wanted = checked.filter(is_analytical(F.col("first_action")))
    copies = first_copies(checked, tables.history.matching(spark, batch_id, wanted))
    copies = spark.read.parquet(_overwrite(copies, tables, "copies", batch_id))
    resolved = resolve_duplicates(checked, firsts=sent_if_short(copies))
    resolved = spark.read.parquet(_overwrite(resolved, tables, "resolved", batch_id))
    ledger = ledger_from_resolved(resolved, files, taxonomy)
    ledger_path = _overwrite(ledger, tables, "ledger", batch_id)
    written = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    _overwrite(written.filter(~is_analytical(F.col("final_action"))), tables, "quarantine", batch_id)
    publish_curated(clean_from_resolved(resolved, files, taxonomy), tables, batch_id)
    kept = resolved.filter(is_analytical(F.col("final_action")))
    tables.history.append(batch_id, kept.select("record_digest", F.col("line_seq").alias("retained_seq")))
    for name in _PASSING:
        remove_path(spark, _part(tables, name, batch_id))


def publish_curated(curated: DataFrame, tables: DailyTables, batch_id: int) -> None:
    """Replace the partitions (day, batch) of the rows, and make them known to the catalog."""
    spark = curated.sparkSession
    rows = curated.withColumn("batch_id", F.lit(batch_id).cast("long"))
    ordered = rows.select(*[c for c in curated.columns if c != "event_date_utc"], "event_date_utc", "batch_id")
    register_curated(spark, ordered.schema, tables)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ordered.write.mode("overwrite").insertInto(tables.curated_table)
    finally:
        spark.conf.set(mode, before)


def register_curated(spark: SparkSession, schema: T.StructType, tables: DailyTables) -> None:
    """Create the table over the folder unless it is there; partitions an earlier session wrote are found again."""
    if spark.catalog.tableExists(tables.curated_table):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    path = tables.path("curated")
    known = path_exists(spark, path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {tables.curated_table} ({columns}) USING parquet OPTIONS (compression 'zstd') "
        f"PARTITIONED BY (event_date_utc, batch_id) LOCATION '{path}'"
    )
    if known:
        spark.catalog.recoverPartitions(tables.curated_table)


def _files_before(spark: SparkSession, tables: DailyTables, batch_id: int) -> int:
    path = tables.path("files")
    if not path_exists(spark, path):
        return 0
    earlier = spark.read.parquet(path).filter(F.col("batch_id") < batch_id)
    last = earlier.agg(F.max("file_no").alias("last")).first()["last"]
    return 0 if last is None else last + 1


def _part(tables: DailyTables, name: str, batch_id: int) -> str:
    return f"{tables.path(name)}/batch_id={batch_id}"


def _overwrite(frame: DataFrame, tables: DailyTables, name: str, batch_id: int) -> str:
    """Write one batch's part of a table and return its path."""
    path = _part(tables, name, batch_id)
    frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path
