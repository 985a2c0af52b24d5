"""Log quality (L) and customer analyses (A) over the ``raw_log_lines`` view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.operators import analyses, ledger, validation
from proofline.operators.duplicates import is_analytical, resolve_duplicates
from proofline.plans import log_quality
from proofline.session import ensure_settings, shared_folder
from proofline.sources import lines, views
from proofline.sources.sinks import read_table_csv

LOG_PATH = "raw_log_lines.jsonl"
# Lines per staged text file: files stay small whatever the size of the log.
FILE_LINES = 100_000
GUARD_BYTES = 200
# Bytes per split of these files when their lines are numbered.
SPLIT_BYTES = 1 << 20


def line_set(spark: SparkSession, folder: str) -> lines.LineSet:
    ensure_settings(spark)
    return lines.from_table(views.raw_log_lines(spark, folder), LOG_PATH)


def checked(spark: SparkSession, folder: str) -> DataFrame:
    return validation.check_lines(line_set(spark, folder).lines)


def stage_checked(spark: SparkSession, folder: str) -> DataFrame:
    """The checked lines, parsed once and stored."""
    path = shared_folder(spark, "checked")
    checked(spark, folder).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def published(spark: SparkSession, folder: str) -> log_quality.Published:
    """Ledger and clean records of one run that parses every line once."""
    return log_quality.publish(line_set(spark, folder), shared_folder(spark, "published"))


def stage_log_files(spark: SparkSession, folder: str, file_lines: int = FILE_LINES) -> str:
    """Write the log as text files of ``file_lines`` consecutive source lines each."""
    ensure_settings(spark)
    path = shared_folder(spark, "log-files")
    rows = views.raw_log_lines(spark, folder).withColumn(
        "block", F.floor(F.col("source_line") / file_lines)
    )
    (
        rows.repartition("block")
        .sortWithinPartitions("block", "source_line")
        .select("block", "raw_line")
        .write.partitionBy("block")
        .text(path)
    )
    return path


def _block(path: Column) -> Column:
    return F.regexp_extract(path, "block=([0-9]+)", 1).cast("long")


def issue_text(issues: str = "issues") -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    return F.array_join(
        F.transform(
            issues,
            lambda i: F.concat_ws(
                "|",
                i["issue_code"],
                blank(i["field"]),
                blank(i["original_value"]),
                blank(i["normalized_value"]),
                i["action"],
            ),
        ),
        ";",
    )


def normalization_text() -> Column:
    return F.array_join(
        F.transform(
            "normalizations",
            lambda n: F.concat_ws("|", n["field"], n["original_value"], n["normalized_value"]),
        ),
        ";",
    )


def instant_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def shown(result: DataFrame) -> DataFrame:
    """A result with days as text and fractions rounded, so that any engine writes the same."""
    kinds = {"double": lambda c: F.round(c, 6), "date": lambda c: F.col(c).cast("string")}
    return result.withColumns({c: kinds[kind](c) for c, kind in result.dtypes if kind in kinds})


# ---------------------------------------------------------------- L


def physical_lines(spark, folder):
    """Lines of log files that are read in several splits each, with their numbers in their file."""
    path = stage_log_files(spark, folder)
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, str(SPLIT_BYTES))
    try:
        staged = lines.stage_scan(lines.scan_text(spark, path))
    finally:
        spark.conf.set(split, before)
    found = lines.number_lines(staged)
    return found.select(
        _block(F.col("source_path")).alias("block"), "source_line", "raw_line", "byte_length"
    )


def source_fingerprint(spark, folder):
    found = lines.file_fingerprints(spark, stage_log_files(spark, folder), "*.txt")
    return found.select(_block(F.col("source_path")).alias("block"), "byte_size", "source_sha256")


def line_size_guard(spark, folder):
    guarded = validation.guard_lines(line_set(spark, folder).lines, GUARD_BYTES)
    return guarded.select("source_line", "byte_length", "guard_code")


def utf8_check(spark, folder):
    """Documents as lines another program saved in Latin-1 instead of UTF-8, checked like any log line."""
    ensure_settings(spark)
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xff]", "?"), "ISO-8859-1").cast("string")
    rows = views.table(spark, folder, "documents").select("doc_id", latin.alias("value"))
    found = rows.select(
        F.lit(0).cast("long").alias("file_no"),
        F.col("doc_id").alias("source_line"),
        F.col("doc_id").alias("line_seq"),
        F.make_valid_utf8("value").alias("raw_line"),
        (F.octet_length("value") + 1).cast("long").alias("byte_length"),
        F.is_valid_utf8("value").alias("text_valid"),
    )
    return validation.check_lines(found).select(
        F.col("source_line").alias("doc_id"),
        F.get("issues", F.lit(0))["issue_code"].alias("issue_code"),
        F.size("issues").cast("long").alias("issues"),
        F.col("first_action").alias("final_action"),
    )


def parse_json_object(spark, folder):
    parsed = validation.parse_records(line_set(spark, folder).lines)
    kinds = [F.col(f"{f}_kind") for f in (*validation.REQUIRED_FIELDS, *validation.OPTIONAL_FIELDS)]
    return parsed.select(
        "source_line",
        "json_status",
        F.concat_ws(",", *kinds).alias("kinds"),
        F.array_join(F.col("extra_fields.field"), ",").alias("extra_keys"),
    )


def record_digest(spark, folder):
    return checked(spark, folder).select("source_line", "record_digest")


def _issues_of(*codes: str):
    def query(spark, folder):
        found = checked(spark, folder).select("source_line", F.inline("issues"))
        return found.filter(F.col("issue_code").isin(*codes)).select(
            "source_line", "issue_code", "field", "original_value"
        )

    return query


def issue_catalog(spark, folder):
    found = published(spark, folder).ledger.select(F.explode("issues.issue_code").alias("issue_code"))
    counts = found.groupBy("issue_code").agg(F.count(F.lit(1)).alias("n"))
    return (
        validation.issue_catalog(spark)
        .join(counts, "issue_code", "left")
        .select("issue_code", "action", "reason", F.coalesce("n", F.lit(0)).cast("long").alias("occurrences"))
    )


def final_action(spark, folder):
    return checked(spark, folder).select("source_line", F.col("first_action").alias("final_action"))


def exact_duplicates(spark, folder):
    return resolve_duplicates(stage_checked(spark, folder)).select(
        "source_line", "record_digest", "final_action", "retained_source_line"
    )


def _analytical(spark, folder):
    return checked(spark, folder).filter(is_analytical(F.col("first_action")))


def normalize_timestamps(spark, folder):
    return ledger.normalize_timestamps(_analytical(spark, folder)).select(
        "source_line",
        instant_text("timestamp_utc"),
        F.col("event_date_utc").cast("string").alias("event_date_utc"),
        "timestamp_offset_raw",
    )


def classify_errors(spark, folder):
    return ledger.normalize_errors(_analytical(spark, folder)).select(
        "source_line", F.col("level_value").alias("level"), "error_type"
    )


def message_parameters(spark, folder):
    return ledger.normalize_errors(_analytical(spark, folder)).select(
        "source_line", "error_code", "related_component", "path", "error_parameters_json"
    )


def normalization_evidence(spark, folder):
    return published(spark, folder).ledger.select("source_line", normalization_text().alias("evidence"))


def clean_records(spark, folder):
    return ledger.clean_records(line_set(spark, folder)).withColumns(
        {
            "timestamp_utc": instant_text("timestamp_utc"),
            "event_date_utc": F.col("event_date_utc").cast("string"),
        }
    )


def quality_ledger(spark, folder):
    return published(spark, folder).ledger.select(
        "source_path",
        "source_sha256",
        "source_line",
        "record_digest",
        "raw_line",
        issue_text().alias("issues"),
        normalization_text().alias("normalizations"),
        "final_action",
        "retained_source_line",
    )


def row_conservation(spark, folder):
    run = published(spark, folder)
    return ledger.row_conservation(run.ledger, run.clean)


def trace_line(spark, folder):
    """One request per event, for the line after its own: analytical, rejected, or outside the log."""
    run = published(spark, folder)
    requests = views.table(spark, folder, "events").select(
        F.lit(0).cast("long").alias("file_no"), (F.col("event_id") * 2 + F.col("event_id") % 3).alias("source_line")
    )
    return ledger.trace_requests(requests, run.ledger, run.clean).select(
        "source_line",
        "status",
        "final_action",
        "retained_source_line",
        "service",
        "level",
        "error_type",
        instant_text("timestamp_utc"),
        "service_error_count",
    )


def schema_contract(spark, folder):
    return ledger.schema_contract(published(spark, folder).clean)


# ---------------------------------------------------------------- A


def service_counts_by_level(spark, folder):
    return analyses.service_error_counts(ledger.clean_records(line_set(spark, folder)), "WARN")


def service_error_counts(spark, folder):
    return analyses.service_error_counts(ledger.clean_records(line_set(spark, folder)))


def daily_error_counts(spark, folder):
    return shown(analyses.daily_error_counts(published(spark, folder).clean))


def top_error_types(spark, folder):
    return analyses.top_error_types(published(spark, folder).clean)


def quality_reconciliation(spark, folder):
    run = published(spark, folder)
    return analyses.quality_reconciliation(run.ledger, run.clean)


def unclassified_rate(spark, folder):
    return analyses.unclassified_rate(published(spark, folder).clean).withColumns(
        {name: F.round(name, 6) for name in ("share_of_rows", "share_of_errors")}
    )


def report_facts(spark, folder):
    run = published(spark, folder)
    return analyses.report_facts(run.ledger, run.clean)


def run_analysis(spark, folder):
    """Every registered analysis by id, as ``(analysis_id, row_text)`` with all columns of its rows."""
    run = published(spark, folder)
    parts = []
    for analysis_id in analyses.ANALYSES:
        result = shown(analyses.run_analysis(analysis_id, run.ledger, run.clean))
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in result.columns]
        parts.append(result.select(F.lit(analysis_id).alias("analysis_id"), F.concat_ws("|", *cells).alias("row_text")))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def analysis_files(spark, folder):
    """What the CSV files of all published analyses say of services, classes and reconciliation, read back as text."""
    paths = log_quality.publish_analyses(published(spark, folder), shared_folder(spark, "analysis-files"))
    parts = []
    for analysis_id, path in paths.items():
        if analysis_id != "daily-error-counts":
            columns = analyses.ANALYSES[analysis_id].columns
            cells = [F.coalesce(F.col(c), F.lit("")) for c in columns]
            rows = read_table_csv(spark, path, list(columns))
            parts.append(rows.select(F.lit(analysis_id).alias("analysis_id"), F.concat_ws("|", *cells).alias("row_text")))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


QUERIES = {
    "physical_lines": physical_lines,
    "source_fingerprint": source_fingerprint,
    "line_size_guard": line_size_guard,
    "utf8_check": utf8_check,
    "parse_json_object": parse_json_object,
    "record_digest": record_digest,
    "required_field_issues": _issues_of(
        "REQUIRED_FIELD_MISSING", "REQUIRED_FIELD_TYPE", "REQUIRED_FIELD_EMPTY"
    ),
    "timestamp_issues": _issues_of("TIMESTAMP_INVALID", "TIMESTAMP_OFFSET_MISSING"),
    "level_issues": _issues_of("LEVEL_UNKNOWN"),
    "trace_id_issues": _issues_of("TRACE_ID_TYPE"),
    "unexpected_fields": _issues_of("UNEXPECTED_FIELD"),
    "issue_catalog": issue_catalog,
    "final_action": final_action,
    "exact_duplicates": exact_duplicates,
    "normalize_timestamps": normalize_timestamps,
    "classify_errors": classify_errors,
    "message_parameters": message_parameters,
    "normalization_evidence": normalization_evidence,
    "clean_records": clean_records,
    "quality_ledger": quality_ledger,
    "row_conservation": row_conservation,
    "trace_line": trace_line,
    "schema_contract": schema_contract,
    "service_counts_by_level": service_counts_by_level,
    "service_error_counts": service_error_counts,
    "daily_error_counts": daily_error_counts,
    "top_error_types": top_error_types,
    "quality_reconciliation": quality_reconciliation,
    "unclassified_rate": unclassified_rate,
    "report_facts": report_facts,
    "run_analysis": run_analysis,
    "analysis_files": analysis_files,
}
