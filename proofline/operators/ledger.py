"""The quality ledger, the clean records, and checks on both."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofline.functions.messages import ErrorTaxonomy, classify, parameter, parameter_pairs, parameters_json
from proofline.functions.text import quote_json
from proofline.functions.timestamps import iso_utc, offset_text
from proofline.operators.duplicates import distinct_records, is_analytical, resolve_duplicates
from proofline.operators.validation import (
    ACTIONS,
    OPTIONAL_FIELDS,
    REQUIRED_FIELDS,
    check_lines,
)
from proofline.schemas import CLEAN_CONTRACT, CLEAN_SCHEMA, LEDGER_SCHEMA, NORMALIZATION, ContractColumn
from proofline.sources.lines import DEFAULT_MAX_LINE_BYTES, LineSet, seq_file, seq_line

DEFAULT_TAXONOMY = ErrorTaxonomy()

# Published reasons of the two normalisations.
TIMESTAMP_REASON = "valid aware timestamp represented as the same UTC instant"
ERROR_REASON = "explicit ERROR signature taxonomy; raw message is retained"

_RECORD_COLUMNS = tuple(f"{f}_value" for f in (*REQUIRED_FIELDS, *OPTIONAL_FIELDS))


def normalize_timestamps(frame: DataFrame) -> DataFrame:
    """Add ``event_date_utc`` and ``timestamp_offset_raw`` next to ``timestamp_utc``."""
    return frame.withColumn("event_date_utc", F.to_date("timestamp_utc")).withColumn(
        "timestamp_offset_raw", offset_text(F.col("timestamp_value"))
    )


def normalize_errors(frame: DataFrame, taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY) -> DataFrame:
    """Add error class and message parameters; rows of other levels get none."""
    is_error = F.col("level_value") == "ERROR"
    error_type, details = classify(F.col("message_value"), taxonomy)
    return (
        frame.withColumn("error_type", F.when(is_error, error_type))
        .withColumn("error_details", F.when(is_error, details))
        .withColumn("error_pairs", parameter_pairs(F.col("error_details")))
        .withColumn("error_code", parameter(F.col("error_pairs"), "code"))
        .withColumn("related_component", parameter(F.col("error_pairs"), "component"))
        .withColumn("path", parameter(F.col("error_pairs"), "path"))
        .withColumn("error_parameters_json", parameters_json(F.col("error_pairs")))
        .drop("error_details", "error_pairs")
    )


def normalization_evidence() -> Column:
    """Evidence structs of an analytical row; an empty array for any other."""
    timestamp = F.struct(
        F.lit("timestamp").alias("field"),
        quote_json(F.col("timestamp_value")).alias("original_value"),
        quote_json(iso_utc(F.col("timestamp_utc"))).alias("normalized_value"),
        F.lit(TIMESTAMP_REASON).alias("reason"),
    )
    error = F.struct(
        F.lit("error_type").alias("field"),
        quote_json(F.col("message_value")).alias("original_value"),
        quote_json(F.col("error_type")).alias("normalized_value"),
        F.lit(ERROR_REASON).alias("reason"),
    )
    none = F.array().cast("array<" + NORMALIZATION.simpleString() + ">")
    analytical = is_analytical(F.col("final_action"))
    return (
        F.when(analytical & (F.col("level_value") == "ERROR"), F.array(timestamp, error))
        .when(analytical, F.array(timestamp))
        .otherwise(none)
    )


def ledger_from_resolved(
    resolved: DataFrame, files: DataFrame, taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY
) -> DataFrame:
    """Ledger rows from rows whose duplicates are resolved."""
    is_error = F.col("level_value") == "ERROR"
    typed = resolved.withColumn(
        "error_type", F.when(is_error, classify(F.col("message_value"), taxonomy)[0])
    ).withColumn("normalizations", normalization_evidence())
    return typed.join(files.select("file_no", "source_path", "source_sha256"), "file_no", "left").select(
        *LEDGER_SCHEMA.names
    )


def quality_ledger(
    source: LineSet,
    max_line_bytes: int = DEFAULT_MAX_LINE_BYTES,
    taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY,
) -> DataFrame:
    """Exactly one row per physical line with all issues and the final disposition."""
    resolved = resolve_duplicates(check_lines(source.lines, max_line_bytes))
    return ledger_from_resolved(resolved, source.files, taxonomy)


def clean_from_checked(
    checked: DataFrame, files: DataFrame, taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY
) -> DataFrame:
    """Typed analytical rows: the first copy of every valid record."""
    kept = distinct_records(checked, "timestamp_utc", *_RECORD_COLUMNS)
    return _publish_clean(kept.withColumn("file_no", seq_file(F.col("line_seq"))), files, taxonomy)


def clean_from_resolved(
    resolved: DataFrame, files: DataFrame, taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY
) -> DataFrame:
    """The same rows from a frame whose duplicates are already resolved."""
    kept = resolved.filter(is_analytical(F.col("final_action")))
    return _publish_clean(kept, files, taxonomy)


def _publish_clean(kept: DataFrame, files: DataFrame, taxonomy: ErrorTaxonomy) -> DataFrame:
    typed = normalize_errors(normalize_timestamps(kept), taxonomy)
    named = typed.join(files.select("file_no", "source_sha256"), "file_no", "left")
    renamed = {
        "source_line": seq_line(F.col("line_seq")),
        "timestamp_raw": F.col("timestamp_value"),
        "service": F.col("service_value"),
        "level": F.col("level_value"),
        "message_raw": F.col("message_value"),
        "request_id": F.col("request_id_value"),
        "trace_id": F.col("trace_id_value"),
    }
    return named.select(*[renamed.get(n, F.col(n)).alias(n) for n in CLEAN_SCHEMA.names])


def clean_records(
    source: LineSet,
    max_line_bytes: int = DEFAULT_MAX_LINE_BYTES,
    taxonomy: ErrorTaxonomy = DEFAULT_TAXONOMY,
) -> DataFrame:
    """Typed analytical rows straight from the lines."""
    return clean_from_checked(check_lines(source.lines, max_line_bytes), source.files, taxonomy)


def row_conservation(ledger: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: input = accepted + repaired + rejected, and accepted + repaired = clean rows."""
    tally = ledger.agg(
        F.count(F.lit(1)).alias("input_lines"),
        *[F.count_if(F.col("final_action") == a).alias(f"{a.lower()}_lines") for a in ACTIONS],
    )
    clean_rows = clean.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = F.col("accept_lines") + F.col("repair_lines")
    return tally.withColumn("clean_rows", clean_rows).select(
        "*",
        (F.col("input_lines") == kept + F.col("reject_lines")).alias("input_equals_actions"),
        (kept == F.col("clean_rows")).alias("analytical_equals_clean"),
    )


def require_conservation(ledger: DataFrame, clean: DataFrame) -> None:
    """Fail before publication when rows were lost or invented."""
    row = row_conservation(ledger, clean).first()
    if not (row["input_equals_actions"] and row["analytical_equals_clean"]):
        raise ValueError(f"row conservation failed: {row.asDict()}")


def ledger_counts() -> list[Column]:
    """Aggregates that a write of the ledger can observe: rows, and rows of each action."""
    return [F.count(F.lit(1)).alias("input"), *[F.count_if(F.col("final_action") == a).alias(a.lower()) for a in ACTIONS]]


def require_counts(lines: int, ledger: Mapping[str, int], clean: Mapping[str, int]) -> None:
    """Fail when rows were lost or invented, by what was counted while lines, ledger and clean rows were written."""
    kept = ledger["accept"] + ledger["repair"]
    if not (lines == ledger["input"] == kept + ledger["reject"] and kept == clean["clean"]):
        raise ValueError(f"row conservation failed: {lines} lines, ledger {dict(ledger)}, clean {dict(clean)}")


def trace_line(ledger: DataFrame, clean: DataFrame, source_line: int, file_no: int = 0) -> DataFrame:
    """Ledger row, clean row and single-row service count of one line; a rejected line is an error."""
    if source_line < 1:
        raise ValueError("source line must be a positive integer")
    entry = ledger.filter((F.col("source_line") == source_line) & (F.col("file_no") == file_no))
    found = entry.select("final_action").first()
    if found is None:
        raise ValueError(f"source line {source_line} is outside the input")
    if found["final_action"] not in ("ACCEPT", "REPAIR"):
        raise ValueError(f"source line {source_line} is rejected and cannot be traced analytically")
    return traced_lines(entry, clean)


def traced_lines(ledger: DataFrame, clean: DataFrame) -> DataFrame:
    """Every analytical line next to its clean row and its own service count."""
    record = clean.select(
        "source_line", "source_sha256", "service", "level", "timestamp_utc", "error_type"
    )
    return ledger.filter(is_analytical(F.col("final_action"))).join(
        record, ["source_sha256", "source_line"], "left"
    ).withColumn("service_error_count", (F.col("level") == "ERROR").cast("long"))


def trace_requests(requests: DataFrame, ledger: DataFrame, clean: DataFrame) -> DataFrame:
    """Answer every row ``file_no, source_line``: ``traced`` with its records, ``rejected`` or ``outside``."""
    entries = ledger.select("file_no", "source_line", "source_sha256", "final_action", "retained_source_line")
    found = requests.join(entries, ["file_no", "source_line"], "left")
    record = clean.select("source_line", "source_sha256", "service", "level", "timestamp_utc", "error_type")
    status = F.when(F.col("final_action").isNull(), F.lit("outside")).when(
        is_analytical(F.col("final_action")), F.lit("traced")
    )
    return (
        found.withColumn("status", status.otherwise(F.lit("rejected")))
        .join(record, ["source_sha256", "source_line"], "left")
        .withColumn("service_error_count", F.when(F.col("status") == "traced", (F.col("level") == "ERROR").cast("long")))
    )


def schema_contract(frame: DataFrame, contract: tuple[ContractColumn, ...] = CLEAN_CONTRACT) -> DataFrame:
    """One row per contract column: declared and actual type, NULLs found, and whether it holds."""
    actual = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    present = [c for c in contract if c.name in actual]
    nulls = frame.agg(*[F.count_if(F.col(c.name).isNull()).alias(c.name) for c in present])
    cells = [
        F.struct(
            F.lit(i + 1).cast("long").alias("position"),
            F.lit(c.name).alias("column_name"),
            F.lit(c.data_type.simpleString()).alias("declared_type"),
            F.lit(actual.get(c.name)).cast("string").alias("actual_type"),
            F.lit(c.nullable).alias("nullable"),
            (F.col(c.name) if c.name in actual else F.lit(None).cast("long")).alias("null_count"),
        )
        for i, c in enumerate(contract)
    ]
    rows = nulls.select(F.inline(F.array(*cells)))
    return rows.withColumn(
        "holds",
        F.coalesce(F.col("declared_type") == F.col("actual_type"), F.lit(False))
        & (F.col("nullable") | (F.col("null_count") == 0)),
    )


def require_columns(frame: DataFrame, expected: tuple[str, ...], name: str) -> DataFrame:
    """The frame itself, or an error when its columns are not the expected ones."""
    if tuple(frame.columns) != tuple(expected):
        raise ValueError(f"{name} returned {tuple(frame.columns)}, expected {tuple(expected)}")
    return frame
