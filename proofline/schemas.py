"""Column contracts shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Values inside issues can be any JSON value; they travel as JSON text.
ISSUE = T.StructType(
    [
        T.StructField("issue_code", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("original_value", T.StringType()),
        T.StructField("normalized_value", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
NORMALIZATION = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("original_value", T.StringType()),
        T.StructField("normalized_value", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
EXTRA_FIELD = T.StructType(
    [T.StructField("field", T.StringType()), T.StructField("value_json", T.StringType())]
)


@dataclass(frozen=True)
class ContractColumn:
    """One published column: type, nullability and meaning."""

    name: str
    data_type: T.DataType
    nullable: bool
    description: str


CLEAN_CONTRACT = (
    ContractColumn("source_line", T.LongType(), False, "physical line number, from 1"),
    ContractColumn("source_sha256", T.StringType(), False, "digest of the source file"),
    ContractColumn("timestamp_raw", T.StringType(), False, "timestamp text as supplied"),
    ContractColumn("timestamp_utc", T.TimestampType(), False, "instant of the timestamp"),
    ContractColumn("event_date_utc", T.DateType(), False, "calendar day of the instant in UTC"),
    ContractColumn("timestamp_offset_raw", T.StringType(), False, "offset text as supplied"),
    ContractColumn("service", T.StringType(), False, "service name as supplied"),
    ContractColumn("level", T.StringType(), False, "INFO, WARN or ERROR"),
    ContractColumn("message_raw", T.StringType(), False, "message text as supplied"),
    ContractColumn("request_id", T.StringType(), False, "request identifier as supplied"),
    ContractColumn("trace_id", T.StringType(), True, "trace identifier when supplied"),
    ContractColumn("error_type", T.StringType(), True, "error class, ERROR rows only"),
    ContractColumn("error_code", T.StringType(), True, "parameter `code` of the message"),
    ContractColumn("related_component", T.StringType(), True, "parameter `component` of the message"),
    ContractColumn("path", T.StringType(), True, "parameter `path` of the message"),
    ContractColumn("error_parameters_json", T.StringType(), False, "all parameters, keys sorted"),
)

CLEAN_SCHEMA = T.StructType(
    [T.StructField(c.name, c.data_type, c.nullable) for c in CLEAN_CONTRACT]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_path", T.StringType()),
        T.StructField("source_sha256", T.StringType()),
        T.StructField("source_line", T.LongType()),
        T.StructField("record_digest", T.StringType()),
        T.StructField("raw_line", T.StringType()),
        T.StructField("issues", T.ArrayType(ISSUE)),
        T.StructField("normalizations", T.ArrayType(NORMALIZATION)),
        T.StructField("final_action", T.StringType()),
        T.StructField("retained_source_line", T.LongType()),
        T.StructField("file_no", T.LongType()),
        T.StructField("retained_file_no", T.LongType()),
    ]
)
