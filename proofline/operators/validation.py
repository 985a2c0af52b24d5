"""From physical lines to checked records: issues, disposition, digest and typed timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.strict_json import MALFORMED, NOT_OBJECT, OBJECT, parse_objects
from proofline.functions.text import quote_json
from proofline.functions.timestamps import parse_timestamp
from proofline.sources.lines import DEFAULT_MAX_LINE_BYTES

ACCEPT, REPAIR, REJECT = "ACCEPT", "REPAIR", "REJECT"
ACTIONS = (ACCEPT, REPAIR, REJECT)

# Field names and levels of a log record.
REQUIRED_FIELDS = ("timestamp", "service", "level", "message", "request_id")
OPTIONAL_FIELDS = ("trace_id",)
LEVELS = ("INFO", "WARN", "ERROR")

# Every issue code with its action and its published reason.
ISSUE_CATALOG = {
    "LINE_TOO_LARGE": (REJECT, "physical line exceeds the {limit}-byte parsing limit"),
    "TEXT_INVALID_UTF8": (REJECT, "physical line is not valid UTF-8 and cannot be parsed as JSON text"),
    "JSON_MALFORMED": (REJECT, "physical line is not valid JSON"),
    "JSON_NOT_OBJECT": (REJECT, "JSON value must be an object representing one log record"),
    "REQUIRED_FIELD_MISSING": (REJECT, "required analytical field is missing"),
    "REQUIRED_FIELD_TYPE": (REJECT, "required analytical field must be a string"),
    "REQUIRED_FIELD_EMPTY": (REJECT, "required analytical field must not be empty"),
    "TIMESTAMP_INVALID": (REJECT, "timestamp is not ISO 8601"),
    "TIMESTAMP_OFFSET_MISSING": (REJECT, "timestamp must include a UTC offset or Z suffix"),
    "LEVEL_UNKNOWN": (REJECT, "level must be one of INFO, WARN, or ERROR for this fixed POC"),
    "TRACE_ID_TYPE": (REJECT, "optional trace_id must be a non-empty string"),
    "UNEXPECTED_FIELD": (ACCEPT, "unexpected field is retained in raw provenance but ignored analytically"),
    "EXACT_DUPLICATE": (REJECT, "canonical full-record digest was first retained at an earlier source line"),
    "SYNTHETIC_REPAIR": (
        REPAIR,
        "synthetic test-only example of a lossless, unambiguous, mechanically provable repair",
    ),
}


def issue(
    code: str,
    field: Column | str | None = None,
    original: Column | None = None,
    normalized: Column | None = None,
    **values: object,
) -> Column:
    """One issue struct; action and reason come from the catalogue."""
    action, reason = ISSUE_CATALOG[code]
    name = field if isinstance(field, Column) else F.lit(field).cast("string")
    empty = F.lit(None).cast("string")
    return F.struct(
        F.lit(code).alias("issue_code"),
        name.alias("field"),
        (empty if original is None else original).alias("original_value"),
        (empty if normalized is None else normalized).alias("normalized_value"),
        F.lit(action).alias("action"),
        F.lit(reason.format(**values)).alias("reason"),
    )


def issue_catalog(spark) -> DataFrame:
    """The catalogue as a table, for joins and for readers of the ledger."""
    rows = [(code, action, reason) for code, (action, reason) in ISSUE_CATALOG.items()]
    return spark.createDataFrame(rows, "issue_code string, action string, reason string")


def final_action(issues: Column) -> Column:
    """REJECT over REPAIR over ACCEPT; a row without issues is accepted."""
    return (
        F.when(F.exists(issues, lambda i: i["action"] == REJECT), F.lit(REJECT))
        .when(F.exists(issues, lambda i: i["action"] == REPAIR), F.lit(REPAIR))
        .otherwise(F.lit(ACCEPT))
    )


def guard_lines(lines: DataFrame, max_line_bytes: int = DEFAULT_MAX_LINE_BYTES) -> DataFrame:
    """Add ``guard_code`` for lines that must not be parsed: too large, or not UTF-8."""
    if max_line_bytes < 1:
        raise ValueError("max_line_bytes must be a positive integer")
    return lines.withColumn(
        "guard_code",
        F.when(F.col("byte_length") > max_line_bytes, F.lit("LINE_TOO_LARGE")).when(
            ~F.col("text_valid"), F.lit("TEXT_INVALID_UTF8")
        ),
    )


def parse_records(lines: DataFrame, max_line_bytes: int = DEFAULT_MAX_LINE_BYTES) -> DataFrame:
    """Guard and parse lines; only the columns later steps need cross into Python."""
    guarded = guard_lines(lines, max_line_bytes).withColumn(
        "json_text", F.when(F.col("guard_code").isNull(), F.col("raw_line"))
    )
    needed = ["file_no", "source_line", "line_seq", "byte_length", "guard_code", "raw_line", "json_text"]
    parsed = parse_objects(
        guarded.select(*needed), "json_text", [*REQUIRED_FIELDS, *OPTIONAL_FIELDS]
    )
    return parsed.drop("json_text")


def _raw(code: str, field: str = "", original: str = "null", text: bool = True) -> str:
    """SQL of an issue before the catalogue is looked up; ``text`` originals still need quoting."""
    name = f"'{field}'" if field else "cast(null as string)"
    return (
        f"named_struct('issue_code', '{code}', 'field', {name},"
        f" 'original', cast({original} as string), 'is_text', {str(text).lower()})"
    )


def _raw_of(code: str, field: str) -> str:
    """An issue about the field's own value."""
    return (
        f"named_struct('issue_code', '{code}', 'field', '{field}',"
        f" 'original', {field}_value, 'is_text', {field}_kind = 'string')"
    )


def _required(field: str) -> str:
    return (
        f"case when {field}_kind in ('absent', 'null') then {_raw('REQUIRED_FIELD_MISSING', field)}"
        f" when {field}_kind <> 'string' then {_raw_of('REQUIRED_FIELD_TYPE', field)}"
        f" when {field}_value = '' then {_raw_of('REQUIRED_FIELD_EMPTY', field)} end"
    )


_LEVEL_LIST = ", ".join(f"'{level}'" for level in LEVELS)
_TIMESTAMP = f"""case when timestamp_kind = 'string' and timestamp_value <> '' and parsed_timestamp.instant is null then
  if(parsed_timestamp.naive, {_raw_of("TIMESTAMP_OFFSET_MISSING", "timestamp")}, {_raw_of("TIMESTAMP_INVALID", "timestamp")}) end"""
_LEVEL = f"""case when level_kind = 'string' and level_value <> '' and level_value not in ({_LEVEL_LIST})
  then {_raw_of("LEVEL_UNKNOWN", "level")} end"""
_TRACE = f"""case when trace_id_kind not in ('absent', 'null') and (trace_id_kind <> 'string' or trace_id_value = '')
  then {_raw_of("TRACE_ID_TYPE", "trace_id")} end"""
_EXTRAS = """transform(extra_fields, e -> named_struct('issue_code', 'UNEXPECTED_FIELD', 'field', e.field,
  'original', e.value_json, 'is_text', false))"""
_LINE = f"""case when guard_code = 'LINE_TOO_LARGE' then {_raw("LINE_TOO_LARGE", "", "byte_length", False)}
  when guard_code = 'TEXT_INVALID_UTF8' then {_raw("TEXT_INVALID_UTF8")}
  when json_status = '{MALFORMED}' then {_raw("JSON_MALFORMED", "", "raw_line")}
  when json_status = '{NOT_OBJECT}' then {_raw("JSON_NOT_OBJECT", "", "canonical_json", False)} end"""
# Most rows take this way out: a complete record of strings with a valid time and nothing extra.
_HEALTHY = f"""json_status = '{OBJECT}' and parsed_timestamp.instant is not null and level_value in ({_LEVEL_LIST})
  and trace_id_kind in ('absent', 'null', 'string') and coalesce(trace_id_value, '-') <> '' and size(extra_fields) = 0
  and {" and ".join(f"{f}_kind = 'string' and {f}_value <> ''" for f in ("service", "message", "request_id"))}"""
_RAW_ISSUES = f"""case when {_HEALTHY} then array()
  when json_status = '{OBJECT}' then concat(
    filter(array({", ".join(_required(f) for f in REQUIRED_FIELDS)}, {_TIMESTAMP}, {_LEVEL}, {_TRACE}), i -> i is not null),
    {_EXTRAS})
  else array({_LINE}) end"""


def record_issues(raw: str = "raw_issues", max_line_bytes: int = DEFAULT_MAX_LINE_BYTES) -> Column:
    """Complete the raw issues: quoted originals, actions and reasons."""
    actions = F.create_map(*[F.lit(x) for code, (action, _) in ISSUE_CATALOG.items() for x in (code, action)])
    reasons = F.create_map(
        *[F.lit(x) for code, (_, why) in ISSUE_CATALOG.items() for x in (code, why.format(limit=max_line_bytes))]
    )
    return F.transform(
        raw,
        lambda i: F.struct(
            i["issue_code"].alias("issue_code"),
            i["field"].alias("field"),
            F.when(i["is_text"] & i["original"].isNotNull(), quote_json(i["original"]))
            .otherwise(i["original"])
            .alias("original_value"),
            F.lit(None).cast("string").alias("normalized_value"),
            F.element_at(actions, i["issue_code"]).alias("action"),
            F.element_at(reasons, i["issue_code"]).alias("reason"),
        ),
    )


def check_records(parsed: DataFrame, max_line_bytes: int = DEFAULT_MAX_LINE_BYTES) -> DataFrame:
    """Add ``issues``, ``first_action`` (before duplicates), ``record_digest``, ``timestamp_utc``."""
    timed = parsed.withColumn(
        "parsed_timestamp",
        F.when(F.col("timestamp_kind") == "string", parse_timestamp("timestamp_value")),
    )
    return (
        timed.withColumn("raw_issues", F.expr(_RAW_ISSUES))
        .withColumn("issues", record_issues("raw_issues", max_line_bytes))
        .withColumn("first_action", final_action(F.col("issues")))
        .withColumn(
            "record_digest",
            F.when(F.col("json_status") == OBJECT, F.sha2("canonical_json", 256)),
        )
        .withColumn("timestamp_utc", F.col("parsed_timestamp.instant"))
        .drop("parsed_timestamp", "raw_issues")
    )


def check_lines(lines: DataFrame, max_line_bytes: int = DEFAULT_MAX_LINE_BYTES) -> DataFrame:
    """Parse and check in one go: one row per physical line."""
    return check_records(parse_records(lines, max_line_bytes), max_line_bytes)
