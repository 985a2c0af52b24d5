"""SQL that recomputes the log queries from ``events`` and ``documents``."""

from __future__ import annotations

from catalog.logs import FILE_LINES, GUARD_BYTES, LOG_PATH
from proofline.sources import views

_TIMESTAMP = (
    "strftime(CASE WHEN user_id % 7 = 0 THEN ts + INTERVAL '7' HOUR ELSE ts END, '%Y-%m-%dT%H:%M:%S')"
    " || CASE WHEN user_id % 7 = 0 THEN '+07:00' ELSE 'Z' END AS t,"
)
RAW = f"rl AS ({views.RAW_LOG_LINES.replace('@TIMESTAMP@', _TIMESTAMP)})"
_SOURCE_LANES = ", ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::BIGINT)::VARCHAR" for i in range(4))
# A table of lines is known by its content: the count and four sums over the digests of all numbered lines.
SOURCE = f"""src AS MATERIALIZED (SELECT sha256(concat_ws(':', count(*)::VARCHAR, {_SOURCE_LANES})) AS source_sha256
  FROM (SELECT sha256(to_json([raw_line, source_line::VARCHAR])::VARCHAR) AS h FROM rl))"""

_FIELDS = ("timestamp", "service", "level", "message", "request_id", "trace_id")
_KIND = (
    "CASE WHEN j IS NULL THEN NULL WHEN json_type(j, '$.{f}') IS NULL THEN 'absent'"
    " ELSE CASE json_type(j, '$.{f}') WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string'"
    " WHEN 'BOOLEAN' THEN 'bool' WHEN 'DOUBLE' THEN 'float' WHEN 'ARRAY' THEN 'array'"
    " WHEN 'OBJECT' THEN 'object' ELSE 'int' END END AS {f}_kind"
)
PARSED = f"""
{RAW},
valid AS (SELECT source_line, raw_line, CASE WHEN json_valid(raw_line) THEN raw_line::JSON END AS v FROM rl),
typed AS (SELECT source_line, raw_line,
  CASE WHEN v IS NULL THEN 'MALFORMED' WHEN json_type(v) = 'OBJECT' THEN 'OBJECT' ELSE 'NOT_OBJECT' END AS json_status,
  v, CASE WHEN json_type(v) = 'OBJECT' THEN v END AS j FROM valid),
parsed AS (SELECT *, list_sort(json_keys(j)) AS keys,
  {", ".join(_KIND.format(f=f) for f in _FIELDS)},
  {", ".join(f"json_extract_string(j, '$.{f}') AS {f}_value" for f in _FIELDS)}
  FROM typed)
"""
_EXTRA = "list_filter(keys, lambda k: k NOT IN ('timestamp','service','level','message','request_id','trace_id'))"


def _required(field: str) -> str:
    return (
        f"CASE WHEN {field}_kind IN ('absent','null') THEN 'REQUIRED_FIELD_MISSING|{field}|||REJECT'"
        f" WHEN {field}_kind <> 'string' THEN 'REQUIRED_FIELD_TYPE|{field}|' || json_extract(j, '$.{field}')::VARCHAR || '||REJECT'"
        f" WHEN {field}_value = '' THEN 'REQUIRED_FIELD_EMPTY|{field}|\"\"||REJECT' END"
    )


_AWARE = r"'^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})$'"
_NAIVE = r"'^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$'"
CHECKED = f"""
{PARSED},
listed AS (SELECT *,
  CASE WHEN json_status = 'MALFORMED' THEN ['JSON_MALFORMED||' || to_json(raw_line)::VARCHAR || '||REJECT']
    WHEN json_status = 'NOT_OBJECT' THEN ['JSON_NOT_OBJECT||' || v::VARCHAR || '||REJECT']
    ELSE list_concat(list_filter([
      {", ".join(_required(f) for f in _FIELDS[:5])},
      CASE WHEN timestamp_kind = 'string' AND timestamp_value <> '' AND NOT regexp_matches(timestamp_value, {_AWARE})
        THEN CASE WHEN regexp_matches(timestamp_value, {_NAIVE}) THEN 'TIMESTAMP_OFFSET_MISSING' ELSE 'TIMESTAMP_INVALID' END
          || '|timestamp|' || to_json(timestamp_value)::VARCHAR || '||REJECT' END,
      CASE WHEN level_kind = 'string' AND level_value <> '' AND level_value NOT IN ('INFO','WARN','ERROR')
        THEN 'LEVEL_UNKNOWN|level|' || to_json(level_value)::VARCHAR || '||REJECT' END,
      CASE WHEN trace_id_kind NOT IN ('absent','null') AND (trace_id_kind <> 'string' OR trace_id_value = '')
        THEN 'TRACE_ID_TYPE|trace_id|' || json_extract(j, '$.trace_id')::VARCHAR || '||REJECT' END
      ], lambda x: x IS NOT NULL),
      list_transform({_EXTRA}, lambda k: 'UNEXPECTED_FIELD|' || k || '|' || json_extract(j, '$.' || k)::VARCHAR || '||ACCEPT'))
    END AS codes FROM parsed),
checked AS (SELECT *,
  CASE WHEN len(list_filter(codes, lambda c: c LIKE '%|REJECT')) > 0 THEN 'REJECT' ELSE 'ACCEPT' END AS first_action,
  CASE WHEN j IS NOT NULL THEN sha256('{{' || array_to_string(list_transform(keys, lambda k:
    to_json(k)::VARCHAR || ':' || json_extract(j, '$.' || k)::VARCHAR), ',') || '}}') END AS record_digest,
  CASE WHEN regexp_matches(timestamp_value, {_AWARE}) THEN
    strptime(substr(timestamp_value, 1, 19), '%Y-%m-%dT%H:%M:%S')
    - CASE WHEN timestamp_value LIKE '%+07:00' THEN INTERVAL '7' HOUR ELSE INTERVAL '0' HOUR END END AS at_utc
  FROM listed),
firsts AS (SELECT record_digest AS d, min(source_line) AS first_line FROM checked WHERE first_action = 'ACCEPT' GROUP BY 1),
resolved AS (SELECT c.* EXCLUDE (codes),
  CASE WHEN first_action = 'ACCEPT' THEN first_line END AS retained_source_line,
  CASE WHEN first_action = 'ACCEPT' AND first_line = source_line THEN 'ACCEPT' ELSE 'REJECT' END AS final_action,
  CASE WHEN first_action = 'ACCEPT' AND first_line <> source_line THEN list_append(codes,
    'EXACT_DUPLICATE||"' || record_digest || '"|' || first_line::VARCHAR || '|REJECT') ELSE codes END AS codes
  FROM checked c LEFT JOIN firsts ON c.record_digest = firsts.d)
"""
_TOKEN = "regexp_extract(message_value, '^ERR\\s+([A-Za-z][A-Za-z0-9_]*)', 1)"
_TYPE = f"""CASE WHEN level_value <> 'ERROR' THEN NULL
  WHEN {_TOKEN} = 'SMTPConnRefused' THEN 'SMTP_CONN_REFUSED'
  WHEN {_TOKEN} = 'PaymentDeclined' THEN 'PAYMENT_DECLINED'
  WHEN {_TOKEN} = 'ConnTimeout' THEN 'CONNECTION_TIMEOUT'
  WHEN {_TOKEN} = 'NullPointer' THEN 'NULL_POINTER'
  WHEN message_value LIKE '%HTTP 502%' THEN 'HTTP_502' ELSE 'UNCLASSIFIED_ERROR' END"""
# Keys are distinct and already in these messages' parameter order once sorted.
_PAIRS = (
    "list_sort(CASE WHEN error_type IS NULL OR error_type = 'UNCLASSIFIED_ERROR' THEN []::VARCHAR[]"
    " ELSE regexp_extract_all(message_value, '[A-Za-z][A-Za-z0-9_]*=\\S+') END)"
)
_FIND = "nullif(regexp_extract(array_to_string(pairs, ' '), '(?:^| ){k}=(\\S+)', 1), '')"
NORMAL = f"""
{CHECKED},
classed AS (SELECT *, {_TYPE} AS error_type FROM resolved WHERE first_action = 'ACCEPT'),
paired AS (SELECT *, {_PAIRS} AS pairs FROM classed),
normal AS (SELECT *, {_FIND.format(k="code")} AS error_code, {_FIND.format(k="component")} AS related_component,
  {_FIND.format(k="path")} AS path,
  '{{' || array_to_string(list_transform(pairs, lambda p: '"' || split_part(p, '=', 1) || '":' ||
    to_json(substr(p, strpos(p, '=') + 1))::VARCHAR), ',') || '}}' AS error_parameters_json,
  strftime(at_utc, '%Y-%m-%d %H:%M:%S') AS timestamp_utc, strftime(at_utc, '%Y-%m-%d') AS event_date_utc,
  regexp_extract(timestamp_value, '(Z|[+-]\\d{{2}}:\\d{{2}})$', 1) AS timestamp_offset_raw FROM paired)
"""
CLEAN = f"""
{NORMAL},
{SOURCE},
clean AS (SELECT source_line, (SELECT source_sha256 FROM src) AS source_sha256, timestamp_value AS timestamp_raw, timestamp_utc,
  event_date_utc, timestamp_offset_raw, service_value AS service, level_value AS level, message_value AS message_raw,
  request_id_value AS request_id, trace_id_value AS trace_id, error_type, error_code, related_component, path,
  error_parameters_json FROM normal WHERE final_action = 'ACCEPT')
"""
_EVIDENCE = """CASE WHEN final_action <> 'ACCEPT' THEN '' ELSE
  'timestamp|' || to_json(timestamp_value)::VARCHAR || '|"' || strftime(at_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00"' ||
  CASE WHEN level_value = 'ERROR' THEN ';error_type|' || to_json(message_value)::VARCHAR || '|"' || {type} || '"' ELSE '' END
  END"""


def _issue_rows(*codes: str) -> str:
    wanted = ", ".join(f"'{c}'" for c in codes)
    return f"""WITH {CHECKED}, one AS (SELECT source_line, unnest(codes) AS code FROM checked)
SELECT source_line, split_part(code, '|', 1) AS issue_code, nullif(split_part(code, '|', 2), '') AS field,
  nullif(split_part(code, '|', 3), '') AS original_value FROM one WHERE split_part(code, '|', 1) IN ({wanted})"""


_CATALOG_ROWS = """
('LINE_TOO_LARGE', 'REJECT', 'physical line exceeds the {limit}-byte parsing limit'),
('TEXT_INVALID_UTF8', 'REJECT', 'physical line is not valid UTF-8 and cannot be parsed as JSON text'),
('JSON_MALFORMED', 'REJECT', 'physical line is not valid JSON'),
('JSON_NOT_OBJECT', 'REJECT', 'JSON value must be an object representing one log record'),
('REQUIRED_FIELD_MISSING', 'REJECT', 'required analytical field is missing'),
('REQUIRED_FIELD_TYPE', 'REJECT', 'required analytical field must be a string'),
('REQUIRED_FIELD_EMPTY', 'REJECT', 'required analytical field must not be empty'),
('TIMESTAMP_INVALID', 'REJECT', 'timestamp is not ISO 8601'),
('TIMESTAMP_OFFSET_MISSING', 'REJECT', 'timestamp must include a UTC offset or Z suffix'),
('LEVEL_UNKNOWN', 'REJECT', 'level must be one of INFO, WARN, or ERROR for this fixed POC'),
('TRACE_ID_TYPE', 'REJECT', 'optional trace_id must be a non-empty string'),
('UNEXPECTED_FIELD', 'ACCEPT', 'unexpected field is retained in raw provenance but ignored analytically'),
('EXACT_DUPLICATE', 'REJECT', 'canonical full-record digest was first retained at an earlier source line'),
('SYNTHETIC_REPAIR', 'REPAIR', 'synthetic test-only example of a lossless, unambiguous, mechanically provable repair')"""
_ISSUE_COUNTS = """issue_counts AS (SELECT split_part(c, '|', 1) AS issue_code,
  CASE WHEN c LIKE '%|ACCEPT' THEN 'ACCEPT' ELSE 'REJECT' END AS final_action,
  count(DISTINCT source_line) AS record_count, count(*) AS issue_occurrences
  FROM (SELECT source_line, unnest(codes) AS c FROM resolved) GROUP BY 1, 2)"""
RECONCILED = f"""{CLEAN}, {_ISSUE_COUNTS},
totals AS (SELECT 'record_total' AS metric_type, NULL::VARCHAR AS issue_code, a AS final_action,
    (SELECT count(*) FROM resolved WHERE final_action = a) AS record_count, NULL::BIGINT AS issue_occurrences,
    NULL::BOOLEAN AS is_reconciled
  FROM (SELECT unnest(['ACCEPT', 'REPAIR', 'REJECT']) AS a)),
recon AS (
  SELECT * FROM totals
  UNION ALL SELECT 'issue_occurrence', issue_code, final_action, record_count, issue_occurrences, NULL FROM issue_counts
  UNION ALL SELECT 'conservation', NULL, 'INPUT_EQUALS_ACTIONS', count(*), count(*) FILTER (final_action IN ('ACCEPT','REPAIR','REJECT')), true FROM resolved
  UNION ALL SELECT 'conservation', NULL, 'ANALYTICAL_EQUALS_PARQUET', count(*) FILTER (final_action = 'ACCEPT'),
    (SELECT count(*) FROM clean), count(*) FILTER (final_action = 'ACCEPT') = (SELECT count(*) FROM clean) FROM resolved)"""


def _service_counts(level: str) -> str:
    return (
        "SELECT row_number() OVER (ORDER BY error_count DESC, service) AS rank, service, error_count FROM"
        f" (SELECT service, count(*) AS error_count FROM clean WHERE level = '{level}' GROUP BY service)"
    )


_DAYS = """err AS (SELECT event_date_utc::DATE AS d, service FROM clean WHERE level = 'ERROR'),
cal AS (SELECT unnest(generate_series((SELECT min(d) FROM err), (SELECT max(d) FROM err), INTERVAL 1 DAY))::DATE AS d),
cnt AS (SELECT cal.d, count(err.d) AS n FROM cal LEFT JOIN err ON err.d = cal.d GROUP BY 1),
svc AS (SELECT d, string_agg(service || ':' || n, ';' ORDER BY service) AS s FROM (SELECT d, service, count(*) AS n FROM err GROUP BY 1, 2) GROUP BY 1),
med AS (SELECT median(n)::DOUBLE AS m FROM cnt),
days AS (SELECT strftime(cnt.d, '%Y-%m-%d') AS event_date_utc, n AS daily_error_count, m AS median_error_count,
  n / nullif(m, 0) AS ratio, n > 2 * m AS is_unusual_by_2x_median_rule,
  CASE WHEN n > 2 * m THEN coalesce(s, '') ELSE '' END AS service_contributions
  FROM cnt CROSS JOIN med LEFT JOIN svc ON svc.d = cnt.d)"""
_TOP = """sums AS (SELECT error_type, count(*) AS error_count FROM clean WHERE level = 'ERROR' GROUP BY 1),
per AS (SELECT error_type, '{' || string_agg(to_json(service)::VARCHAR || ':' || n, ',' ORDER BY service) || '}' AS service_contributions_json
  FROM (SELECT error_type, service, count(*) AS n FROM clean WHERE level = 'ERROR' GROUP BY 1, 2) GROUP BY 1),
top AS (SELECT row_number() OVER (ORDER BY error_count DESC, error_type) AS rank, error_type, error_count, service_contributions_json,
  coalesce((SELECT error_count FROM sums WHERE error_type = 'UNCLASSIFIED_ERROR'), 0) AS unclassified_error_count
  FROM sums JOIN per USING (error_type) ORDER BY error_count DESC, error_type LIMIT 3)"""

# Name, type, and whether it may be null, of every clean column.
_CONTRACT_COLUMNS = """source_line bigint not null; source_sha256 string not null; timestamp_raw string not null;
timestamp_utc timestamp not null; event_date_utc date not null; timestamp_offset_raw string not null; service string not null;
level string not null; message_raw string not null; request_id string not null; trace_id string null; error_type string null;
error_code string null; related_component string null; path string null; error_parameters_json string not null"""
_CONTRACT = " UNION ALL ".join(
    f"SELECT {i + 1}::BIGINT AS position, '{name}' AS column_name, '{kind}' AS declared_type, '{kind}' AS actual_type,"
    f" {'false' if rest[0] == 'not' else 'true'} AS nullable, count(*) FILTER ({name} IS NULL) AS null_count,"
    f" {'count(*) FILTER (' + name + ' IS NULL) = 0' if rest[0] == 'not' else 'true'} AS holds FROM clean"
    for i, (name, kind, *rest) in enumerate(column.split() for column in _CONTRACT_COLUMNS.split(";"))
)
_DAILY = f"""SELECT event_date_utc, daily_error_count, median_error_count, round(ratio, 6) AS error_count_to_median_ratio,
is_unusual_by_2x_median_rule, service_contributions FROM days"""
_BOOL = "CASE WHEN {c} IS NULL THEN '' WHEN {c} THEN 'true' ELSE 'false' END"

SQL = {
    "physical_lines": f"""WITH {RAW} SELECT source_line // {FILE_LINES} AS block,
row_number() OVER (PARTITION BY source_line // {FILE_LINES} ORDER BY source_line) AS source_line, raw_line,
strlen(raw_line) + 1 AS byte_length FROM rl""",
    "source_fingerprint": f"""WITH {RAW} SELECT source_line // {FILE_LINES} AS block, sum(strlen(raw_line) + 1)::BIGINT AS byte_size,
sha256(string_agg(raw_line || chr(10), '' ORDER BY source_line)) AS source_sha256 FROM rl GROUP BY 1""",
    "line_size_guard": f"""WITH {RAW} SELECT source_line, strlen(raw_line) + 1 AS byte_length,
CASE WHEN strlen(raw_line) + 1 > {GUARD_BYTES} THEN 'LINE_TOO_LARGE' END AS guard_code FROM rl""",
    "utf8_check": r"""SELECT doc_id, CASE WHEN regexp_matches(text, '[\x{80}-\x{ff}]') THEN 'TEXT_INVALID_UTF8' ELSE 'JSON_MALFORMED' END AS issue_code,
1::BIGINT AS issues, 'REJECT' AS final_action FROM documents""",
    "parse_json_object": f"""WITH {PARSED} SELECT source_line, json_status,
concat_ws(',', {", ".join(f"{f}_kind" for f in _FIELDS)}) AS kinds,
coalesce(array_to_string({_EXTRA}, ','), '') AS extra_keys FROM parsed""",
    "record_digest": f"WITH {CHECKED} SELECT source_line, record_digest FROM checked",
    "required_field_issues": _issue_rows(
        "REQUIRED_FIELD_MISSING", "REQUIRED_FIELD_TYPE", "REQUIRED_FIELD_EMPTY"
    ),
    "timestamp_issues": _issue_rows("TIMESTAMP_INVALID", "TIMESTAMP_OFFSET_MISSING"),
    "level_issues": _issue_rows("LEVEL_UNKNOWN"),
    "trace_id_issues": _issue_rows("TRACE_ID_TYPE"),
    "unexpected_fields": _issue_rows("UNEXPECTED_FIELD"),
    "issue_catalog": f"""WITH {CHECKED}, {_ISSUE_COUNTS}, cat(issue_code, action, reason) AS (VALUES {_CATALOG_ROWS})
SELECT cat.issue_code, action, reason, coalesce(issue_occurrences, 0) AS occurrences
FROM cat LEFT JOIN issue_counts ON cat.issue_code = issue_counts.issue_code""",
    "final_action": f"WITH {CHECKED} SELECT source_line, first_action AS final_action FROM checked",
    "exact_duplicates": f"WITH {CHECKED} SELECT source_line, record_digest, final_action, retained_source_line FROM resolved",
    "normalize_timestamps": f"WITH {NORMAL} SELECT source_line, timestamp_utc, event_date_utc, timestamp_offset_raw FROM normal",
    "classify_errors": f"WITH {NORMAL} SELECT source_line, level_value AS level, error_type FROM normal",
    "message_parameters": f"WITH {NORMAL} SELECT source_line, error_code, related_component, path, error_parameters_json FROM normal",
    "normalization_evidence": f"WITH {CHECKED} SELECT source_line, {_EVIDENCE.format(type=_TYPE)} AS evidence FROM resolved",
    "clean_records": f"WITH {CLEAN} SELECT * FROM clean",
    "quality_ledger": f"""WITH {CHECKED}, {SOURCE} SELECT '{LOG_PATH}' AS source_path, (SELECT source_sha256 FROM src) AS source_sha256, source_line,
record_digest, raw_line, array_to_string(codes, ';') AS issues, {_EVIDENCE.format(type=_TYPE)} AS normalizations,
final_action, retained_source_line FROM resolved""",
    "row_conservation": f"""WITH {CLEAN}, t AS (SELECT count(*) AS input_lines, count(*) FILTER (final_action = 'ACCEPT') AS accept_lines,
0::BIGINT AS repair_lines, count(*) FILTER (final_action = 'REJECT') AS reject_lines, (SELECT count(*) FROM clean) AS clean_rows FROM resolved)
SELECT *, input_lines = accept_lines + reject_lines AS input_equals_actions, accept_lines = clean_rows AS analytical_equals_clean FROM t""",
    "trace_line": f"""WITH {CLEAN}, rq AS (SELECT event_id * 2 + event_id % 3 AS source_line FROM events)
SELECT rq.source_line, CASE WHEN r.final_action IS NULL THEN 'outside' WHEN r.final_action = 'ACCEPT' THEN 'traced' ELSE 'rejected' END AS status,
r.final_action, r.retained_source_line, c.service, c.level, c.error_type, c.timestamp_utc,
CASE WHEN r.final_action = 'ACCEPT' THEN (c.level = 'ERROR')::BIGINT END AS service_error_count
FROM rq LEFT JOIN resolved r ON r.source_line = rq.source_line LEFT JOIN clean c ON c.source_line = rq.source_line""",
    "schema_contract": f"WITH {CLEAN} {_CONTRACT}",
    "service_counts_by_level": f"WITH {CLEAN} {_service_counts('WARN')}",
    "service_error_counts": f"WITH {CLEAN} {_service_counts('ERROR')}",
    "daily_error_counts": f"WITH {CLEAN}, {_DAYS} {_DAILY}",
    "top_error_types": f"WITH {CLEAN}, {_TOP} SELECT * FROM top",
    "quality_reconciliation": f"WITH {RECONCILED} SELECT * FROM recon",
    "unclassified_rate": f"""WITH {CLEAN}, u AS (SELECT count(*) AS clean_rows, count(*) FILTER (level = 'ERROR') AS error_rows,
count(*) FILTER (error_type = 'UNCLASSIFIED_ERROR') AS unclassified_errors FROM clean)
SELECT *, round(unclassified_errors / nullif(clean_rows, 0), 6) AS share_of_rows,
round(unclassified_errors / nullif(error_rows, 0), 6) AS share_of_errors FROM u""",
    "report_facts": f"""WITH {RECONCILED}, {_DAYS}, {_TOP}, ranked AS ({_service_counts("ERROR")})
SELECT 'top_service' AS section, service AS metric, error_count::VARCHAR AS value FROM ranked WHERE rank = 1
UNION ALL SELECT 'unusual_day', event_date_utc, daily_error_count || ' ' || printf('%.3f', ratio) || ' ' || service_contributions
  FROM days WHERE is_unusual_by_2x_median_rule
UNION ALL SELECT 'top_error_type', error_type, error_count || ' ' || service_contributions_json FROM top
UNION ALL SELECT 'unclassified', 'UNCLASSIFIED_ERROR', unclassified_error_count::VARCHAR FROM top WHERE rank = 1
UNION ALL SELECT 'quality', concat_ws('/', metric_type, issue_code, final_action),
  concat_ws(' ', record_count::VARCHAR, issue_occurrences::VARCHAR) FROM recon""",
    "run_analysis": f"""WITH {RECONCILED}, {_DAYS}, {_TOP}, ranked AS ({_service_counts("ERROR")})
SELECT 'service-error-counts' AS analysis_id, coalesce(rank::VARCHAR, '') || '|' || coalesce(service::VARCHAR, '') || '|' || coalesce(error_count::VARCHAR, '') AS row_text FROM ranked
UNION ALL SELECT 'daily-error-counts', coalesce(event_date_utc::VARCHAR, '') || '|' || coalesce(daily_error_count::VARCHAR, '') || '|' || coalesce(median_error_count::VARCHAR, '') || '|' || coalesce(round(ratio, 6)::VARCHAR, '') || '|' || coalesce(is_unusual_by_2x_median_rule::VARCHAR, '') || '|' || coalesce(service_contributions::VARCHAR, '') FROM days
UNION ALL SELECT 'top-normalized-errors', coalesce(rank::VARCHAR, '') || '|' || coalesce(error_type::VARCHAR, '') || '|' || coalesce(error_count::VARCHAR, '') || '|' || coalesce(service_contributions_json::VARCHAR, '') || '|' || coalesce(unclassified_error_count::VARCHAR, '') FROM top
UNION ALL SELECT 'quality-reconciliation', coalesce(metric_type::VARCHAR, '') || '|' || coalesce(issue_code::VARCHAR, '') || '|' || coalesce(final_action::VARCHAR, '') || '|' || coalesce(record_count::VARCHAR, '') || '|' || coalesce(issue_occurrences::VARCHAR, '') || '|' || coalesce(is_reconciled::VARCHAR, '') FROM recon""",
}

# Without the days, whose fractions every engine writes in its own way.
SQL["analysis_files"] = f"SELECT * FROM ({SQL['run_analysis']}) WHERE analysis_id <> 'daily-error-counts'"
