"""SQL that recomputes the extraction queries from ``events``."""

from __future__ import annotations

from catalog.extraction import SAMPLE_RATE
from proofline.operators.extraction import DEFAULT_INSTRUCTIONS, FIELDS
from proofline.sources import views

RESPONSES = f"""xr AS ({views.EXTRACTION_RESPONSES}),
answered AS (SELECT *, coalesce(json_extract_string(response_json, '$.output.message.content[0].text'), '') AS response_text FROM xr),
inner_text AS (SELECT *, CASE WHEN response_text LIKE '```%' THEN trim(regexp_replace(regexp_replace(response_text, '^```[^\\n]*\\n', ''), '```\\s*$', ''), E' \\n')
  ELSE trim(response_text, E' \\n') END AS output_text FROM answered)"""
PARSED = f"""{RESPONSES},
typed AS (SELECT *, CASE WHEN json_valid(output_text) THEN output_text::JSON END AS v FROM inner_text),
parsed AS (SELECT *, CASE WHEN v IS NULL THEN 'MALFORMED' WHEN json_type(v) = 'OBJECT' THEN 'OBJECT' ELSE 'NOT_OBJECT' END AS status,
  CASE WHEN json_type(v) = 'OBJECT' THEN v END AS j FROM typed)"""
_NAMES = (
    "CASE json_type(j, '$.{f}') WHEN 'NULL' THEN 'NoneType' WHEN 'VARCHAR' THEN 'str' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict'"
    " WHEN 'BOOLEAN' THEN 'bool' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END"
)
_MISSING = ", ".join(
    f"CASE WHEN json_type(j, '$.{f}') IS NULL THEN 'missing required field: ''{f}''' END" for f in FIELDS
)
_LIST = ", ".join(f"'{f}'" for f in FIELDS)
VALID = f"""{PARSED},
keyed AS (SELECT *, list_filter([{_MISSING}, CASE WHEN len(list_filter(json_keys(j), lambda k: k NOT IN ({_LIST}))) > 0 THEN
  'unexpected fields: [''' || array_to_string(list_sort(list_filter(json_keys(j), lambda k: k NOT IN ({_LIST}))), ''', ''') || ''']' END],
  lambda x: x IS NOT NULL) AS key_errors FROM parsed),
valid AS (SELECT *, CASE WHEN status = 'MALFORMED' THEN ['output is not valid JSON'] WHEN status = 'NOT_OBJECT' THEN ['output is not a JSON object']
  WHEN len(key_errors) > 0 THEN list_sort(key_errors) ELSE list_sort(list_filter([
  CASE WHEN json_type(j, '$.event_type') <> 'VARCHAR' THEN 'event_type must be a string, got ' || {_NAMES.format(f="event_type")} END,
  CASE WHEN json_type(j, '$.component') NOT IN ('VARCHAR', 'NULL') THEN 'component must be a string or null, got ' || {_NAMES.format(f="component")} END,
  CASE WHEN json_type(j, '$.parameters') <> 'OBJECT' THEN 'parameters must be an object, got ' || {_NAMES.format(f="parameters")} END,
  CASE WHEN json_extract_string(j, '$.confidence') NOT IN ('high', 'medium', 'low') THEN
    'confidence ''' || json_extract_string(j, '$.confidence') || ''' is not one of [''high'', ''low'', ''medium'']' END,
  CASE WHEN json_extract_string(j, '$.parse_status') NOT IN ('success', 'partial', 'failed') THEN
    'parse_status ''' || json_extract_string(j, '$.parse_status') || ''' is not one of [''failed'', ''partial'', ''success'']' END
  ], lambda x: x IS NOT NULL)) END AS errors FROM keyed)"""
_TEXT = (
    "CASE WHEN json_type({s}, '$.{f}') = 'VARCHAR' THEN json_extract_string({s}, '$.{f}')"
    " WHEN json_type({s}, '$.{f}') IS NOT NULL THEN json_extract({s}, '$.{f}')::VARCHAR END"
)
COMPARED = f"""{VALID},
cells AS ({" UNION ALL ".join(
    f"SELECT case_no, '{f}' AS field, {_TEXT.format(s='expected_json::JSON', f=f)} AS expected, {_TEXT.format(s='j', f=f)} AS actual,"
    f" coalesce(json_extract(expected_json::JSON, '$.{f}')::VARCHAR = coalesce(json_extract(j, '$.{f}')::VARCHAR, 'null'), false) AS \"match\""
    f" FROM valid WHERE status = 'OBJECT'" for f in FIELDS)}),
results AS (SELECT case_no, len(errors) = 0 AND bool_and("match") AS passed, array_to_string(errors, '; ') AS errors,
  count("match") AS fields_compared, count(*) FILTER ("match") AS fields_matched, response_text
  FROM valid LEFT JOIN cells USING (case_no) GROUP BY case_no, errors, response_text)"""
_TRUTH = """truth AS (SELECT *, CASE WHEN message LIKE 'ERR ConnTimeout%' THEN 'CONNECTION_TIMEOUT' WHEN message LIKE 'ERR PaymentDeclined%' THEN 'PAYMENT_DECLINED' END AS t_event,
  CASE WHEN message LIKE 'ERR %' THEN json_extract(expected_json::JSON, '$.parameters')::VARCHAR END AS t_params FROM valid)"""


def _accuracy(field: str, truth: str, given: str) -> str:
    return f"""SELECT '{field}' AS field, round((SELECT avg(CASE WHEN len(errors) = 0 THEN 1 ELSE 0 END) FROM truth), 6) AS schema_valid_rate,
count(*) AS known_messages, count(*) FILTER ({given} = {truth}) AS matches,
round(count(*) FILTER ({given} = {truth}) / count(*), 6) AS recall,
round(count(*) FILTER ({given} = {truth}) / count(*) FILTER ({given} IS NOT NULL AND json_type(j, '$.{field}') <> 'NULL'), 6) AS precision,
count(*) FILTER ({given} = {truth}) / count(*) >= 0.95 AS meets_target FROM truth WHERE {truth} IS NOT NULL"""


_SNAKE = "upper(regexp_replace(regexp_replace(message, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g'))"
_FRACTION = "('0x' || substr(md5(case_no::VARCHAR), 1, 8))::BIGINT / 4294967296.0"
_PATTERN = "regexp_replace(message, '[0-9]+', '#', 'g')"

SQL = {
    "response_text": f"WITH {RESPONSES} SELECT case_no, response_text FROM answered",
    "strip_code_fence": f"WITH {RESPONSES} SELECT case_no, output_text FROM inner_text",
    "validate_extraction": f"WITH {VALID} SELECT case_no, len(errors) = 0 AS is_valid, array_to_string(errors, '; ') AS errors FROM valid",
    "compare_fields": f"WITH {COMPARED} SELECT * FROM cells",
    "case_results": f"WITH {COMPARED} SELECT * FROM results",
    "trial_summary": f"""WITH {COMPARED} SELECT passed, errors, count(*) AS cases, round(avg(passed::INT), 6) AS pass_rate
FROM results GROUP BY ROLLUP (passed, errors)""",
    "field_accuracy": f"""WITH {VALID}, {_TRUTH} {_accuracy("event_type", "t_event", _TEXT.format(s="j", f="event_type"))}
UNION ALL {_accuracy("parameters", "t_params", _TEXT.format(s="j", f="parameters"))}""",
    "hallucination_check": f"""WITH {PARSED}
SELECT case_no, 'event_type' AS field, NULL::VARCHAR AS name, json_extract_string(j, '$.event_type') AS value,
  coalesce(CASE WHEN message LIKE 'ERR ConnTimeout%' THEN 'CONNECTION_TIMEOUT' WHEN message LIKE 'ERR PaymentDeclined%' THEN 'PAYMENT_DECLINED' END
    = json_extract_string(j, '$.event_type'), false) OR contains({_SNAKE}, json_extract_string(j, '$.event_type')) AS traceable
  FROM parsed WHERE json_type(j, '$.event_type') = 'VARCHAR'
UNION ALL SELECT case_no, 'component', NULL, {_TEXT.format(s="j", f="component")}, contains(message, {_TEXT.format(s="j", f="component")})
  FROM parsed WHERE json_type(j, '$.component') <> 'NULL'
UNION ALL SELECT case_no, 'parameters', k, json_extract_string(j, '$.parameters.' || k), contains(message, json_extract_string(j, '$.parameters.' || k))
  FROM (SELECT *, unnest(json_keys(j, '$.parameters')) AS k FROM parsed WHERE json_type(j, '$.parameters') = 'OBJECT')""",
    "stratified_sample": f"""WITH {RESPONSES}, f AS (SELECT case_no, message, {_PATTERN} AS stratum, {_FRACTION} AS fraction FROM xr)
SELECT case_no, message, stratum FROM f QUALIFY fraction < {SAMPLE_RATE} OR row_number() OVER (PARTITION BY stratum ORDER BY fraction, case_no) = 1""",
    "review_routing": f"""WITH {VALID}, r AS (SELECT case_no, CASE WHEN len(errors) > 0 OR json_extract_string(j, '$.parse_status') = 'failed'
THEN 'parse_failed' WHEN json_extract_string(j, '$.confidence') = 'low' THEN 'low_confidence'
WHEN json_extract_string(j, '$.confidence') = 'high' AND {_FRACTION} < 0.05 THEN 'spot_check' END AS reason FROM valid)
SELECT * FROM r WHERE reason IS NOT NULL""",
    "usage_rollup": f"""WITH {RESPONSES}, u AS (SELECT {_PATTERN} AS group_name, json_extract_string(response_json, '$.metadata.model_id') AS model_id, json_extract(response_json, '$.usage.inputTokens')::BIGINT AS i,
json_extract(response_json, '$.usage.outputTokens')::BIGINT AS o, json_extract(response_json, '$.metrics.latencyMs')::BIGINT AS l FROM xr)
SELECT group_name, model_id, count(*) AS responses, count(i) AS with_usage, sum(i)::BIGINT AS input_tokens, sum(o)::BIGINT AS output_tokens, round(avg(l), 6) AS latency_avg_ms,
quantile_cont(l, 0.5)::DOUBLE AS latency_p50_ms, quantile_cont(l, 0.95)::DOUBLE AS latency_p95_ms, max(l) AS latency_max_ms FROM u GROUP BY 1, 2""",
    "build_prompts": f"""WITH {RESPONSES}, p AS (SELECT case_no, message, '{DEFAULT_INSTRUCTIONS}' || chr(10) || chr(10) || 'Log message: ' || message AS prompt FROM xr)
SELECT *, sha256(prompt) AS prompt_sha256 FROM p""",
}
