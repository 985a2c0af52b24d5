"""SQL that recomputes the evidence, audit and incremental queries."""

from __future__ import annotations

from catalog import extraction_sql, knowledge_sql, logs_sql
from catalog.evidence import DAILY_FILE_LINES, FILE_DOCUMENTS
from catalog.logs import LOG_PATH
from proofline.operators.audit import WORDS_PER_PAGE

_LEDGER = (
    "file_no final_action issues normalizations raw_line record_digest retained_file_no retained_source_line source_line"
    " source_path source_sha256"
).split()
_CLEAN = (
    "error_code error_parameters_json error_type event_date_utc level message_raw path related_component request_id service"
    " source_line source_sha256 timestamp_offset_raw timestamp_raw timestamp_utc trace_id"
).split()
_DAY = (
    "daily_error_count error_count_to_median_ratio event_date_utc is_unusual_by_2x_median_rule median_error_count service_contributions"
).split()
_TOP_COLUMNS = ["error_count", "error_type", "rank", "service_contributions_json", "unclassified_error_count"]
_RECON = "final_action is_reconciled issue_code issue_occurrences metric_type record_count".split()


def _row_hash(columns: list[str]) -> str:
    return f"sha256(to_json([{', '.join(f'{c}::VARCHAR' for c in columns)}])::VARCHAR)"


def _print(name: str, columns: list[str], source: str) -> str:
    lanes = ", ".join(
        f"coalesce(sum(('0x' || substr(h, {1 + 15 * i}, 15))::BIGINT), 0)::VARCHAR" for i in range(4)
    )
    return (
        f"SELECT '{name}' AS artifact, count(*) AS row_count, sha256(concat_ws(':', count(*)::VARCHAR, {lanes})) AS fingerprint"
        f" FROM (SELECT {_row_hash(columns)} AS h FROM {source})"
    )


_BOOK = f"""book AS (SELECT 0 AS file_no, final_action, array_to_string(codes, ';') AS issues,
  {logs_sql._EVIDENCE.format(type=logs_sql._TYPE)} AS normalizations, raw_line, record_digest,
  CASE WHEN retained_source_line IS NOT NULL THEN 0 END AS retained_file_no, retained_source_line, source_line,
  '{LOG_PATH}' AS source_path, (SELECT source_sha256 FROM src) AS source_sha256 FROM resolved)"""
MANIFEST = f"""{logs_sql.RECONCILED}, {logs_sql._DAYS}, {logs_sql._TOP}, ranked AS ({logs_sql._service_counts("ERROR")}), {_BOOK},
daily AS ({logs_sql._DAILY}),
manifest AS ({_print("ledger", _LEDGER, "book")} UNION ALL {_print("clean", _CLEAN, "clean")}
UNION ALL {_print("service-error-counts", ["error_count", "rank", "service"], "ranked")}
UNION ALL {_print("daily-error-counts", _DAY, "daily")}
UNION ALL {_print("top-normalized-errors", _TOP_COLUMNS, "top")}
UNION ALL {_print("quality-reconciliation", _RECON, "recon")})"""
_RUN = "sha256(string_agg(artifact || ' ' || row_count || ' ' || fingerprint, chr(10) ORDER BY artifact || ' ' || row_count || ' ' || fingerprint))"
_HASHES = """texts AS (SELECT d.doc_id, lang, source, text, quality, toxic, source || '/' || d.doc_id || '.md' AS path, sha256(text) AS sha256
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _totals(ledger: str, clean: str) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{a.lower()}', count(*) FILTER (final_action = '{a}') FROM {ledger}" for a in ("ACCEPT", "REPAIR", "REJECT")
    )
    return f"""SELECT 'input' AS name, count(*) AS total FROM {ledger} UNION ALL {counts}
UNION ALL SELECT 'invalid_action', count(*) FILTER (final_action NOT IN ('ACCEPT', 'REPAIR', 'REJECT')) FROM {ledger}
UNION ALL SELECT 'clean', count(*) FROM {clean}"""


_SAME = "'service-error-counts', 'daily-error-counts', 'quality-reconciliation'"
VERIFY = f"""{MANIFEST},
forged AS (SELECT * REPLACE (CASE WHEN contains(';' || issues, ';LEVEL_UNKNOWN|') THEN 'MAYBE' ELSE final_action END AS final_action) FROM book),
cut AS (SELECT * FROM clean WHERE service <> 'batch-report'),
said AS (SELECT * FROM manifest),
seen AS ({_print("ledger", _LEDGER, "forged")} UNION ALL {_print("clean", _CLEAN, "cut")}
  UNION ALL SELECT * FROM manifest WHERE artifact IN ({_SAME})
  UNION ALL {_print("top-normalized-errors", _TOP_COLUMNS, "(SELECT * FROM top WHERE rank > 1)")}),
linked AS (SELECT said.artifact AS id, said.fingerprint AS before, seen.fingerprint AS after FROM said JOIN seen USING (artifact)
  WHERE said.artifact NOT IN ('ledger', 'clean')),
said_totals AS ({_totals("resolved", "clean")}), seen_totals AS ({_totals("forged", "cut")}),
seen_sums AS (SELECT sum(total) FILTER (name = 'input') AS i, sum(total) FILTER (name IN ('accept', 'repair', 'reject')) AS a,
  sum(total) FILTER (name IN ('accept', 'repair')) AS k, sum(total) FILTER (name = 'clean') AS c FROM seen_totals),
checks(check_name, expected, actual) AS (
  SELECT 'row_count ' || artifact, said.row_count::VARCHAR, seen.row_count::VARCHAR FROM said JOIN seen USING (artifact)
  UNION ALL SELECT 'fingerprint ' || artifact, said.fingerprint, seen.fingerprint FROM said JOIN seen USING (artifact)
  UNION ALL SELECT 'logic ' || id, 'published', CASE id WHEN 'service-error-counts' THEN 'changed' ELSE 'published' END FROM linked
  UNION ALL SELECT 'result ' || id, before, after FROM linked
  UNION ALL SELECT 'dataset ' || id, (SELECT fingerprint FROM said WHERE artifact = 'clean'), (SELECT fingerprint FROM seen WHERE artifact = 'clean') FROM linked
  UNION ALL SELECT 'total ' || name, p.total::VARCHAR, q.total::VARCHAR FROM said_totals p JOIN seen_totals q USING (name)
  UNION ALL SELECT 'conservation input = actions', i::VARCHAR, a::VARCHAR FROM seen_sums
  UNION ALL SELECT 'conservation kept = clean', k::VARCHAR, c::VARCHAR FROM seen_sums
  UNION ALL SELECT 'run_id', (SELECT {_RUN} FROM said), (SELECT {_RUN} FROM seen))"""
_TAMPERED = "CASE WHEN error_type = 'HTTP_502' THEN 'HTTP_500' ELSE error_type END"
_FILES = f"""{logs_sql.CHECKED},
filed AS (SELECT *, source_line // {DAILY_FILE_LINES} AS block, row_number() OVER (PARTITION BY source_line // {DAILY_FILE_LINES} ORDER BY source_line) AS line FROM checked),
early AS (SELECT record_digest AS d, arg_min(line, (block::VARCHAR || '/', line)) AS first_line, arg_min(block, (block::VARCHAR || '/', line)) AS first_block
  FROM filed WHERE first_action = 'ACCEPT' GROUP BY 1)"""
_SECRETS = r"""counts AS (SELECT doc_id, lang, source,
  len(regexp_extract_all(text, 'AKIA[0-9A-Z]{16}')) AS aws, len(list_filter(regexp_extract_all(text, '[0-9a-f]+'), lambda x: length(x) = 40)) AS hex,
  len(regexp_extract_all(text, '/mnt/data/\w+')) AS mnt, len(regexp_extract_all(text, '/home/\w+')) AS home FROM documents),
labelled AS (SELECT doc_id, lang, source, unnest(['AWS access key', 'possible secret key (40 hex)', 'absolute machine path leak', 'absolute home path leak']) AS label,
  unnest([aws, hex, mnt, home]) AS matches FROM counts)"""
_LENGTHS = f"""lengths AS (SELECT doc_id, lang, len(regexp_extract_all(text, '[^\\s\\x{{85}}\\x{{a0}}\\x{{2000}}-\\x{{200a}}]+'))::BIGINT AS words, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 1 END * {WORDS_PER_PAGE} AS max_words FROM documents),
limited AS (SELECT *, CASE WHEN max_words IS NULL THEN 'warn' WHEN words > max_words THEN 'fail' ELSE 'pass' END AS status FROM lengths)"""


SQL = {
    "source_inventory": f"""SELECT doc_id // {FILE_DOCUMENTS} AS block, sum(strlen(text) + 1)::BIGINT AS byte_size,
sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY 1""",
    "inventory_diff": f"""WITH {_HASHES}, b AS (SELECT path, sha256 FROM texts),
a AS (SELECT path, CASE WHEN quality = 0 THEN sha256(text || ' [redacted]') ELSE sha256 END AS sha256 FROM texts WHERE coalesce(toxic <> 1, true)
  UNION ALL SELECT 'benchmark/' || item_id || '.md', sha256(text) FROM benchmark)
SELECT coalesce(b.path, a.path) AS path, b.sha256 AS before_sha256, a.sha256 AS after_sha256, CASE WHEN b.path IS NULL THEN 'added'
WHEN a.path IS NULL THEN 'removed' WHEN a.sha256 = b.sha256 THEN 'same' ELSE 'changed' END AS status FROM b FULL JOIN a ON a.path = b.path""",
    "inventory_agreement": f"""WITH {_HASHES}, sides AS (SELECT path, 'declared' AS name, 1 AS k, sha256 FROM texts
  UNION ALL SELECT path, 'before', 2, CASE WHEN quality = 0 THEN sha256(upper(text)) ELSE sha256 END FROM texts WHERE coalesce(toxic <> 1, true)
  UNION ALL SELECT path, 'after', 3, CASE WHEN lang = 'fr' THEN sha256(lower(text)) ELSE sha256 END FROM texts WHERE source <> 'src0'),
voted AS (SELECT *, count(*) OVER (PARTITION BY path) AS there, count(*) OVER (PARTITION BY path, sha256) AS votes FROM sides),
p AS (SELECT path, count(*) AS there, list(name ORDER BY k) AS names, count(DISTINCT sha256) AS digests, max(votes) AS most,
  coalesce(string_agg(CASE WHEN votes * 2 < there THEN name END, ',' ORDER BY k), '') AS odd FROM voted GROUP BY path)
SELECT path, array_to_string(names, ',') AS present,
  array_to_string(list_filter(['declared', 'before', 'after'], lambda n: NOT list_contains(names, n)), ',') AS missing,
  CASE WHEN most * 2 > there THEN odd ELSE '' END AS odd,
  CASE WHEN there < 3 AND digests > 1 THEN 'missing and changed' WHEN there < 3 THEN 'missing' WHEN digests > 1 THEN 'changed' ELSE 'same' END AS status
FROM p""",
    "artifact_manifest": f"WITH {MANIFEST} SELECT * FROM manifest",
    "analysis_links": f"""WITH {MANIFEST} SELECT artifact AS analysis_id, true AS logic_is_stable, true AS logic_sees_rules,
fingerprint AS result_fingerprint, row_count AS result_row_count,
(SELECT fingerprint FROM manifest WHERE artifact = 'clean') AS dataset_fingerprint FROM manifest WHERE artifact NOT IN ('ledger', 'clean')""",
    "run_fingerprint": f"WITH {MANIFEST} SELECT {_RUN} AS run_id FROM manifest",
    "verify_manifest": f"WITH {VERIFY} SELECT *, coalesce(expected = actual, false) AS ok FROM checks",
    "reconstruction_diff": f"""WITH {logs_sql.CLEAN}, {_BOOK},
sides AS (SELECT 'clean' AS table_name, source_line, {_row_hash(_CLEAN)} AS row_sha256, 1 AS n FROM clean
  UNION ALL SELECT 'clean', source_line, {_row_hash(_CLEAN)}, -1 FROM (SELECT * REPLACE ({_TAMPERED} AS error_type) FROM clean WHERE coalesce(error_type <> 'NULL_POINTER', true))
  UNION ALL SELECT 'ledger', source_line, {_row_hash(_LEDGER)}, 1 FROM book
  UNION ALL SELECT 'ledger', source_line, {_row_hash(_LEDGER)}, -1 FROM (SELECT * REPLACE (CASE WHEN source_line % 50 = 1 THEN substr(raw_line, 1, 20) ELSE raw_line END AS raw_line) FROM book))
SELECT table_name, source_line, row_sha256, CASE WHEN sum(n) > 0 THEN 'missing' ELSE 'unexpected' END AS status, abs(sum(n))::BIGINT AS copies
FROM sides GROUP BY table_name, source_line, row_sha256 HAVING sum(n) <> 0""",
    "input_binding": f"""WITH {_HASHES}, d AS (SELECT doc_id, CASE WHEN quality = 0 THEN '../' || path ELSE path END AS path,
CASE WHEN toxic = 1 THEN substr(sha256, 1, 10) ELSE sha256 END AS sha256 FROM texts),
live AS (SELECT path, CASE WHEN lang = 'fr' THEN sha256(lower(text)) ELSE sha256 END AS sha256 FROM texts WHERE source <> 'src0')
SELECT d.doc_id, d.path, CASE WHEN length(d.sha256) <> 64 THEN 'hash mismatch' WHEN d.path LIKE '../%' THEN 'membership mismatch'
WHEN live.sha256 IS NULL THEN 'membership mismatch' WHEN live.sha256 <> d.sha256 THEN 'hash mismatch' ELSE 'ok' END AS status
FROM d LEFT JOIN live ON live.path = d.path""",
    "secret_scan": f"WITH {_SECRETS} SELECT doc_id, label, matches FROM labelled WHERE matches > 0",
    "length_limits": f"WITH {_LENGTHS} SELECT * FROM limited",
    "required_presence": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "scan_exclusions": "SELECT doc_id, source || '/' || doc_id || '.md' AS path FROM documents WHERE lang <> 'de' AND source <> 'src3'",
    "audit_summary": f"""WITH {_SECRETS}, {_LENGTHS},
parts(check_name, pass_count, warn_count, fail_count) AS (
  SELECT 'secrets', (SELECT count(*) FROM (SELECT doc_id FROM labelled WHERE lang <> 'de' AND source <> 'src3' GROUP BY 1 HAVING max(matches) = 0)), 0, (SELECT count(*) FROM labelled WHERE matches > 0 AND lang <> 'de' AND source <> 'src3')
  UNION ALL SELECT 'lengths', count(*) FILTER (status = 'pass'), count(*) FILTER (status = 'warn'), count(*) FILTER (status = 'fail') FROM limited
  UNION ALL SELECT 'labels', (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)), 0),
both_levels AS (SELECT * FROM parts UNION ALL SELECT 'overall', sum(pass_count), sum(warn_count), sum(fail_count) FROM parts)
SELECT check_name, pass_count::BIGINT AS pass_count, warn_count::BIGINT AS warn_count, fail_count::BIGINT AS fail_count,
CASE WHEN fail_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS verdict FROM both_levels""",
    "incremental_ingest": f"""WITH {_FILES} SELECT block, line AS source_line,
CASE WHEN first_action = 'ACCEPT' AND first_line = line AND first_block = block THEN 'ACCEPT' ELSE 'REJECT' END AS final_action,
CASE WHEN first_action = 'ACCEPT' THEN first_line END AS retained_source_line FROM filed LEFT JOIN early ON record_digest = d""",
    "curated_partitions": f"""WITH {logs_sql.CLEAN} SELECT event_date_utc, count(*) AS clean_rows,
count(*) FILTER (level = 'ERROR') AS error_rows FROM clean GROUP BY 1""",
    "cross_batch_duplicates": f"""WITH {logs_sql.CHECKED}, e AS (SELECT record_digest AS d, arg_min(source_line, (source_line % 2 = 0, source_line)) AS f
  FROM checked WHERE first_action = 'ACCEPT' GROUP BY 1)
SELECT CASE WHEN source_line % 2 = 0 THEN 2 ELSE 1 END AS batch, source_line,
CASE WHEN first_action = 'ACCEPT' AND f = source_line THEN 'ACCEPT' ELSE 'REJECT' END AS final_action,
CASE WHEN first_action = 'ACCEPT' THEN f END AS retained_source_line FROM checked LEFT JOIN e ON record_digest = d""",
}


def _summary() -> str:
    logs_part = f"SELECT 'logs' AS part, name AS metric, total::VARCHAR AS value FROM ({_totals('resolved', 'clean')})"
    return f"""WITH run_rows AS (WITH {MANIFEST} SELECT 'manifest' AS part, 'run_id' AS metric, {_RUN} AS value FROM manifest),
logs_rows AS (WITH {logs_sql.CLEAN} {logs_part}),
kb_rows AS (SELECT 'knowledge_base' AS part, metric, value::VARCHAR AS value FROM (UNPIVOT ({knowledge_sql.SQL["build_stats"]}) ON COLUMNS(*) INTO NAME metric VALUE value)),
eval_rows AS (WITH {knowledge_sql.EVALUATED} SELECT 'evaluation' AS part, g AS metric, (SELECT count(*) FROM graded WHERE retrieval_hit_score = g)::VARCHAR AS value
  FROM (SELECT unnest(['pass', 'partial', 'fail']) AS g)),
answer_rows AS (WITH {extraction_sql.COMPARED} SELECT 'extraction' AS part, 'responses' AS metric, count(*)::VARCHAR AS value FROM results
  UNION ALL SELECT 'extraction', 'passed', (count(*) FILTER (passed))::VARCHAR FROM results),
print_rows AS (WITH {extraction_sql.RESPONSES}, p AS ({_print("responses", ["case_no", "response_json"], "xr")})
  SELECT 'responses' AS part, 'row_count' AS metric, row_count::VARCHAR AS value FROM p UNION ALL SELECT 'responses', 'fingerprint', fingerprint FROM p)
SELECT * FROM run_rows UNION ALL SELECT * FROM logs_rows UNION ALL SELECT * FROM kb_rows UNION ALL SELECT * FROM eval_rows UNION ALL SELECT * FROM answer_rows UNION ALL SELECT * FROM print_rows"""


SQL["run_summary"] = _summary()
