"""SQL that recomputes the knowledge-base queries from ``documents`` and ``benchmark``."""

from __future__ import annotations

from proofline.sources import views

_BODY = (
    r"CASE WHEN doc_id % 11 = 0 THEN text ELSE regexp_replace(text, '(^|\n)(\S+) ', '\1## \2' || chr(10), 'g') END AS md_text"
)
DOCS = rf"""
md AS ({views.KB_MARKDOWN.replace("@BODY@", _BODY)}),
lined AS (SELECT *, split_part(md_text, chr(10), 3) AS line FROM md),
docs AS (SELECT doc_id AS number, 'docs/' || file_name AS source_path, sha256(md_text) AS sha256, md_text, line,
  regexp_extract(file_name, '^([A-Z]+-\d+)', 1) AS doc_id, lower(regexp_extract(file_name, '(_v\d+)\.md$', 1)) AS filename_version_hint,
  nullif(regexp_extract(line, 'Phiên bản (\d+\.\d+)', 1), '') AS version,
  regexp_extract(line, 'Ban hành: (\d+)/(\d+)', 2) || '-' || regexp_extract(line, 'Ban hành: (\d+)/(\d+)', 1) AS effective_date,
  regexp_extract(line, '\*\*([^*]+)\*\*', 1) AS department,
  nullif(trim(regexp_extract(line, 'Người duyệt: ([^·]+)', 1)), '') AS approver,
  contains(line, 'Thay thế phiên bản trước') AS supersedes_previous FROM lined),
best AS (SELECT doc_id, source_path, row_number() OVER (PARTITION BY doc_id
  ORDER BY supersedes_previous DESC, effective_date DESC, source_path) = 1 AS is_current FROM docs)
"""
CHUNKS = rf"""
{DOCS},
pieces AS (SELECT source_path, doc_id, version, filename_version_hint, effective_date, department, line, md_text,
  split_part(md_text, chr(10), 1) AS title, string_split(chr(10) || md_text, chr(10) || '## ') AS parts FROM docs),
cut AS (SELECT * EXCLUDE (parts), unnest(range(1, greatest(len(parts), 2))) AS i, parts FROM pieces),
sectioned AS (SELECT *, len(parts) > 1 AS has, CASE WHEN len(parts) > 1 THEN parts[i + 1]
  ELSE regexp_replace(substr(md_text, strpos(md_text, line) + length(line)), '^\n+', '') END AS piece FROM cut),
chunks AS (SELECT doc_id || '_' || coalesce(version, ltrim(filename_version_hint, '_')) || '_chunk' || (i - 1) AS chunk_id, doc_id,
  CASE WHEN has THEN trim(split_part(piece, chr(10), 1)) ELSE '(full document)' END AS section, (i - 1)::BIGINT AS chunk_index,
  regexp_replace(title || chr(10) || chr(10) || line || chr(10) || chr(10) || CASE WHEN has THEN
    '## ' || trim(split_part(piece, chr(10), 1)) || chr(10) || substr(piece, length(split_part(piece, chr(10), 1)) + 1)
    ELSE piece END, '\s+$', '') || chr(10) AS content,
  version, effective_date, department AS owner, best.is_current, source_path
  FROM sectioned JOIN best USING (doc_id, source_path))
"""
# Letters with two marks keep them: they step aside while single marks are removed.
_TOKENS = (
    r"regexp_extract_all(translate(strip_accents(translate(lower({t}), 'ếớờệ', chr(57345) || chr(57346) || chr(57347) || chr(57348))),"
    r" chr(57345) || chr(57346) || chr(57347) || chr(57348), 'ếớờệ'), '[\p{{L}}\p{{N}}]+')"
)
TOKENS = f"""
{CHUNKS},
tokened AS MATERIALIZED (SELECT *, {_TOKENS.format(t="content")} AS tokens, len({_TOKENS.format(t="content")})::BIGINT AS token_count FROM chunks),
postings AS MATERIALIZED (SELECT chunk_id, is_current, token_count, unnest(tokens) AS term, unnest(range(1, token_count + 1)) AS pos FROM tokened)
"""
_SEARCH = f"""
phrase AS (SELECT query_id, search_mode, {_TOKENS.format(t="query_text")} AS terms FROM asked),
wanted AS (SELECT DISTINCT array_to_string(terms, ' ') AS phrase, terms FROM phrase WHERE len(terms) > 0),
parts AS (SELECT phrase, len(terms) AS n, unnest(terms) AS term, unnest(range(1, len(terms) + 1)) AS i FROM wanted),
starts AS (SELECT phrase, chunk_id, is_current, token_count, pos - i AS start FROM parts JOIN postings USING (term)
  GROUP BY ALL HAVING count(*) = any_value(n)),
found AS MATERIALIZED (SELECT phrase, chunk_id, is_current, token_count, count(*) AS tf FROM starts GROUP BY ALL),
stat AS (SELECT count(*) AS total, avg(token_count) AS average FROM tokened),
freq AS (SELECT phrase, count(*) AS matching FROM found GROUP BY 1),
scored AS MATERIALIZED (SELECT found.*, tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * token_count / average)) AS saturation,
  -CASE WHEN ln((total - matching + 0.5::DOUBLE) / (matching + 0.5::DOUBLE)) <= 0 THEN 1e-6 ELSE
    ln((total - matching + 0.5::DOUBLE) / (matching + 0.5::DOUBLE)) END
  * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * token_count / average))) AS bm25_score
  FROM found JOIN freq USING (phrase) CROSS JOIN stat),
ranked AS (SELECT m.phrase, m.search_mode, chunk_id, bm25_score,
  row_number() OVER (PARTITION BY m.phrase, m.search_mode ORDER BY round(saturation, 9) DESC, chunk_id) AS rank
  FROM (SELECT DISTINCT array_to_string(terms, ' ') AS phrase, search_mode FROM phrase) m JOIN scored ON m.phrase = scored.phrase
  WHERE m.search_mode = 'all' OR is_current),
hits AS (SELECT query_id, phrase.search_mode, rank, chunk_id, bm25_score FROM phrase
  JOIN ranked ON array_to_string(terms, ' ') = ranked.phrase AND phrase.search_mode = ranked.search_mode)
"""
_WORDS = r"regexp_split_to_array(text, '\s+')"
_ASKED = f"""asked AS (SELECT item_id * 100000 + v AS query_id, '{{mode}}' AS search_mode,
  CASE v WHEN 0 THEN '"' || text || '" *' WHEN 1 THEN w[2] WHEN 2 THEN '   ' ELSE '"' || array_to_string(w[v - 2:v], ' ') || '" *' END AS query_text
  FROM (SELECT item_id, text, w, unnest(range(0, greatest(len(w) + 1, 3))) AS v FROM (SELECT item_id, text, {_WORDS} AS w FROM benchmark)))"""


def _benchmark(mode: str) -> str:
    return f"{TOKENS}, {_ASKED.format(mode=mode)}, {_SEARCH}"


_HITS = """SELECT query_id, rank, chunk_id, doc_id, section, version, is_current, round(bm25_score, 6) AS bm25_score
FROM hits JOIN chunks USING (chunk_id) WHERE rank <= {k}"""
CASES = f"""cases AS (SELECT 'C' || doc_id AS case_id, doc_id % 10 AS kind,
  CASE WHEN doc_id % 10 = 9 THEN 'out_of_scope' WHEN doc_id % 10 = 8 THEN 'version_trap' WHEN doc_id % 10 >= 6 THEN 'multi_source' ELSE 'direct_lookup' END AS question_type,
  array_to_string(w[s:s + 3], ' ') || CASE WHEN doc_id % 10 = 9 THEN ' zzqx' ELSE '' END AS query_terms,
  CASE WHEN doc_id % 4 = 0 THEN 'all' ELSE 'current' END AS search_mode,
  'DOC-' || (doc_id // 2) AS family, CASE WHEN doc_id % 11 = 0 THEN '(full document)' ELSE w[1] END AS section,
  CASE WHEN doc_id % 10 = 9 THEN 0 WHEN doc_id % 10 IN (6, 7) THEN 2 ELSE 1 END AS expected,
  CASE doc_id % 10 WHEN 9 THEN []::VARCHAR[] WHEN 7 THEN list_concat(w[s:s], ['zzqx']) ELSE w[s:s + 1] END AS keywords
  FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE doc_id * 7 % greatest(len(w) - 4, 1) + 2 END AS s
    FROM (SELECT *, {_WORDS} AS w FROM documents))),
asked AS (SELECT case_id AS query_id, search_mode, query_terms AS query_text FROM cases)"""


def _graded(k: int = 5, suffix: str = "") -> str:
    return f"""
got{suffix} AS (SELECT query_id AS case_id, count(*) AS hits, string_agg(chunk_id, ',' ORDER BY rank) AS chunk_ids,
    string_agg(content, ' ' ORDER BY rank) AS blob, list(doc_id || '/' || section ORDER BY rank) AS actual,
    string_agg(chunk_id || ':' || substr(content, 1, 300), '|' ORDER BY rank) AS snippets,
    list(doc_id || '/' || is_current) AS seen
  FROM hits JOIN chunks USING (chunk_id) WHERE rank <= {k} GROUP BY 1),
eval{suffix} AS (SELECT cases.*, coalesce(hits, 0) AS hits, coalesce(chunk_ids, '') AS chunk_ids, coalesce(snippets, '') AS snippets,
    coalesce(actual, []) AS actual, coalesce(seen, []) AS seen, coalesce(list_contains(actual, family || '/' || section), false) AS own_found,
    list_filter(keywords, lambda k: contains(coalesce(blob, ''), k)) AS found_keywords
  FROM cases LEFT JOIN got{suffix} USING (case_id)),
graded{suffix} AS (SELECT *, CASE WHEN expected > 0 AND own_found THEN 1 ELSE 0 END AS matched,
  CASE WHEN kind = 9 THEN CASE WHEN hits = 0 THEN 'pass' ELSE 'fail' END WHEN NOT own_found THEN 'fail' WHEN expected = 1 THEN 'pass' ELSE 'partial' END AS retrieval_hit_score,
  CASE WHEN kind = 9 THEN CASE WHEN hits = 0 THEN 'pass' ELSE 'fail' END WHEN len(found_keywords) = len(keywords) THEN 'pass'
    WHEN len(found_keywords) > 0 THEN 'partial' ELSE 'fail' END AS groundedness_score FROM eval{suffix})"""


EVALUATED = f"{TOKENS}, {CASES}, {_SEARCH}, {_graded()}"
_COUNTS = """count(*) AS cases, count(*) FILTER (retrieval_hit_score = 'pass') AS pass,
count(*) FILTER (retrieval_hit_score = 'partial') AS partial, count(*) FILTER (retrieval_hit_score = 'fail') AS fail"""
_SEEN = "(kind = 8 AND list_contains(seen, family || '/{v}'))"

SQL = {
    "document_inventory": f"""WITH {DOCS} SELECT source_path, sha256, doc_id, filename_version_hint, version, effective_date, department,
approver, supersedes_previous FROM docs""",
    "header_metadata": f"""WITH {DOCS} SELECT source_path, version, effective_date, department, approver, supersedes_previous FROM docs""",
    "chunk_sections": f"WITH {CHUNKS} SELECT source_path, section, chunk_index, content FROM chunks",
    "chunk_identity": f"WITH {CHUNKS} SELECT source_path, chunk_id, sha256(content) AS content_hash FROM chunks",
    "resolve_versions": f"WITH {DOCS} SELECT source_path, doc_id, is_current FROM best",
    "chunk_export": f"""WITH {CHUNKS} SELECT chunk_id, doc_id, section, chunk_index, content, sha256(content) AS content_hash, version,
effective_date, owner, CASE WHEN is_current THEN 1 ELSE 0 END AS is_current, source_path FROM chunks""",
    "tokenize": f"WITH {TOKENS} SELECT chunk_id, token_count, array_to_string(tokens, ' ') AS tokens FROM tokened",
    "build_index": f"""WITH {TOKENS} SELECT term, count(DISTINCT chunk_id) AS chunks, count(*) AS occurrences,
(SELECT count(*) FROM chunks) AS corpus_chunks FROM postings GROUP BY term""",
    "phrase_match": f"WITH {_benchmark('all')} SELECT phrase, chunk_id, tf, token_count FROM found",
    "bm25_rank": f"WITH {_benchmark('all')} SELECT phrase, chunk_id, round(bm25_score, 6) AS bm25_score FROM scored",
    "search_current": f"WITH {_benchmark('current')} {_HITS.format(k=5)}",
    "search_all": f"WITH {_benchmark('all')} {_HITS.format(k=10)}",
    "empty_query": f"""WITH {_benchmark('all')} SELECT query_id, trim(query_text) = '' AS is_blank,
(SELECT count(*) FROM hits WHERE hits.query_id = asked.query_id AND rank <= 10) AS hits FROM asked""",
    "build_stats": f"""WITH {CHUNKS} SELECT (SELECT count(*) FROM docs) AS documents, count(*) AS chunks,
count(*) FILTER (is_current) AS current_chunks, count(*) FILTER (NOT is_current) AS superseded_chunks FROM chunks""",
    "run_evaluation": f"WITH {EVALUATED} SELECT case_id, hits, chunk_ids FROM graded",
    "score_retrieval": f"WITH {EVALUATED} SELECT case_id, question_type, matched::BIGINT AS matched, retrieval_hit_score FROM graded",
    "score_groundedness": f"WITH {EVALUATED} SELECT case_id, len(found_keywords) AS found, groundedness_score FROM graded",
    "diagnosis_facts": f"""WITH {EVALUATED}, facts AS (SELECT *, {_SEEN.format(v="true")} AS current_seen, {_SEEN.format(v="false")} AS superseded_seen FROM graded)
SELECT case_id, CASE WHEN matched = 1 THEN section ELSE '' END AS matched_sections,
concat_ws(',', CASE WHEN expected > 0 AND matched = 0 THEN section END, CASE WHEN expected = 2 THEN '(appendix)' END) AS missing_sections,
array_to_string(list_filter(keywords, lambda k: NOT list_contains(found_keywords, k)), ',') AS missing_keywords, current_seen, superseded_seen,
CASE WHEN kind = 9 THEN 'out of scope: ' || hits || ' chunks returned' ELSE
  'sources ' || upper(retrieval_hit_score) || ' ' || matched || '/' || expected || '; keywords ' || upper(groundedness_score) || ' ' ||
  len(found_keywords) || '/' || len(keywords) || CASE WHEN kind <> 8 THEN '' WHEN current_seen AND superseded_seen THEN '; versions: current and superseded'
  WHEN current_seen THEN '; versions: current only' WHEN superseded_seen THEN '; versions: superseded only' ELSE '; versions: none' END END AS diagnosis FROM facts""",
    "eval_records": f"""WITH {EVALUATED} SELECT case_id, query_terms AS query_used, search_mode, retrieval_hit_score, groundedness_score,
array_to_string(actual, ',') AS actual_sources, snippets FROM graded""",
    "eval_summary": f"""WITH {EVALUATED} SELECT NULL AS question_type, {_COUNTS} FROM graded
UNION ALL SELECT question_type, {_COUNTS} FROM graded GROUP BY question_type""",
    "eval_regression": f"""WITH {EVALUATED}, {_graded(1, "_one")}, both_runs AS (SELECT b.case_id, a.question_type, b.retrieval_hit_score AS before_score,
a.retrieval_hit_score AS after_score, list_position(['fail', 'partial', 'pass'], b.retrieval_hit_score) AS x,
list_position(['fail', 'partial', 'pass'], a.retrieval_hit_score) AS y FROM graded b JOIN graded_one a USING (case_id))
SELECT case_id, question_type, before_score, after_score, CASE WHEN y < x THEN 'regressed' WHEN y = x THEN 'same' ELSE 'improved' END AS status,
CASE WHEN question_type = 'version_trap' THEN y >= x WHEN question_type IN ('out_of_scope', 'direct_lookup') THEN after_score = 'pass' ELSE true END AS gate_ok
FROM both_runs""",
}

SQL["chunk_files"] = SQL["chunk_export"]
