"""SQL of the registered queries that SQL can express."""

from __future__ import annotations

# Four captures of every page, as records with header blocks.
_CAPTURES = """
    c AS (SELECT p.*, unnest(range(4)) AS k FROM pages p),
    r AS (SELECT page_id * 4 + k AS record_id, page_id, k, html,
        (k = 0 AND page_id % 10 <> 9) OR (k = 2 AND page_id % 3 = 0) AS is_full,
        CASE k WHEN 0 THEN url WHEN 1 THEN url || '#again' WHEN 2 THEN replace(url, 'http://', 'https://')
          ELSE url || CASE WHEN contains(url, '#') THEN '' WHEN contains(url, '?') THEN '&utm_medium=x' ELSE '?utm_medium=x' END END AS uri,
        1704067200 + page_id * 7 + k * 90000 AS sec, '"' || md5(html || CASE WHEN k >= 2 AND page_id % 3 = 0 THEN '2' ELSE '0' END) || '"' AS tag
      FROM c),
    u AS (SELECT *, strftime(make_timestamp(sec * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS date,
        CASE WHEN k = 3 AND page_id % 4 = 0 THEN '"other"' WHEN k = 3 AND page_id % 4 IN (1, 2) THEN NULL
          WHEN k = 1 THEN 'W/' || tag ELSE tag END AS etag,
        CASE WHEN k = 3 AND page_id % 4 = 2 THEN NULL ELSE 'day ' || (page_id % 28) END AS modified,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(uri, '#.*$', ''), '^https?://(www\\.)?', ''),
          '([?&])(utm_[a-z]+=[^&]*(&|$))+', '\\1', 'g'), '[?&]+$', ''), '/+$', '') AS url
      FROM r),
    h AS (SELECT *, [{'n': 'Date', 'v': date}, {'n': 'ETag', 'v': etag}, {'n': 'Last-Modified', 'v': modified},
        {'n': 'Cache-Control', 'v': 'max-age=' || (60 * (k + 1))}, {'n': 'Content-Type', 'v': 'text/html; v=' || k},
        {'n': 'X-Served-By', 'v': 'cache' || (page_id % 7)}] AS headers
      FROM u)
"""

_TURNS = """
    c AS (SELECT conv_id AS pair_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
    j AS (SELECT pair_id, turn, role, text AS yes, CASE WHEN turn < pair_id % 9 + 2 THEN
        CASE WHEN turn >= pair_id % 9 THEN text || ' (again)' ELSE text END END AS no FROM c),
    f AS (SELECT *, min(CASE WHEN yes IS DISTINCT FROM no THEN turn END) OVER (PARTITION BY pair_id) AS first FROM j),
    s AS (SELECT pair_id, turn, role, first, side, turn < first OR first IS NULL AS common,
        '<|' || role || '|>' || chr(10) AS opening, replace(said, '<|', '< |') || '<|end|>' || chr(10) AS body
      FROM f, LATERAL (SELECT unnest(['yes', 'no']) AS side, unnest([yes, no]) AS said) WHERE said IS NOT NULL),
    o AS (SELECT *, sum(length(opening) + length(body)) OVER (PARTITION BY pair_id, side, common ORDER BY turn) AS upto FROM s)
"""

# Every string of 400 bytes by its digest; runs of the ones met again, and the bytes between the runs.
_STRINGS = r"""
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes FROM documents),
s AS (SELECT doc_id, i, md5(raw[i:i + 399]) AS h FROM b, LATERAL (SELECT unnest(range(1, n_bytes - 398)) AS i)),
f AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM s SEMI JOIN f USING (h)),
opened AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit),
run AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM opened),
span AS (SELECT doc_id, k, min(i) AS b, max(i) + 400 AS e FROM run GROUP BY 1, 2),
gap AS (SELECT doc_id, list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es, sum(e - b)::BIGINT AS gone, count(*) AS spans FROM span GROUP BY 1),
piece AS (SELECT b.doc_id, n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, raw, bs, es FROM b LEFT JOIN gap ON gap.doc_id = b.doc_id),
cut AS (SELECT doc_id, n_bytes, n_removed, n_spans, CASE WHEN bs IS NULL THEN hex(raw) ELSE array_to_string(list_transform(range(0, len(bs) + 1), lambda j:
  hex(raw[(CASE WHEN j = 0 THEN 1 ELSE es[j] END):(CASE WHEN j = len(bs) THEN n_bytes ELSE bs[j + 1] - 1 END)])), '') END AS kept FROM piece)
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256 FROM cut
"""

# Every window of 50 words by its digest, with the first document that has it.
_WINDOWS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM w, LATERAL (SELECT unnest(range(1, len(words) - 48)) AS i)),
f AS (SELECT h, min(doc_id) AS first FROM s GROUP BY h HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, i FROM s JOIN f USING (h) WHERE first < doc_id),
opened AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit),
run AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM opened),
span AS (SELECT doc_id, k, min(i) AS b, max(i) + 50 AS e FROM run GROUP BY 1, 2),
gap AS (SELECT doc_id, list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es, sum(e - b)::BIGINT AS gone FROM span GROUP BY 1),
kept AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(gone, 0) AS n_removed,
    CASE WHEN bs IS NULL THEN words ELSE flatten(list_transform(range(0, len(bs) + 1), lambda j:
      words[(CASE WHEN j = 0 THEN 1 ELSE es[j] END):(CASE WHEN j = len(bs) THEN len(words) ELSE bs[j + 1] - 1 END)])) END AS kept
  FROM w LEFT JOIN gap ON gap.doc_id = w.doc_id)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept
"""

SQL = {
    "op2_suffix_dedup": _STRINGS,
    "op6_block_dedup": _WINDOWS,
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY text)
    """,
    "op8_revisits": f"""
        WITH {_CAPTURES},
        m AS (SELECT v.*, o.record_id AS original_id, o.etag AS old_etag, o.modified AS old_modified, o.headers AS stored,
            o.html || CASE WHEN o.k = 2 THEN '<!-- changed -->' ELSE '' END AS payload
          FROM h v LEFT JOIN h o ON o.record_id = (
            SELECT arg_max(e.record_id, (e.sec, e.record_id)) FROM u e
            WHERE e.is_full AND e.url = v.url AND (e.sec < v.sec OR (e.sec = v.sec AND e.record_id < v.record_id)))
          WHERE NOT v.is_full),
        n AS (SELECT *, CASE WHEN original_id IS NULL THEN 'no_original'
            WHEN etag IS NOT NULL AND old_etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = old_etag THEN 'resolved' ELSE 'mismatch' END
            WHEN modified IS NOT NULL AND old_modified IS NOT NULL THEN CASE WHEN modified = old_modified THEN 'resolved' ELSE 'mismatch' END
            ELSE 'unvalidated' END AS outcome,
            list_filter(headers, lambda x: x.v IS NOT NULL) AS own FROM m),
        p AS (SELECT *, list_filter(own, lambda x: x.n IN ('Date', 'ETag', 'Last-Modified', 'Cache-Control')) AS fresh,
            outcome IN ('resolved', 'unvalidated') AS taken FROM n),
        q AS (SELECT *, list_transform(fresh, lambda x: x.n) AS names FROM p)
        SELECT record_id, url AS canonical_url, original_id, outcome,
          array_to_string(list_transform(CASE WHEN taken THEN list_concat(
            list_filter(stored, lambda x: x.v IS NOT NULL AND NOT list_contains(names, x.n)), fresh) ELSE own END,
            lambda x: x.n || ': ' || x.v), chr(10)) AS headers,
          CASE WHEN taken THEN sha256(payload) END AS payload_sha256
        FROM q
    """,
    "op10_preference": f"""
        WITH {_TURNS},
        part AS (SELECT pair_id, side, common, string_agg(opening || body, '' ORDER BY turn) AS text,
            coalesce(string_agg(CASE WHEN role = 'assistant' THEN (upto - length(body)) || '-' || upto END, ',' ORDER BY turn), '') AS mask,
            count(*) AS turns FROM o GROUP BY ALL)
        SELECT pair_id, coalesce(max(turns) FILTER (side = 'yes' AND common), 0) AS n_prompt_turns,
          coalesce(max(text) FILTER (side = 'yes' AND common), '') AS prompt,
          coalesce(max(text) FILTER (side = 'yes' AND NOT common), '') AS chosen,
          coalesce(max(mask) FILTER (side = 'yes' AND NOT common), '') AS chosen_mask,
          coalesce(max(text) FILTER (side = 'no' AND NOT common), '') AS rejected,
          coalesce(max(mask) FILTER (side = 'no' AND NOT common), '') AS rejected_mask
        FROM part GROUP BY pair_id
    """,
    "op11_hard_negatives": """
        WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) AS q
          FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
            list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id,
          row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
          other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
