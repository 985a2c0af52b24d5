"""Derived views over the given tables that play the part of real inputs.

``RAW_LOG_LINES``: a dirty JSON-lines log made from ``events``, with every kind of defect.
``KB_MARKDOWN``: two versions of each knowledge-base document made from ``documents``.
``EXTRACTION_RESPONSES``: saved extraction outputs made from ``events``.
The texts are plain SQL, so that any engine can build the same views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_LOG_LINES = """
WITH e AS (
  SELECT event_id, user_id, event_id % 97 AS d,
    @TIMESTAMP@
    CASE user_id % 5 WHEN 0 THEN 'auth-service' WHEN 1 THEN 'payment-api' WHEN 2 THEN 'web-portal'
      WHEN 3 THEN 'batch-report' ELSE 'notification-worker' END AS service,
    CASE WHEN event_type = 'error' OR CAST(ts AS DATE) = DATE '2024-01-15' THEN 'ERROR'
      WHEN event_type = 'signup' THEN 'WARN' ELSE 'INFO' END AS level
  FROM events),
m AS (
  SELECT *, CASE WHEN level = 'WARN' THEN 'Retry 1/3 calling notification-worker'
    WHEN level = 'INFO' THEN 'Heartbeat ok'
    WHEN service = 'payment-api' AND event_id % 4 = 0 THEN 'ERR PaymentDeclined txn=t' || CAST(event_id AS STRING) || ' code=51'
    WHEN service = 'payment-api' THEN 'ERR ConnTimeout component=db-primary path=/v1/pay retry=' || CAST(event_id % 4 AS STRING)
    WHEN service = 'web-portal' THEN 'ERR HTTP 502 upstream=payment-api path=/checkout'
    WHEN service = 'batch-report' THEN 'ERR NullPointer in ReportBuilder'
    WHEN service = 'notification-worker' THEN 'ERR SMTPConnRefused host=mail-gw'
    ELSE 'ERR AuthTokenExpired user=u' || CAST(user_id AS STRING) END AS message
  FROM e),
l AS (
  SELECT event_id, d,
    '{"timestamp":"' || CASE WHEN d = 2 THEN substr(t, 1, 19) WHEN d = 3 THEN 'not-a-time' ELSE t END || '"' ||
    CASE WHEN d = 1 THEN '' WHEN d = 7 THEN ',"service":7' WHEN d = 8 THEN ',"service":""' ELSE ',"service":"' || service || '"' END ||
    ',"level":"' || CASE WHEN d = 4 THEN 'DEBUG' ELSE level END || '"' ||
    ',"message":"' || message || '","request_id":"req-' || CAST(event_id AS STRING) || '"' ||
    CASE WHEN d = 5 THEN ',"deployment":"canary"' WHEN d = 9 THEN ',"trace_id":""' WHEN event_id % 3 = 0 THEN ',"trace_id":"tr-' || CAST(user_id AS STRING) || '"' ELSE '' END ||
    CASE WHEN d = 0 THEN '' ELSE '}' END AS raw_line
  FROM m)
SELECT event_id * 2 + 1 AS source_line, CASE WHEN d = 10 THEN '[1,2]' ELSE raw_line END AS raw_line FROM l
UNION ALL
SELECT event_id * 2 + 2 AS source_line, raw_line FROM l WHERE d IN (4, 6)
"""

SPARK_TIMESTAMP = """date_format(CASE WHEN user_id % 7 = 0 THEN ts + INTERVAL '7' HOUR ELSE ts END, "yyyy-MM-dd'T'HH:mm:ss") || CASE WHEN user_id % 7 = 0 THEN '+07:00' ELSE 'Z' END AS t,"""

KB_MARKDOWN = """
SELECT doc_id, 'DOC-' || CAST(CAST(floor(doc_id / 2) AS BIGINT) AS STRING) AS family,
  'DOC-' || CAST(CAST(floor(doc_id / 2) AS BIGINT) AS STRING) || '_' || source || '_v' || CAST(doc_id % 2 + 1 AS STRING) || '.md' AS file_name,
  '# DOC-' || CAST(CAST(floor(doc_id / 2) AS BIGINT) AS STRING) || ' ' || lang || chr(10) || chr(10) ||
  '**' || source || '**' || CASE WHEN doc_id % 5 = 0 THEN '' ELSE ' · Phiên bản ' || CAST(doc_id % 2 + 1 AS STRING) || '.0' END ||
  ' · Ban hành: ' || lpad(CAST(doc_id * 7 % 12 + 1 AS STRING), 2, '0') || '/' || CAST(2024 + doc_id % 3 AS STRING) ||
  CASE WHEN doc_id % 8 IN (1, 4) THEN ' · Thay thế phiên bản trước' ELSE '' END ||
  CASE WHEN doc_id % 6 = 0 THEN ' · Người duyệt: Ops Head' ELSE '' END || chr(10) || chr(10) ||
  @BODY@
FROM documents
"""

SPARK_BODY = r"""CASE WHEN doc_id % 11 = 0 THEN text ELSE regexp_replace(text, r'(^|\n)(\S+) ', '$1## $2' || chr(10)) END AS md_text"""

EXTRACTION_RESPONSES = """
WITH e AS (
  SELECT event_id, event_id % 23 AS d, user_id % 4 AS k, user_id, event_type FROM events),
m AS (
  SELECT *, CASE k WHEN 0 THEN 'ERR ConnTimeout db-primary after 30s retry=' || CAST(event_id % 4 AS STRING)
      WHEN 1 THEN 'ERR PaymentDeclined txn=t' || CAST(event_id AS STRING) || ' code=51'
      WHEN 2 THEN 'Report row mismatch expected=843 got=' || CAST(user_id AS STRING) ELSE 'Heartbeat ok' END AS message,
    CASE k WHEN 0 THEN 'CONNECTION_TIMEOUT' WHEN 1 THEN 'PAYMENT_DECLINED' WHEN 2 THEN 'DATA_MISMATCH' ELSE 'HEARTBEAT' END AS et,
    CASE k WHEN 0 THEN '"db-primary"' ELSE 'null' END AS comp,
    CASE k WHEN 0 THEN '{"retry":"' || CAST(event_id % 4 AS STRING) || '"}'
      WHEN 1 THEN '{"code":"51","txn":"t' || CAST(event_id AS STRING) || '"}'
      WHEN 2 THEN '{"expected":"843","got":"' || CAST(user_id AS STRING) || '"}' ELSE '{}' END AS params,
    CASE k WHEN 3 THEN 'low' ELSE 'high' END AS conf, CASE k WHEN 3 THEN 'partial' ELSE 'success' END AS st
  FROM e),
t AS (
  SELECT *, CASE WHEN d = 0 THEN 'sorry, no JSON' WHEN d = 10 THEN '["list"]' ELSE
      '{"event_type":' || CASE WHEN d = 4 THEN '"OTHER"' WHEN d = 6 THEN 'null' ELSE '"' || et || '"' END ||
      ',"component":' || CASE WHEN d = 7 THEN '"mars-gateway"' WHEN d = 8 THEN '5' ELSE comp END ||
      ',"parameters":' || CASE WHEN d = 9 THEN '"none"' ELSE params END ||
      CASE WHEN d = 1 THEN '' ELSE ',"confidence":"' || CASE WHEN d = 3 THEN 'certain' ELSE conf END || '"' END ||
      ',"parse_status":"' || st || '"' || CASE WHEN d = 2 THEN ',"note":"x"' ELSE '' END || '}' END AS body
  FROM m),
f AS (
  SELECT *, CASE WHEN d = 5 THEN body ELSE '```json' || chr(10) || body || chr(10) || '```' END AS txt FROM t)
SELECT event_id AS case_no, message,
  '{"component":' || comp || ',"confidence":"' || conf || '","event_type":"' || et || '","parameters":' || params || ',"parse_status":"' || st || '"}' AS expected_json,
  CASE WHEN d = 11 THEN '{"error":"timeout","output":null}' ELSE
  '{"output":{"message":{"role":"assistant","content":[{"text":"' ||
    replace(replace(txt, '"', chr(92) || '"'), chr(10), chr(92) || 'n') ||
  '"}]}},"usage":{"inputTokens":' || CAST(800 + event_id % 30 AS STRING) || ',"outputTokens":' || CAST(40 + event_id % 25 AS STRING) ||
  '},"metrics":{"latencyMs":' || CAST(290 + event_id % 120 AS STRING) || '},"metadata":{"model_id":"model-' || event_type || '"}}' END AS response_json
FROM f
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables.

    A table that arrives in fewer splits than there are cores is spread over them; one with
    splits enough, as any large table has, is read as it lies.
    """
    frame = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores)


def _view(spark: SparkSession, folder: str, text: str, name: str) -> DataFrame:
    # The SQL formatter gives braces a meaning; these texts also have them inside literals.
    plain = text.replace("{", "{{").replace("}", "}}").replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(plain, **{name: table(spark, folder, name)})


def raw_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``source_line, raw_line``."""
    return _view(spark, folder, RAW_LOG_LINES.replace("@TIMESTAMP@", SPARK_TIMESTAMP), "events")


def kb_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, family, file_name, md_text``."""
    return _view(spark, folder, KB_MARKDOWN.replace("@BODY@", SPARK_BODY), "documents")


def extraction_responses(spark: SparkSession, folder: str) -> DataFrame:
    """``case_no, message, expected_json, response_json``."""
    return _view(spark, folder, EXTRACTION_RESPONSES, "events")
