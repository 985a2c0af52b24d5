"""Resolution of not-modified revisit records against the full responses captured before them.

A revisit says that a page had not changed: it has headers of its own and no payload.  It is joined as of its time to
the latest earlier full response of the same canonical URL.  If validators are given they must agree: entity tags by
weak comparison, else last-modified dates.  The resolved record has the stored headers with those that a
not-modified answer may update taken from the revisit, and the stored payload.

The as-of join works on narrow rows (id, URL, time) and cuts every URL's history into blocks of time: a block's last full
response is an aggregate that combines on the map side, the last one before each block a window over blocks, and
only inside a block are single records put in order.  So no task holds all captures of a URL.  Headers and payload are
joined on by record id afterwards: an original is stored once, and one with more than ``SHARE`` revisits is repeated for every
``SHARE`` of them, so they meet it in several tasks.

``outcome`` is ``resolved``; ``unvalidated`` (no validator to compare; resolved, too); ``mismatch`` or
``no_original`` (neither headers of an original nor payload).  Records at the same time are in the order of their ids.
Null URLs, dates or types match nothing.  Repeated revisit rows are each returned; of a repeated original
one row counts.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.llm.staging import stage

BLOCK_SECONDS = 86_400
# Revisits that meet one copy of their original.
SHARE = 500
# Revisits without an original are spread over so many keys.
ALONE = 1024

# The fields of a stored response that a 304 answer updates.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]

HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www.``, default ports, fragment, ``utm_`` parameters and final slash; host in lower case."""
    bare = F.regexp_replace(url, r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    rest = F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?]*(.*)$", 1)
    rest = F.regexp_replace(rest, r"(?<=[?&])utm_[A-Za-z]+=[^&]*(&|$)", "")
    return F.concat(host, F.regexp_replace(F.regexp_replace(rest, r"[?&]+$", ""), r"/+$", ""))


def parse_headers(block: Column) -> Column:
    """Name and value of every header line of an HTTP header block, in order; the status line is none."""
    lines = F.filter(F.split(block, "\r?\n"), lambda line: line.rlike("^[^:\\s]+:"))
    return F.transform(
        lines,
        lambda line: F.struct(
            F.regexp_extract(line, "^([^:\\s]+):", 1).alias("name"),
            F.trim(F.regexp_extract(line, "^[^:\\s]+:(.*)$", 1)).alias("value"),
        ),
    )


def header(headers: Column, name: str) -> Column:
    """The first value of a header, by its name in any case."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def merge_headers(stored: Column, update: Column) -> Column:
    """Stored headers without those updated, then the permitted ones of the update."""
    fresh = F.filter(update, lambda h: F.lower(h["name"]).isin(PERMITTED))
    names = F.transform(fresh, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), fresh)


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def as_of(full: DataFrame, later: DataFrame, block_seconds: int) -> DataFrame:
    """``(record_id, original_id)`` for rows of ``later``: the last row of ``full`` of the same URL before it.

    Both have ``record_id, url, at`` (seconds).
    """
    block = F.floor(F.col("at") / block_seconds)
    rows = full.select("record_id", "url", "at", block.alias("block"), F.lit(True).alias("full")).unionByName(
        later.select("record_id", "url", "at", block.alias("block"), F.lit(False).alias("full"))
    )
    place = F.struct("at", "record_id")
    last = rows.groupBy("url", "block").agg(F.max(F.when(F.col("full"), place)).alias("last"))
    before = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url", "block", F.max("last").over(before)["record_id"].alias("carried"))
    inside = Window.partitionBy("url", "block").orderBy("at", "record_id", "full").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("own", F.last(F.when(F.col("full"), F.col("record_id")), ignorenulls=True).over(inside))
    return (
        found.filter("not full")
        .join(carried, ["url", "block"])
        .select("record_id", F.coalesce("own", "carried").alias("original_id"))
        .dropDuplicates(["record_id"])
    )


def resolve(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """``record_id, canonical_url, original_id, outcome, headers, payload`` of every not-modified revisit.

    ``records`` has ``record_id`` (unique), ``warc_type``, ``target_uri``, ``warc_date`` (ISO 8601), ``http_headers``
    (a header block with its status line) and ``payload``.
    """
    status = F.regexp_extract("http_headers", r"^HTTP/\S+ (\d{3})", 1)
    common = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("target_uri")).alias("url"),
        F.unix_timestamp(F.try_to_timestamp("warc_date")).alias("at"),
        "http_headers",
        "payload",
        ((F.col("warc_type") == "response") & status.startswith("2")).alias("is_full"),
        ((F.col("warc_type") == "revisit") & (status == "304")).alias("is_revisit"),
    )
    narrow = stage(
        common.filter("(is_full or is_revisit) and url is not null and at is not null").select(
            "record_id", "url", "at", "is_full", "is_revisit"
        ),
        "captures",
    )
    matched = stage(as_of(narrow.filter("is_full"), narrow.filter("is_revisit"), block_seconds), "matched")
    # Originals with more than ``SHARE`` revisits, and repeated ones: short lists.
    shares = F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares")
    heavy = stage(matched.filter("original_id is not null").groupBy("original_id").agg(shares).filter("shares > 1"), "heavy")
    counted = narrow.filter("is_full").groupBy(F.col("record_id").alias("original_id")).agg(F.count(F.lit(1)).alias("rows"))
    repeated = stage(counted.filter("rows > 1").select("original_id"), "repeated")
    revisits = common.filter("is_revisit").select("record_id", "url", parse_headers(F.col("http_headers")).alias("fresh"))
    full = common.filter("is_full and record_id is not null and url is not null and at is not null").select(
        F.col("record_id").alias("original_id"), parse_headers(F.col("http_headers")).alias("stored"), "payload"
    )
    # Payloads are shuffled once, to their revisits; only repeated originals are put together before.
    several = full.join(repeated, "original_id", "left_semi").dropDuplicates(["original_id"])
    originals = full.join(repeated, "original_id", "left_anti").unionByName(several)
    copies = originals.join(heavy, "original_id", "left").withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))
    )
    # Rows without an original have no share and would all meet in one task.
    alone = F.pmod(F.xxhash64("record_id"), F.lit(ALONE)).cast("int")
    own = F.pmod(F.xxhash64("record_id"), F.coalesce("shares", F.lit(1))).cast("int")
    asked = revisits.join(matched.join(heavy, "original_id", "left"), "record_id", "left")
    asked = asked.withColumn("share", F.when(F.col("original_id").isNull(), alone).otherwise(own)).drop("shares")
    joined = asked.join(copies.drop("shares"), ["original_id", "share"], "left")
    tags = (header(F.col("fresh"), "etag"), header(F.col("stored"), "etag"))
    dates = (header(F.col("fresh"), "last-modified"), header(F.col("stored"), "last-modified"))
    outcome = (
        F.when(F.col("original_id").isNull(), "no_original")
        .when(tags[0].isNotNull() & tags[1].isNotNull(), F.when(_strong(tags[0]) == _strong(tags[1]), "resolved").otherwise("mismatch"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    taken = F.col("outcome").isin("resolved", "unvalidated")
    return joined.withColumn("outcome", outcome).select(
        "record_id",
        F.col("url").alias("canonical_url"),
        "original_id",
        "outcome",
        F.when(taken, merge_headers(F.col("stored"), F.col("fresh"))).otherwise(F.col("fresh")).alias("headers"),
        F.when(taken, F.col("payload")).alias("payload"),
    )


# Records derived from ``pages``: four captures of every page under varying forms of its URL.
CAPTURES = """
    SELECT page_id * 4 + k AS record_id, page_id, k, html,
      CASE WHEN (k = 0 AND page_id % 10 <> 9) OR (k = 2 AND page_id % 3 = 0) THEN 'response' ELSE 'revisit' END AS warc_type,
      CASE k WHEN 0 THEN url WHEN 1 THEN url || '#again' WHEN 2 THEN replace(url, 'http://', 'https://')
        ELSE url || CASE WHEN url LIKE '%#%' THEN '' WHEN url LIKE '%?%' THEN '&utm_medium=x' ELSE '?utm_medium=x' END END AS target_uri,
      {at} AS warc_date,
      CASE WHEN k = 2 THEN html || '<!-- changed -->' ELSE html END AS body,
      CASE WHEN k >= 2 AND page_id % 3 = 0 THEN md5(html || '2') ELSE md5(html || '0') END AS tag
    FROM (SELECT p.*, {ks} AS k FROM pages p) c
"""
RECORDS = """
    SELECT record_id, warc_type, target_uri, warc_date,
      CASE WHEN warc_type = 'response' THEN 'HTTP/1.1 200 OK' ELSE 'HTTP/1.1 304 Not Modified' END || {nl} ||
      'Date: ' || warc_date || {nl} ||
      CASE WHEN k = 3 AND page_id % 4 = 0 THEN 'ETag: "other"' || {nl} WHEN k = 3 AND page_id % 4 IN (1, 2) THEN ''
        WHEN k = 1 THEN 'ETag: W/"' || tag || '"' || {nl} ELSE 'ETag: "' || tag || '"' || {nl} END ||
      CASE WHEN k = 3 AND page_id % 4 = 2 THEN '' ELSE 'Last-Modified: day ' || CAST(page_id % 28 AS STRING) || {nl} END ||
      'Cache-Control: max-age=' || CAST(60 * (k + 1) AS STRING) || {nl} ||
      'Content-Type: text/html; v=' || CAST(k AS STRING) || {nl} || 'X-Served-By: cache' || CAST(page_id % 7 AS STRING) AS http_headers,
      CASE WHEN warc_type = 'response' THEN body END AS payload
    FROM ({captures}) r
"""
EPOCH = "1704067200 + page_id * 7 + k * 90000"


def records_of_pages(pages: DataFrame) -> DataFrame:
    """WARC records derived from a table of pages."""
    at = f"date_format(timestamp_seconds({EPOCH}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    captures = CAPTURES.format(at=at, ks="explode(sequence(0, 3))").replace("FROM pages p", "FROM {pages} p")
    text = RECORDS.format(nl="chr(13) || chr(10)", captures=captures)
    return pages.sparkSession.sql(text, pages=pages)
