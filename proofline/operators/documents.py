"""Document metadata, section chunks and current-version resolution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.text import SPACE, rstrip, strip

EXPORT_COLUMNS = (
    "chunk_id",
    "doc_id",
    "section",
    "chunk_index",
    "content",
    "content_hash",
    "version",
    "effective_date",
    "owner",
    "is_current",
    "source_path",
)


@dataclass(frozen=True)
class HeaderPatterns:
    """How header lines name their parts; the default reads Vietnamese headers.

    Fixed values: the words for version, issued, updated, approver and "replaces the previous
    version", with the spellings that occur.
    """

    version: str = rf"Phi[eê]n[{SPACE}]+b[aả]n[{SPACE}]+(\p{{Nd}}+\.\p{{Nd}}+)"
    date: str = (
        rf"(?:Ban[{SPACE}]+h[^{SPACE}]+nh|C[^{SPACE}]+p[{SPACE}]+nh[^{SPACE}]+t)[{SPACE}]*:[{SPACE}]*"
        r"(\p{Nd}{1,2})/(\p{Nd}{4})"
    )
    approver: str = rf"Ng[ưu][oờ]i[{SPACE}]+duy[eệ]t[{SPACE}]*:[{SPACE}]*([^·]+)"
    department: str = r"\*\*([^*]+)\*\*"
    supersedes: str = "Thay thế phiên bản trước"


VIETNAMESE = HeaderPatterns()


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def header_metadata(documents: DataFrame, line: str, patterns: HeaderPatterns = VIETNAMESE) -> DataFrame:
    """Add the metadata found in the header line column ``line`` (NULL line: nothing found)."""
    header = F.col(line)
    month = F.lpad(F.regexp_extract(header, patterns.date, 1), 2, "0")
    year = _found(header, patterns.date, 2)
    approver = _found(header, patterns.approver)
    return documents.withColumns(
        {
            "version": _found(header, patterns.version),
            "effective_date": F.concat_ws("-", F.when(year.isNotNull(), year), F.when(year.isNotNull(), month)),
            "department": F.when(
                header.rlike(patterns.department), strip(F.regexp_extract(header, patterns.department, 1))
            ),
            "approver": F.when(approver.isNotNull(), strip(approver)),
            "supersedes_previous": F.coalesce(F.contains(header, F.lit(patterns.supersedes)), F.lit(False)),
        }
    ).withColumn("effective_date", F.nullif("effective_date", F.lit("")))


def document_inventory(documents: DataFrame, patterns: HeaderPatterns = VIETNAMESE) -> DataFrame:
    """Identity, digest and header metadata of every document; the text stays with it."""
    stem = F.regexp_replace("file_name", r"(?<=.)\.[^.]*\z", "")
    # The header is the first line that starts with two asterisks.
    line = _found(F.col("md_text"), r"(?md)^(\*\*[^\n]*)$")
    named = documents.withColumns(
        {
            "doc_id": F.coalesce(_found(stem, r"^([A-Z]+-\p{Nd}+)"), stem),
            "filename_version_hint": F.lower(_found(stem, r"(?i)(_v\p{Nd}+)\z")),
            "header_line": F.when(line.isNotNull(), strip(line)),
        }
    )
    return header_metadata(named, "header_line", patterns).drop("header_line")


def chunk_sections(documents: DataFrame, keep_preamble: bool = False, carried: Sequence[str] = ()) -> DataFrame:
    """One row per ``## `` section, title and header line repeated on each, and the document's columns ``carried``.

    Text between the header and the first section is left out unless ``keep_preamble`` asks for a
    chunk of its own; a document without sections is one chunk.
    """
    text = F.col("md_text")
    title_pattern, header_pattern = r"(?md)^(# .+)$", r"(?md)^(\*\*.*\*\*.*)$"
    title = F.regexp_extract(text, title_pattern, 1)
    header = F.regexp_extract(text, header_pattern, 1)
    has_sections = text.rlike(r"(?md)^## .")
    # Without sections: what follows the title, and what follows the first header line after that.
    rest = F.when(title == "", text).otherwise(
        F.ltrim(F.regexp_replace(text, r"(?s)\A.*?(?:(?<=\n)|\A)# [^\n]+", ""), F.lit("\n"))
    )
    body = F.when(~rest.rlike(header_pattern), rest).otherwise(
        F.ltrim(F.regexp_replace(rest, r"(?s)\A.*?(?:(?<=\n)|\A)\*\*[^\n]*\*\*[^\n]*", ""), F.lit("\n"))
    )
    parts = F.split(text, r"(?md)^(?=## .)")
    sections = F.filter(parts, lambda p: p.rlike(r"\A## .")) if not keep_preamble else F.filter(
        parts, lambda p, i: p.rlike(r"\A## .") | ((i == 0) & (strip(p) != ""))
    )
    prepared = documents.withColumns(
        {
            "heading_block": F.concat(
                strip(title), F.lit("\n\n"), F.when(header != "", F.concat(strip(header), F.lit("\n\n"))).otherwise("")
            ),
            "pieces": F.when(has_sections, sections).otherwise(F.array(body)),
            "sectioned": has_sections,
        }
    ).drop("md_text")
    # There is always a piece; the outer form keeps Spark from testing that with a second split.
    rows = prepared.select("*", F.posexplode_outer("pieces").alias("chunk_index", "piece")).drop("pieces")
    is_section = F.col("sectioned") & F.col("piece").rlike(r"\A## .")
    first_line = strip(F.regexp_extract("piece", r"\A([^\n]*)", 1))
    after = F.regexp_replace("piece", r"\A[^\n]*", "")
    content = F.when(
        is_section, F.concat(F.col("heading_block"), first_line, F.lit("\n"), rstrip(after))
    ).otherwise(F.concat(F.col("heading_block"), F.col("piece")))
    section = (
        F.when(is_section, strip(F.regexp_replace(first_line, "^#+", "")))
        .when(F.col("sectioned"), F.lit("(preamble)"))
        .otherwise(F.lit("(full document)"))
    )
    label = F.coalesce(
        "version", F.regexp_replace("filename_version_hint", "^_+", ""), F.lit("v0")
    )
    return rows.select(
        F.concat(F.col("doc_id"), F.lit("_"), label, F.lit("_chunk"), F.col("chunk_index").cast("string")).alias(
            "chunk_id"
        ),
        "doc_id",
        section.alias("section"),
        F.col("chunk_index").cast("long").alias("chunk_index"),
        F.concat(rstrip(content), F.lit("\n")).alias("content"),
        "version",
        "effective_date",
        F.col("department").alias("owner"),
        "source_path",
        *carried,
    ).withColumn("content_hash", F.sha2("content", 256))


def current_paths(documents: DataFrame) -> DataFrame:
    """``source_path`` of the current document of each ``doc_id``.

    A document that says it replaces the previous one beats any that does not; then the latest
    date counts, then the first path.  Two aggregations with map-side combining, no sort of a
    family, so a family of any size is fine.
    """
    ranked = documents.select(
        "doc_id", "supersedes_previous", F.coalesce("effective_date", F.lit("0000-00")).alias("dated"), "source_path"
    )
    first = ranked.groupBy("doc_id", "supersedes_previous", "dated").agg(F.min("source_path").alias("source_path"))
    return first.groupBy("doc_id").agg(
        F.max_by("source_path", F.struct("supersedes_previous", "dated")).alias("source_path")
    ).select("source_path", F.lit(True).alias("is_current"))


def resolve_versions(documents: DataFrame, rows: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Add ``is_current`` to documents or chunks; joined on the path, of which each row has one.

    A run that writes :func:`current_paths` first passes the written table as ``current``: while
    that is small, the rows with their texts join it without a shuffle.
    """
    paths = current_paths(documents) if current is None else current
    joined = rows.join(paths, "source_path", "left")
    return joined.withColumn("is_current", F.coalesce("is_current", F.lit(False)))


def build_chunks(
    documents: DataFrame, patterns: HeaderPatterns = VIETNAMESE, current: DataFrame | None = None
) -> DataFrame:
    """Documents to chunks with the current version marked."""
    inventory = document_inventory(documents, patterns)
    return resolve_versions(inventory, chunk_sections(inventory), current).select(*EXPORT_COLUMNS)


def chunk_export(chunks: DataFrame) -> DataFrame:
    """Export order and form: by document, version and place; the flag as 0 or 1."""
    return (
        chunks.withColumn("is_current", F.col("is_current").cast("int"))
        .select(*EXPORT_COLUMNS)
        .orderBy("doc_id", F.coalesce("version", F.lit("")), "chunk_index", "source_path")
    )


def build_stats(documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Documents, chunks, current and superseded chunks in one row."""
    document_rows = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return chunks.agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if("is_current").alias("current_chunks"),
        F.count_if(~F.col("is_current")).alias("superseded_chunks"),
    ).withColumn("documents", document_rows)
