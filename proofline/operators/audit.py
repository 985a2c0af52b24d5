"""Audit of a text corpus: secrets, lengths, required items, exclusions, and a verdict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.text import word_count

# Label and pattern of what must not leak.
SECRET_PATTERNS = {
    "AWS access key": r"AKIA[0-9A-Z]{16}",
    "possible secret key (40 hex)": r"(?<![0-9a-f])[0-9a-f]{40}(?![0-9a-f])",
    "absolute machine path leak": r"/mnt/data/\w+",
    "absolute home path leak": r"/home/\w+",
}
# Fixed value: generous number of words on a page.
WORDS_PER_PAGE = 700
# What a scan leaves out unless told otherwise: histories, dependencies and build results; binary and generated files.
EXCLUDED_DIRS = (".git", ".hg", ".svn", "node_modules", "vendor", "build", "dist", "target", "__pycache__")
EXCLUDED_EXTENSIONS = (".7z", ".class", ".gif", ".gz", ".jar", ".jpg", ".lock", ".map", ".pdf", ".png", ".zip")

PASS, WARN, FAIL = "pass", "warn", "fail"


def extension(path: Column) -> Column:
    """Extension with its dot; empty for none, for dot files and for a trailing dot."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)\z", 1)


def scan_exclusions(
    items: DataFrame,
    path: str = "path",
    dirs: Iterable[str] = EXCLUDED_DIRS,
    files: Iterable[str] = (),
    extensions: Iterable[str] = EXCLUDED_EXTENSIONS,
) -> DataFrame:
    """Items outside the excluded folders, paths and extensions; filters on the path column only."""
    parts = F.split(path, "/")
    kept = ~F.arrays_overlap(parts, F.array(*[F.lit(d) for d in dirs])) & ~extension(F.col(path)).isin(
        *extensions
    )
    files = list(files)
    if files:
        kept = kept & ~F.col(path).isin(*files)
    return items.filter(kept)


def secret_scan(
    texts: DataFrame, key: str, text: str = "text", patterns: Mapping[str, str] = SECRET_PATTERNS
) -> DataFrame:
    """``key, label, matches`` for every text and pattern with at least one match.

    The patterns are literals of the scan, so every text is read once and nothing is joined.
    """
    cells = [
        F.struct(F.lit(label).alias("label"), F.regexp_count(text, F.lit(pattern)).cast("long").alias("matches"))
        for label, pattern in patterns.items()
    ]
    # The outer form keeps Spark from counting a second time in a filter of its own.
    counted = texts.select(key, F.array(*cells).alias("cells")).select(key, F.explode_outer("cells").alias("cell"))
    return counted.select(key, "cell.label", "cell.matches").filter(F.col("matches") > 0)


def length_limits(
    texts: DataFrame, limits: DataFrame, key: str, group: str, text: str = "text", words_per_page: int = WORDS_PER_PAGE
) -> DataFrame:
    """Word count against the page limit ``max_pages`` of the text's group; no limit is a warning."""
    counted = texts.select(key, group, word_count(F.col(text)).alias("words"))
    joined = counted.join(limits, group, "left").withColumn("max_words", F.col("max_pages") * words_per_page)
    return joined.withColumn(
        "status",
        F.when(F.col("max_words").isNull(), F.lit(WARN))
        .when(F.col("words") > F.col("max_words"), F.lit(FAIL))
        .otherwise(F.lit(PASS)),
    )


def required_presence(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required keys that are not present."""
    return required.select(key).join(present.select(key), key, "left_anti")


def audit_summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Per check its passes, warnings and failures, and over all of them the verdict.

    Each check is a table with a ``status`` column.
    """
    stacked = None
    for name, frame in sorted(checks.items()):
        counts = frame.agg(
            *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in (PASS, WARN, FAIL)]
        ).select(F.lit(name).alias("check_name"), "*")
        stacked = counts if stacked is None else stacked.unionByName(counts)
    total = stacked.rollup("check_name").agg(
        *[F.sum(f"{s}_count").cast("long").alias(f"{s}_count") for s in (PASS, WARN, FAIL)]
    )
    return total.select(
        F.coalesce("check_name", F.lit("overall")).alias("check_name"),
        "pass_count",
        "warn_count",
        "fail_count",
        F.when(F.col("fail_count") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("verdict"),
    )
