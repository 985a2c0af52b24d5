"""A digest of what a query computes, from its logical plan."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

_FIELDS = "spark.sql.debug.maxToStringFields"


def logic_digest(result: DataFrame) -> str:
    """SHA-256 of the canonical analysed plan of ``result``: equal for equal logic, whatever its columns are called inside.

    Build ``result`` over empty tables of the input's schema: then paths and sizes are not part of the plan, and any other operator,
    expression or constant changes the digest.  The plan's size depends on the code alone; nothing is run.
    """
    spark = result.sparkSession
    before = spark.conf.get(_FIELDS)
    spark.conf.set(_FIELDS, "1000000")
    try:
        text = result._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        spark.conf.set(_FIELDS, before)
    return hashlib.sha256(_renumbered(text).encode()).hexdigest()


def _renumbered(text: str) -> str:
    """Numbers that Spark hands out while a session runs, replaced by their order in the text."""
    seen: dict[str, str] = {}
    plain = re.sub(r"plan_id=\d+", "plan_id", text)
    plain = re.sub(r"\b([xyz])_\d+\b", r"\1", plain)
    return re.sub(r"#\d+", lambda m: seen.setdefault(m.group(), f"#{len(seen)}"), plain)
