"""Checks of size in front of a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    frame: DataFrame, text_column: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``frame`` itself is proven small; every task sends one count and one sum."""
    measured = frame.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0)).alias("bytes")
    ).first()
    return measured["n"] <= max_rows and measured["bytes"] <= max_bytes
