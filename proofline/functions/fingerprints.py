"""Content fingerprints that do not depend on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LANES = 4
_LANE_DIGITS = 15
_PART_BITS = 20


def row_text(frame: DataFrame) -> Column:
    """All columns of a row, by name order, as one unambiguous JSON array of texts and nulls."""
    cells = []
    for field in sorted(frame.schema.fields, key=lambda f: f.name):
        nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        cells.append(F.to_json(field.name) if nested else F.col(field.name).cast("string"))
    return F.to_json(F.array(*cells), {"ignoreNullFields": "false"})


def row_hash(frame: DataFrame) -> Column:
    return F.sha2(row_text(frame), 256)


def lane_sums(row_digest: Column) -> list[Column]:
    """Aggregates ``lane_0`` and on of row digests, whose values do not depend on order.

    Each digest is cut into four 60-bit numbers; their sums commute, so partial sums combine
    on the map side.  A number is summed in three parts of 20 bits, as longs, which hold 2^43 rows and cost less than decimals; only the
    three sums are put together as a decimal.
    """
    mask = F.lit((1 << _PART_BITS) - 1).cast("long")

    def lane(i: int) -> Column:
        number = F.conv(F.substring(row_digest, 1 + i * _LANE_DIGITS, _LANE_DIGITS), 16, 10).cast("long")
        parts = [F.sum(F.shiftright(number, _PART_BITS * at).bitwiseAND(mask)).cast("decimal(38,0)") for at in range(3)]
        high = parts[2] * F.lit(1 << 2 * _PART_BITS).cast("decimal(38,0)")
        return high + parts[1] * F.lit(1 << _PART_BITS).cast("decimal(38,0)") + parts[0]

    zero = F.lit(0).cast("decimal(38,0)")
    return [F.coalesce(lane(i).cast("decimal(38,0)"), zero).alias(f"lane_{i}") for i in range(_LANES)]


def fingerprint_of(row_count: str = "row_count") -> Column:
    """The fingerprint from a count and lane sums."""
    parts = [row_count, *[f"lane_{i}" for i in range(_LANES)]]
    return F.sha2(F.concat_ws(":", *[F.col(p).cast("string") for p in parts]), 256)


def content_fingerprint(frame: DataFrame) -> DataFrame:
    """One row ``row_count, fingerprint``: equal for equal multisets of rows."""
    digest = frame.select(row_hash(frame).alias("h"))
    sums = digest.agg(F.count(F.lit(1)).alias("row_count"), *lane_sums(F.col("h")))
    return sums.select("row_count", fingerprint_of().alias("fingerprint"))


def bucket_of(keys: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_fingerprints(frame: DataFrame, keys: tuple[str, ...], buckets: int) -> DataFrame:
    """``bucket, row_count, fingerprint`` of the rows of every bucket of keys; what leaves a task is at most a row a bucket."""
    digest = frame.select(bucket_of(keys, buckets).alias("bucket"), row_hash(frame).alias("h"))
    sums = digest.groupBy("bucket").agg(F.count(F.lit(1)).alias("row_count"), *lane_sums(F.col("h")))
    return sums.select("bucket", "row_count", fingerprint_of().alias("fingerprint"))
