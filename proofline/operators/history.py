"""Digests of the records kept so far, stored by prefix, and the few of them that a new batch can meet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.sources.sinks import path_exists

# Hexadecimal digits of a digest that name its folder.
PREFIX_DIGITS = 1
# Bits of one page of the filter (what Spark's bitmap aggregate holds), bits per digest, and pages at most: 1 MB in all.
PAGE_BITS = 32_768
BITS_PER_DIGEST = 16
MAX_PAGES = 256
_HASHES = 2

_SCHEMA = "record_digest string, retained_seq long, batch_id long, prefix string"


@dataclass(frozen=True)
class DigestHistory:
    """``record_digest, retained_seq`` of all batches below one shared folder, by batch and prefix."""

    root: str

    def append(self, batch_id: int, kept: DataFrame) -> None:
        """Store the digests a batch keeps; a replayed batch replaces its own."""
        rows = kept.select("record_digest", "retained_seq", _prefix(F.col("record_digest")).alias("prefix"))
        writer = rows.hint("rebalance", "prefix").sortWithinPartitions("prefix", "record_digest").write
        writer.mode("overwrite").option("compression", "zstd").partitionBy("prefix").parquet(f"{self.root}/batch_id={batch_id}")

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Digests kept in batches before this one; a replayed batch does not see its own."""
        if not path_exists(spark, self.root):
            return spark.createDataFrame([], _SCHEMA)
        return spark.read.schema(_SCHEMA).parquet(self.root).filter(F.col("batch_id") < batch_id)

    def matching(self, spark: SparkSession, batch_id: int, wanted: DataFrame) -> DataFrame:
        """``record_digest, retained_seq`` of earlier digests that may be in ``wanted``: all that are, and few others.

        Only the folders of the batch's own prefixes are read, and a Bloom filter of the batch drops almost all that it does not
        hold where they are read, before anything is shuffled.  The filter has at most ``MAX_PAGES`` pages; a larger batch fills
        it more and drops less.  What comes to the driver is a count and a set of prefixes.
        """
        earlier = self.before(spark, batch_id)
        asked = wanted.select("record_digest").filter("record_digest is not null")
        known = asked.agg(F.count(F.lit(1)).alias("n"), F.collect_set(_prefix(F.col("record_digest"))).alias("prefixes")).first()
        near = earlier.filter(F.col("prefix").isin(sorted(known["prefixes"])))
        pages = page_count(known["n"])
        return may_contain(near, bloom_pages(asked, pages), pages).select("record_digest", "retained_seq")


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_DIGITS)


def page_count(digests: int) -> int:
    """A power of two of pages for that many digests."""
    pages = 1
    while pages < MAX_PAGES and pages * PAGE_BITS < digests * BITS_PER_DIGEST:
        pages *= 2
    return pages


def _places(digest: Column, pages: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(pages * PAGE_BITS)) for i in range(_HASHES)]


def _page(place: Column) -> Column:
    return F.shiftright(place, PAGE_BITS.bit_length() - 1).cast("int")


def _bit(place: Column) -> Column:
    return place.bitwiseAND(F.lit(PAGE_BITS - 1)).cast("int")


def bloom_pages(digests: DataFrame, pages: int) -> DataFrame:
    """``page, bits``: a Bloom filter of ``record_digest`` in pages; combines on the map side."""
    places = digests.select(F.explode(F.array(*_places(F.col("record_digest"), pages))).alias("place"))
    return places.groupBy(_page(F.col("place")).alias("page")).agg(F.bitmap_construct_agg(_bit(F.col("place")).cast("long")).alias("bits"))


def may_contain(rows: DataFrame, filter_pages: DataFrame, pages: int) -> DataFrame:
    """The rows whose ``record_digest`` the filter may hold."""
    found = rows
    for i, place in enumerate(_places(F.col("record_digest"), pages)):
        # At most MAX_PAGES rows of 4 KiB.
        page = F.broadcast(filter_pages.select(F.col("page").alias(f"page_{i}"), F.col("bits").alias(f"bits_{i}")))
        bit = _bit(place)
        byte = F.conv(F.hex(F.substring(F.col(f"bits_{i}"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("getbit", byte.cast("long"), bit.bitwiseAND(F.lit(7))) == 1
        found = found.join(page, _page(place) == F.col(f"page_{i}")).filter(is_set).select(*rows.columns)
    return found
