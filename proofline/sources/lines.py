"""Physical lines of text files, with provenance that does not depend on partitioning.

``LineSet.lines`` has ``file_no, source_line, line_seq, raw_line, byte_length, text_valid`` and
``LineSet.files`` has ``file_no, source_path, source_sha256``.  ``line_seq`` puts file number and
line number into one BIGINT, so "earlier" is a comparison of two longs and paths and digests need
not travel with every row; they are joined on where a table is published.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from proofline.functions.fingerprints import content_fingerprint
from proofline.session import shared_folder

DEFAULT_MAX_LINE_BYTES = 1_048_576
# Bits of ``line_seq`` below the file number: 68 billion lines per file, 134 million files.  A line beyond
# either is an error; larger inputs are cut into files.
LINE_BITS = 36
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


@dataclass(frozen=True)
class LineSet:
    """Lines and the files they come from."""

    lines: DataFrame
    files: DataFrame


def line_seq(file_no: Column, source_line: Column) -> Column:
    fits = source_line.between(0, (1 << LINE_BITS) - 1) & file_no.between(0, (1 << (63 - LINE_BITS)) - 1)
    return F.when(fits, F.shiftleft(file_no.cast("long"), LINE_BITS) + source_line).otherwise(
        F.raise_error(F.lit("a line number does not fit")).cast("long")
    )


def seq_line(seq: Column) -> Column:
    return seq.bitwiseAND(F.lit((1 << LINE_BITS) - 1))


def seq_file(seq: Column) -> Column:
    return F.shiftright(seq, LINE_BITS)


def scan_text(
    spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None, pattern: str = "*"
) -> DataFrame:
    """Raw scan: only ``\\n`` ends a line; each row knows its file and the start of its split."""
    reader = spark.readStream if streaming else spark.read
    options = {"lineSep": "\n", "recursiveFileLookup": "true", "pathGlobFilter": pattern}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    return reader.format("text").options(**options).load(path).select(
        "value",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def stage_scan(scan: DataFrame, path: str | None = None) -> DataFrame:
    """Write a scan once with ``row_id``, the place of every line in its split, and read it back.

    ``monotonically_increasing_id`` counts rows inside a scan task, and a split is read by one task in order.  The numbers are
    stored with the lines, so nothing later depends on how another scan would be cut into tasks.
    """
    spark = scan.sparkSession
    path = path or shared_folder(spark, "scan")
    numbered = scan.withColumn("value", F.col("value").cast("binary")).withColumn("row_id", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(numbered.schema).parquet(path)


def stage_splits(staged: DataFrame, path: str | None = None) -> DataFrame:
    """One row per split of a staged scan: its first ``row_id`` and how many lines of its file come before it.

    The counts are written to the shared folder: what reads them back knows their size, and Spark broadcasts them when
    they are small and joins by split when they are not.  A split whose ids have a gap is an error, never a wrong number.
    """
    spark = staged.sparkSession
    path = path or shared_folder(spark, "splits")
    staged.groupBy("source_path", "block_start").agg(
        F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
        F.count(F.lit(1)).alias("split_lines"),
        F.sum(F.octet_length("value").cast("long") + F.lit(1)).alias("split_bytes"),
        F.max("file_size").alias("file_size"),
    ).write.mode("overwrite").parquet(path)
    by_file = Window.partitionBy("source_path")
    running = by_file.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.col("last_id") - F.col("first_id") + 1 == F.col("split_lines")
    gap = F.raise_error(F.concat(F.lit("the lines of a split are not numbered without gaps: "), "source_path")).cast("long")
    excess = F.sum("split_bytes").over(by_file) - F.col("file_size")
    return spark.read.parquet(path).select(
        "source_path",
        "block_start",
        F.when(whole, F.col("first_id")).otherwise(gap).alias("first_id"),
        F.coalesce(F.sum("split_lines").over(running), F.lit(0)).alias("lines_before"),
        F.sum("split_lines").over(by_file).alias("file_lines"),
        "file_size",
        # The last line of a plain file has no newline when the bytes come out one short; the reader drops a byte order mark.
        excess.isin(1, 1 - len(BYTE_ORDER_MARK)).alias("unterminated"),
        excess.isin(-len(BYTE_ORDER_MARK), 1 - len(BYTE_ORDER_MARK)).alias("marked"),
        # One row per split: small enough to rank in one place.
        (F.dense_rank().over(Window.orderBy("source_path")) - 1).cast("long").alias("file_no"),
    )


def scanned_files(splits: DataFrame) -> DataFrame:
    """``file_no, source_path, line_count`` of the files of a scan."""
    return splits.groupBy("file_no", "source_path").agg(F.max("file_lines").alias("line_count"))


def number_lines(staged: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Give every line of a staged scan its 1-based number in its file; the rows stay where they are."""
    offsets = stage_splits(staged) if splits is None else splits
    value = F.col("value").cast("string")
    text = F.make_valid_utf8(value)
    ends_file = F.col("unterminated") & (F.col("source_line") == F.col("file_lines"))
    return (
        staged.drop("file_size")
        .join(offsets, ["source_path", "block_start"])
        .withColumn("source_line", F.col("row_id") - F.col("first_id") + F.col("lines_before") + 1)
        .select(
            "file_no",
            "source_path",
            "source_line",
            line_seq(F.col("file_no"), F.col("source_line")).alias("line_seq"),
            F.rtrim(text, F.lit("\r\n")).alias("raw_line"),
            (F.octet_length("value") + F.when(ends_file, 0).otherwise(1)).cast("long").alias("byte_length"),
            F.is_valid_utf8(value).alias("text_valid"),
        )
    )


def numbering_check(lines: DataFrame, files: DataFrame) -> DataFrame:
    """``source_path, lines, ok``: the numbers of every file run from 1 to its count of lines, each once."""
    seen = lines.groupBy("file_no").agg(
        F.count(F.lit(1)).alias("lines"), F.min("source_line").alias("first"), F.max("source_line").alias("last"), F.sum("source_line").alias("total")
    )
    gauss = F.col("lines") * (F.col("lines") + 1) == 2 * F.col("total")
    ok = (F.col("first") == 1) & (F.col("last") == F.col("lines")) & (F.col("lines") == F.col("line_count")) & gauss
    return files.join(seen, "file_no", "left").select("source_path", "lines", F.coalesce(ok, F.lit(False)).alias("ok"))


def digests_of(staged: DataFrame, splits: DataFrame) -> DataFrame:
    """``source_path, byte_size, source_sha256`` of the files of a staged scan, from their lines.

    The lines of a file pass through one task in order and are hashed as they come, so memory does not depend on a file's
    size and its store is one that Spark reads.  A compressed file's digest is that of its lines, each with its newline.
    """
    flags = splits.groupBy("source_path").agg(
        F.max("file_size").alias("byte_size"), F.max("unterminated").alias("unterminated"), F.max("marked").alias("marked")
    )
    rows = staged.select("source_path", "block_start", "row_id", "value").join(flags, "source_path")
    dealt = rows.repartition("source_path").sortWithinPartitions("source_path", "block_start", "row_id")
    narrow = dealt.select("source_path", "byte_size", "unterminated", "marked", "value")
    return narrow.mapInArrow(_stream_digests, "source_path string, byte_size long, source_sha256 string")


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    path, size, open_end, digest = None, 0, False, hashlib.sha256()

    def done() -> pa.RecordBatch:
        if not open_end:
            digest.update(b"\n")
        arrays = [pa.array([path]), pa.array([size], pa.int64()), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(arrays, names=["source_path", "byte_size", "source_sha256"])

    for batch in batches:
        names = batch.column(0).dictionary_encode()
        codes = names.indices.to_numpy()
        edges = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
        for begin, end in zip(edges[:-1], edges[1:]):
            if begin == end:
                continue
            name = names[begin].as_py()
            values = b"\n".join(batch.column(4).slice(begin, end - begin).to_pylist())
            if name == path:
                digest.update(b"\n")
            else:
                if path is not None:
                    yield done()
                path, size, open_end = name, batch.column(1)[begin].as_py(), batch.column(2)[begin].as_py()
                digest = hashlib.sha256(BYTE_ORDER_MARK if batch.column(3)[begin].as_py() else b"")
            digest.update(values)
    if path is not None:
        yield done()


def file_fingerprints(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``source_path, byte_size, source_sha256`` of every file below ``path`` with a byte in it, whatever its size."""
    staged = stage_scan(scan_text(spark, path, pattern=pattern))
    options = {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
    # The listing alone: contents are not read.
    listed = spark.read.format("binaryFile").options(**options).load(path).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("length").alias("byte_size")
    )
    # A file of nothing but a byte order mark has no line.
    bare = F.when(F.col("byte_size") == len(BYTE_ORDER_MARK), F.sha2(F.lit(BYTE_ORDER_MARK), 256))
    unread = F.raise_error(F.concat(F.lit("no digest of "), "source_path"))
    found = listed.join(digests_of(staged, stage_splits(staged)).drop("byte_size"), "source_path", "left")
    return found.select("source_path", "byte_size", F.coalesce("source_sha256", bare, unread).alias("source_sha256"))


def with_digests(files: DataFrame, digests: DataFrame) -> DataFrame:
    """``files`` with ``source_sha256``; a file without a digest is an error, not a null."""
    joined = files.join(digests.select("source_path", "source_sha256"), "source_path", "left")
    missing = F.raise_error(F.concat(F.lit("no digest of "), "source_path"))
    return joined.select(*files.columns, F.coalesce("source_sha256", missing).alias("source_sha256"))


def read_lines(spark: SparkSession, path: str, fingerprints: DataFrame | None = None) -> LineSet:
    """Lines and files below ``path``; pass ``fingerprints`` when a store already knows digests."""
    staged = stage_scan(scan_text(spark, path))
    splits = stage_splits(staged)
    digests = digests_of(staged, splits) if fingerprints is None else fingerprints
    files = with_digests(scanned_files(splits), digests)
    return LineSet(
        number_lines(staged, splits).drop("source_path"), files.select("file_no", "source_path", "source_sha256", "line_count")
    )


def from_table(lines: DataFrame, source_path: str) -> LineSet:
    """A line set from a table ``source_line, raw_line`` that stands for one file.

    Its digest is the content fingerprint of all numbered lines: no bytes of a file are there to be hashed.
    """
    files = content_fingerprint(lines.select(F.col("source_line").cast("long").alias("source_line"), "raw_line")).select(
        F.lit(0).cast("long").alias("file_no"),
        F.lit(source_path).alias("source_path"),
        F.col("fingerprint").alias("source_sha256"),
    )
    rows = lines.select(
        F.lit(0).cast("long").alias("file_no"),
        F.col("source_line").cast("long").alias("source_line"),
        line_seq(F.lit(0).cast("long"), F.col("source_line").cast("long")).alias("line_seq"),
        "raw_line",
        (F.octet_length("raw_line") + 1).cast("long").alias("byte_length"),
        F.lit(True).alias("text_valid"),
    )
    return LineSet(rows, files)
