"""Substring dedup by suffix order: every string of ``LENGTH`` bytes that occurs before.

A suffix's longest previous factor is its longest common prefix with a suffix at a smaller text position; in suffix order that
is one of two, the previous and the next smaller position.  Only suffixes that share ``LENGTH`` bytes have to be
ordered together, so suffixes are dealt by an anchor: the ``GRAM``-byte gram of least hash in
their first ``LENGTH`` bytes.  Equal strings choose equal anchors at equal places.  An anchor found
once has no repeated string; only the others' surroundings are read again and shuffled.

In a bucket of one anchor the suffixes at each distance from it are put in suffix order (``contexts.Suffixes``), and the array of
their longest previous factors is made from previous and next smaller positions (``contexts.longest_previous``).  Where it
reaches ``LENGTH`` there is an earlier match: ``keep_first`` drops these bytes, so the first copy stays; else the longest next
factors are made in the same way, and what has a match on either side goes.  Bytes are compared, not only hashes.

Hot buckets: documents with equal texts are one text from the start; an anchor met more than
``HOT_ROWS`` times is not gathered, its strings are compared by MD5 in an aggregation that combines on
the map side.

Null and empty texts have no bytes.  Matches never cross documents.  Texts of any length are read in
overlapping pieces.  Distinct texts are named by their digest: a text under several ids, and several texts under one id, are
found as such.  Rows with one ``doc_id`` and text are one document; repeated rows are each returned.  A null id is an id like any
other and comes after all others; of different texts under one least id the one of the smaller digest comes first.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm.arrays import PIECE, Powers, anchors, byte_values, flat_text, pieces
from proofline.llm.contexts import Suffixes, longest_previous, merged, runs_of, whole_buckets
from proofline.llm.staging import keyed_texts, stage

LENGTH = 400
GRAM = 128
HOT_ROWS = 20_000
# Rows of sorted buckets compared at once.
TABLE_ROWS = 8192

ANCHORS = "array<struct<hash:long,pos:long,low:int,high:int>>"
SPAN = "array<struct<start:long,end:long>>"
SEGMENT = "hash long, text_id long, owner long, lead long, pos long, low int, high int, hot boolean, segment binary"
# The order of text positions, and what stands for a null id in it.
PLACE = ("owner", "lead", "text_id", "pos")
NO_ID = (1 << 63) - 1


def anchor_texts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, digest, n_bytes, anchors`` of every row."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, table = Powers(), byte_values()
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            found: list[tuple[np.ndarray, ...]] = []
            for bounds, first, base in pieces(offsets, PIECE, length - 1):
                row, pos, code, low, high = anchors(table[data[bounds[0] : bounds[-1]]], bounds, gram, length, powers)
                inside = pos - (bounds[row] - bounds[0]) + base
                found.append((row + first, inside, code, low, high))
            row, pos, code, low, high = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
            starts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            cells = pa.StructArray.from_arrays(
                [pa.array(code.astype(np.uint64).view(np.int64)), pa.array(pos), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                fields=list(kind.value_type),
            )
            view = memoryview(data)
            digests = [hashlib.sha256(view[b:e]).digest() for b, e in zip(offsets[:-1], offsets[1:])]
            arrays = [
                batch.column(0),
                pa.array(digests, pa.binary()),
                pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(starts), cells),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest", "n_bytes", "anchors"])

    return docs.mapInArrow(run, f"doc_id long, digest binary, n_bytes long, anchors {ANCHORS}")


def cut_segments(candidates: DataFrame, length: int) -> DataFrame:
    """``SEGMENT`` rows: of every anchor the bytes that all strings of its run cover."""
    names = [f.split()[0] for f in SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_text(batch.column(3))
            lists = batch.column(4)
            cells = lists.flatten()
            rows = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            pos, low, high = (cells.field(n).to_numpy() for n in ("pos", "low", "high"))
            begins, ends = pos - high + offsets[rows], pos - low + length + offsets[rows]
            raw = data.tobytes()
            keys = [batch.column(i).to_numpy()[rows] for i in range(3)]
            step = 1 << 13
            for at in range(0, len(rows), step):
                part = slice(at, at + step)
                segments = [raw[b:e] for b, e in zip(begins[part].tolist(), ends[part].tolist())]
                arrays = [cells.field("hash")[part], *(pa.array(k[part]) for k in keys), *(cells.field(n)[part] for n in ("pos", "low", "high", "hot"))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(segments, pa.binary())], names=names)

    return candidates.select("text_id", "owner", "lead", "text", "anchors").mapInArrow(run, SEGMENT)


def matrices(segments: list[bytes], high: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Left contexts, nearest byte first, and right contexts of the anchors, filled up with zeros."""
    sizes = np.array([len(s) for s in segments])
    flat = np.frombuffer(b"".join(segments), np.uint8)
    starts = np.cumsum(sizes) - sizes
    anchor = (starts + high)[:, None]
    right_at = anchor + np.arange(length)
    right = np.where(right_at < (starts + sizes)[:, None], flat[np.minimum(right_at, len(flat) - 1)], 0).astype(np.uint8)
    left_at = anchor - 1 - np.arange(reach)
    left = np.where(left_at >= starts[:, None], flat[np.maximum(left_at, 0)], 0).astype(np.uint8)
    return left, right


def previous_factors(table: pa.Table, length: int, gram: int, both: bool) -> np.ndarray:
    """For every row and distance the longest previous factor, up to ``length``; with ``both`` the longest one before or after it.

    Rows come in the order of text positions.  Where no factor at a distance reaches ``length``, zeros are given.
    """
    low, high = (table.column(n).to_numpy().astype(np.int64) for n in ("low", "high"))
    keys = table.column("hash").to_numpy()
    bucket = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).astype(np.int64)])
    reach = length - gram + 1
    left, right = matrices(table.column("segment").to_pylist(), high, length, reach)
    factors = np.zeros((len(keys), reach), np.int16)
    for distance, rows, common in Suffixes(bucket, left, right, low, high).distances():
        if (common >= length).any():
            common = np.minimum(common, length)
            found = longest_previous(rows, common)
            factors[rows, distance] = np.maximum(found, longest_previous(-rows, common)) if both else found
    return factors


def bucket_spans(segments: DataFrame, length: int, gram: int, keep_first: bool) -> DataFrame:
    """Covered ranges ``text_id, start, end`` from the rows of the buckets that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches, 0, TABLE_ROWS):
            factors = previous_factors(table, length, gram, not keep_first)
            row, nearest, farthest = runs_of(factors >= length)
            pos = table.column("pos").to_numpy()[row]
            ids = table.column("text_id").to_numpy()[row]
            arrays = [pa.array(ids), pa.array(pos - farthest), pa.array(pos - nearest + length)]
            yield pa.RecordBatch.from_arrays(arrays, names=["text_id", "start", "end"])

    dealt = segments.repartition(F.col("hash")).sortWithinPartitions("hash", *PLACE)
    return dealt.mapInArrow(run, "text_id long, start long, end long")


def hot_spans(segments: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """The same for hot anchors: every string by its digest, counted without being gathered."""
    strings = segments.select(
        "text_id",
        "owner",
        "lead",
        "segment",
        "pos",
        "high",
        F.explode(F.sequence("low", "high")).alias("distance"),
    ).select(
        "text_id",
        "owner",
        "lead",
        (F.col("pos") - F.col("distance")).alias("start"),
        F.unhex(F.md5(F.substring("segment", F.col("high") - F.col("distance") + 1, F.lit(length)))).alias("string"),
    )
    place = F.struct("owner", "lead", "text_id", "start")
    counts = strings.groupBy("string").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"))
    # Stored, so that the join reads two plain shuffles and a hot string's rows can be split.
    found = strings.join(stage(counts.filter("copies > 1").drop("copies"), "strings"), "string")
    if keep_first:
        found = found.filter(F.col("first") != place)
    return found.select("text_id", "start", (F.col("start") + length).alias("end"))


def cut_texts(candidates: DataFrame) -> DataFrame:
    """``text_id, spans, kept, kept_text``: merged spans and what is outside them, as bytes and as text.

    A character that is cut in two is no part of the text.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            raw = data.tobytes()
            ranges, kept = [], []
            lists = batch.column(2)
            for i in range(batch.num_rows):
                cells = lists[i].values
                begins, ends = merged(cells.field("start").to_numpy(), cells.field("end").to_numpy())
                ranges.append([{"start": b, "end": e} for b, e in zip(begins.tolist(), ends.tolist())])
                at = np.r_[0, ends] + offsets[i]
                upto = np.r_[begins, offsets[i + 1] - offsets[i]] + offsets[i]
                kept.append(b"".join(raw[b:e] for b, e in zip(at.tolist(), upto.tolist())))
            texts = [k.decode("utf-8", "ignore") for k in kept]
            arrays = [batch.column(0), pa.array(ranges, kind), pa.array(kept, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["text_id", "spans", "kept", "kept_text"])

    return candidates.mapInArrow(run, f"text_id long, spans {SPAN}, kept binary, kept_text string")


def repeated_strings(
    docs: DataFrame,
    keep_first: bool,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``doc_id, n_bytes, digest, spans, kept, kept_text`` of every row.

    ``spans`` are the maximal removed ranges of bytes and ``kept`` the bytes outside them, as text in
    ``kept_text``; both are null if nothing is removed, ``digest`` is the SHA-256 of the whole text.  With ``keep_first`` the first copy of
    a string, by ``doc_id`` and place, stays; else all its copies go.
    """
    texts = keyed_texts(docs, id_column, text_column)
    found = stage(anchor_texts(texts, length, gram), "anchors")
    # One row per distinct text, with a number of its own; the smallest id and the digest order it.
    own = F.coalesce("doc_id", F.lit(NO_ID))
    distinct = stage(
        found.groupBy("digest")
        .agg(
            F.min(own).alias("owner"),
            F.count_distinct(own).alias("copies"),
            F.first("n_bytes").alias("n_bytes"),
            F.first("anchors").alias("anchors"),
        )
        .withColumn("lead", F.xxhash64("digest"))
        .withColumn("text_id", F.monotonically_increasing_id()),
        "texts",
    )
    met = distinct.select("text_id", F.inline("anchors"))
    # Stored, so that the join below reads two plain shuffles and a hot anchor's rows can be split.
    counts = stage(met.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "counts")
    repeated = met.join(counts, "hash").select(
        "text_id", F.struct("hash", "pos", "low", "high", (F.col("rows") > hot_rows).alias("hot")).alias("anchor")
    )
    wanted = repeated.groupBy("text_id").agg(F.collect_list("anchor").alias("anchors"))
    named_wanted = distinct.select("text_id", "owner", "lead", "digest").join(wanted, "text_id")
    # A distinct text is read again from the row of its smallest id, which both sides name.
    again = texts.select(own.alias("owner"), F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    candidates = stage(again.join(named_wanted, ["owner", "digest"]).drop("digest").dropDuplicates(["text_id"]), "candidates")
    segments = cut_segments(candidates, length)
    ranges = bucket_spans(segments.filter("not hot"), length, gram, keep_first)
    if not candidates.filter(F.exists("anchors", lambda a: a["hot"])).isEmpty():
        ranges = ranges.unionByName(hot_spans(segments.filter("hot"), length, keep_first))
    lists = ranges.groupBy("text_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = cut_texts(candidates.select("text_id", "text").join(lists, "text_id").select("text_id", "text", "spans"))
    named = found.select("doc_id", "digest", "n_bytes").join(distinct.select("digest", "text_id", "owner", "copies"), "digest")
    # A copy of a whole text goes entirely: all copies, or all but the first document's.
    copy = F.col("copies") > 1 if not keep_first else own > F.col("owner")
    gone = copy & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return named.join(cut, "text_id", "left").select(
        "doc_id",
        "n_bytes",
        "digest",
        F.when(gone, whole).otherwise(F.coalesce("spans", F.array().cast(SPAN))).alias("spans"),
        F.when(gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def digest_columns(result: DataFrame) -> DataFrame:
    """Counts and the digest of the kept bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return result.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), F.lower(F.hex("digest"))).alias("kept_sha256"),
    )
