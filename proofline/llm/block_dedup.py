"""Substring dedup with fixed-block anchors: passages of ``WINDOW`` words that an earlier document has.

Documents are indexed by their non-overlapping blocks of ``BLOCK`` words; every rolling window of
``BLOCK`` words probes the index.  As ``2 * BLOCK <= WINDOW``, each passage of ``WINDOW`` words holds a whole
block of the earlier document.  A hit is extended word by word to both sides to the maximal exact
repeat, as far as a passage around the block reaches.

Before that, passages that can't repeat are left out exactly: every passage of ``WINDOW`` words chooses the gram of
``GRAM`` words of least hash in it, equal passages choose equal grams, so where a gram is in one
document only nothing is indexed or probed.

Hits of one block meet sorted by document, not in pairs: for each distance of a passage's start from its
block, members with equal words around it are one group, and its smallest indexed document decides.  A block
with more than ``HOT_ROWS`` members is not gathered: its passages are compared by MD5 in an aggregation
that combines on the map side.  Documents with equal words are one text from the start.

Words are ``[^\\x20\\x09-\\x0D]+`` and are compared by a 64-bit hash.  Null and empty texts have no words.  Distinct texts are
named by the digest of their words.  Rows that repeat a ``doc_id`` and its text are one document and are each returned;
different texts under one id are documents neither of which is the earlier one.  A null id comes after all others.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm.arrays import PIECE, Powers, Words, anchors, flat_text, gram_hashes, joined_words, pieces, prefix_hash, spans
from proofline.llm.contexts import columns, merged, runs_of, whole_buckets
from proofline.llm.staging import keyed_texts, stage

WINDOW = 50
BLOCK = 25
GRAM = 16
HOT_ROWS = 20_000
TABLE_ROWS = 8192

ANCHORS = "array<struct<hash:long,pos:long,low:int,high:int>>"
SPAN = "array<struct<start:long,end:long>>"
AROUND = "hash long, text_id long, owner long, positions array<long>, low int, high int, indexed boolean, segment binary"
MEMBER = "hash long, text_id long, owner long, pos long, low int, high int, indexed boolean"
# What stands for a null id in the order of documents.
NO_ID = (1 << 63) - 1


def _texts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of whole texts: first row, bytes and row offsets."""
    longest = int(np.diff(offsets).max(initial=0))
    for bounds, first, _ in pieces(offsets, max(PIECE, longest), 0):
        yield first, data[bounds[0] : bounds[-1]], bounds - bounds[0]


def anchor_words(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``doc_id, digest, n_words, anchors, raw`` of every row; the digest is of the words with one space between."""
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("pos", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            digests, counts = [], []
            found: list[tuple[np.ndarray, ...]] = []
            for first, data, offsets in _texts(*flat_text(batch.column(1))):
                words = Words(data, offsets)
                values = words.hashes(data, powers)
                plain, starts = joined_words(data, words)
                view = memoryview(plain)
                digests += [hashlib.sha256(view[b:e]).digest() for b, e in zip(starts[:-1], starts[1:])]
                counts.append(np.diff(words.rows))
                for bounds, row0, base in pieces(words.rows, PIECE, window - 1):
                    row, pos, code, low, high = anchors(values[bounds[0] : bounds[-1]], bounds, gram, window, powers)
                    found.append((row + row0 + first, pos - (bounds[row] - bounds[0]) + base, code, low, high))
            row, pos, code, low, high = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 5
            starts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            cells = pa.StructArray.from_arrays(
                [pa.array(code.astype(np.uint64).view(np.int64)), pa.array(pos), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))],
                fields=list(kind.value_type),
            )
            arrays = [
                batch.column(0),
                pa.array(digests, pa.binary()),
                pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64)),
                pa.ListArray.from_arrays(pa.array(starts), cells),
                batch.column(2),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest", "n_words", "anchors", "raw"])

    return docs.mapInArrow(run, f"doc_id long, digest binary, n_words long, anchors {ANCHORS}, raw binary")


def _covered(begins: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Places in at least one of the ranges ``[begin, end)``."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, np.minimum(begins, size), 1)
    np.add.at(edges, np.minimum(ends, size), -1)
    return np.flatnonzero(np.cumsum(edges)[:-1])


def blocks(candidates: DataFrame, window: int, block: int) -> DataFrame:
    """``MEMBER`` rows: the blocks to index, and the rolling windows that probe them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            data, offsets = flat_text(batch.column(2))
            ids, owners, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                words = Words(own, np.array([0, len(own)]))
                hashes = gram_hashes(prefix_hash(words.hashes(own, powers), powers), block, powers)
                size = len(words.begins)
                cells = lists[i].values
                pos, low, high = (cells.field(n).to_numpy() for n in ("pos", "low", "high"))
                for flag, indexed in (("earlier", True), ("later", False)):
                    # Passages that may repeat start here.
                    chosen = cells.field(flag).to_numpy(zero_copy_only=False)
                    starts = _covered((pos - high)[chosen], (pos - low)[chosen] + 1, size)
                    if indexed:
                        places = np.unique(-(-starts // block) * block)
                    else:
                        places = _covered(starts, starts + block, size)
                    places = places[places < len(hashes)]
                    arrays = [
                        pa.array(hashes[places].view(np.int64)),
                        pa.array(np.full(len(places), ids[i])),
                        pa.array(np.full(len(places), owners[i])),
                        pa.array(places),
                        pa.array(np.maximum(0, places + window - size).astype(np.int32)),
                        pa.array(np.minimum(block - 1, places).astype(np.int32)),
                        pa.array(np.full(len(places), indexed)),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in MEMBER.split(", ")])

    return candidates.select("text_id", "owner", "text", "anchors").mapInArrow(run, MEMBER).filter("low <= high")


def contexts(candidates: DataFrame, window: int) -> DataFrame:
    """Members with ``segment``, the hashes of all words that passages around their block reach.

    A text that repeats a few words over and over has the same block with the same surroundings at very
    many places; these are one row with all their ``positions``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            data, offsets = flat_text(batch.column(2))
            ids, owners, lists = batch.column(0), batch.column(1), batch.column(3)
            for i in range(batch.num_rows):
                own = data[offsets[i] : offsets[i + 1]]
                raw = Words(own, np.array([0, len(own)])).hashes(own, powers).tobytes()
                cells = lists[i].values
                pos, low, high = (cells.field(n).to_numpy() for n in ("pos", "low", "high"))
                keys = zip(cells.field("hash").to_pylist(), low.tolist(), high.tolist(), cells.field("indexed").to_pylist())
                places: dict[tuple, list[int]] = {}
                for key, at in zip(keys, pos.tolist()):
                    segment = raw[8 * (at - key[2]) : 8 * (at - key[1] + window)]
                    places.setdefault((*key, segment), []).append(at)
                hashes, lows, highs, indexed, segments = zip(*places)
                arrays = [
                    pa.array(hashes, pa.int64()),
                    pa.array([ids[i].as_py()] * len(places), pa.int64()),
                    pa.array([owners[i].as_py()] * len(places), pa.int64()),
                    pa.array(list(places.values()), pa.list_(pa.int64())),
                    pa.array(lows, pa.int32()),
                    pa.array(highs, pa.int32()),
                    pa.array(indexed),
                    pa.array(segments, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in AROUND.split(", ")])

    return candidates.select("text_id", "owner", "text", "members").mapInArrow(run, AROUND)


def extended(table: pa.Table, window: int, block: int) -> np.ndarray:
    """For every member and distance: is its passage in a smaller indexed document."""
    low, high = (table.column(n).to_numpy().astype(np.int64) for n in ("low", "high"))
    keys, ids = table.column("hash").to_numpy(), table.column("owner").to_numpy()
    indexed = table.column("indexed").to_numpy()
    bucket = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).astype(np.int64)])
    segments = [np.frombuffer(s, np.uint64) for s in table.column("segment").to_pylist()]
    left = np.zeros((len(keys), block), np.uint64)
    right = np.zeros((len(keys), window), np.uint64)
    for i, (words, reach) in enumerate(zip(segments, high.tolist())):
        left[i, :reach] = words[:reach][::-1]
        right[i, : len(words) - reach] = words[reach:]
    result = np.zeros((len(keys), block), bool)
    far = np.iinfo(np.int64).max
    for distance, rows, first in columns(bucket, left, right, low, high, window):
        owners = np.where(indexed[rows], ids[rows], far)
        smallest = np.repeat(np.minimum.reduceat(owners, first), np.diff(np.r_[first, len(rows)]))
        result[rows, distance] = (smallest < ids[rows]) & ~indexed[rows]
    return result


def bucket_spans(members: DataFrame, window: int, block: int) -> DataFrame:
    """Covered ranges of words ``text_id, start, end`` from the blocks that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_buckets(batches, 0, TABLE_ROWS):
            row, nearest, farthest = runs_of(extended(table, window, block))
            ids = table.column("text_id").to_numpy()[row]
            positions = table.column("positions").combine_chunks()
            counts = positions.value_lengths().to_numpy()
            first = (np.cumsum(counts) - counts)[row]
            at = positions.flatten().to_numpy()[spans(first, counts[row])]
            begins, ends = at - np.repeat(farthest, counts[row]), at - np.repeat(nearest, counts[row]) + window
            ids = np.repeat(ids, counts[row])
            # Ranges of a text that overlap are one; the places of a repeated block come in order.
            opens = np.ones(len(ids), bool)
            opens[1:] = (ids[1:] != ids[:-1]) | (begins[1:] < begins[:-1]) | (begins[1:] > ends[:-1])
            starts = np.flatnonzero(opens)
            ends = np.maximum.reduceat(ends, starts) if len(starts) else ends
            yield pa.RecordBatch.from_arrays([pa.array(ids[starts]), pa.array(begins[starts]), pa.array(ends)], names=["text_id", "start", "end"])

    dealt = members.repartition(F.col("hash")).sortWithinPartitions("hash", "text_id")
    return dealt.mapInArrow(run, "text_id long, start long, end long")


def hot_spans(members: DataFrame, window: int) -> DataFrame:
    """The same for hot blocks: every passage by its digest, never gathered."""
    at = F.col("high") - F.col("distance")
    passages = members.select("*", F.explode(F.sequence("low", "high")).alias("distance")).select(
        "text_id",
        "owner",
        "indexed",
        "positions",
        "distance",
        F.unhex(F.md5(F.substring("segment", at * 8 + 1, F.lit(window * 8)))).alias("passage"),
    )
    # Stored, so that the join reads two plain shuffles and a hot passage's rows can be split.
    first = stage(passages.filter("indexed").groupBy("passage").agg(F.min("owner").alias("first")), "passages")
    found = passages.filter("not indexed").join(first, "passage").filter("first < owner")
    starts = found.select("text_id", "distance", F.explode("positions").alias("pos"))
    return starts.select("text_id", (F.col("pos") - F.col("distance")).alias("start"), (F.col("pos") - F.col("distance") + window).alias("end"))


def cut_words(candidates: DataFrame) -> DataFrame:
    """``text_id, spans, kept_text``: merged spans and the words outside them."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            lists = batch.column(2)
            ranges, kept = [], []
            for i in range(batch.num_rows):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                cells = lists[i].values
                begins, ends = merged(cells.field("start").to_numpy(), cells.field("end").to_numpy())
                begins, ends = begins.tolist(), ends.tolist()
                ranges.append([{"start": b, "end": e} for b, e in zip(begins, ends)])
                left = [w for b, e in zip([0, *ends], [*begins, len(words)]) for w in words[b:e]]
                kept.append(b" ".join(left).decode())
            arrays = [batch.column(0), pa.array(ranges, kind), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["text_id", "spans", "kept_text"])

    return candidates.mapInArrow(run, f"text_id long, spans {SPAN}, kept_text string")


def repeated_passages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
    gram: int = GRAM,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``doc_id, n_words, digest, spans, kept_text`` of every row.

    ``spans`` are the maximal removed ranges of words, ``kept_text`` the others joined by one space (null if
    nothing is removed), ``digest`` the SHA-256 of all words joined by one space.
    """
    if 2 * block > window:
        raise ValueError("a passage must hold a whole block wherever it starts")
    texts = keyed_texts(docs, id_column, text_column).withColumn("raw", F.unhex(F.sha2("text", 256)))
    found = stage(anchor_words(texts, window, gram), "anchors")
    # One row per distinct text, with a number of its own; its smallest id decides what is earlier.
    own = F.coalesce("doc_id", F.lit(NO_ID))
    distinct = stage(
        found.groupBy("digest")
        .agg(F.min(F.struct(own.alias("owner"), "raw")).alias("least"), F.first("n_words").alias("n_words"), F.first("anchors").alias("anchors"))
        .select("digest", "least.owner", "least.raw", "n_words", "anchors", F.monotonically_increasing_id().alias("text_id")),
        "texts",
    )
    met = distinct.select("text_id", "owner", F.inline("anchors"))
    # Stored, so that the join below reads two plain shuffles and a hot gram's rows can be split.
    spread = stage(
        met.groupBy("hash").agg(F.min("owner").alias("least"), F.max("owner").alias("most")).filter("least < most"), "grams"
    )
    marked = met.join(spread, "hash").select(
        "text_id",
        F.struct(
            "pos", "low", "high", (F.col("owner") < F.col("most")).alias("earlier"), (F.col("owner") > F.col("least")).alias("later")
        ).alias("anchor"),
    )
    wanted = marked.groupBy("text_id").agg(F.collect_list("anchor").alias("anchors"))
    named_wanted = distinct.select("text_id", "owner", "raw").join(wanted, "text_id")
    # A distinct text is read again from the row of its smallest id, which both sides name.
    again = texts.select(own.alias("owner"), "raw", "text")
    candidates = stage(again.join(named_wanted, ["owner", "raw"]).drop("raw").dropDuplicates(["text_id"]), "candidates")
    rows = stage(blocks(candidates, window, block), "blocks")
    index = rows.filter("indexed")
    first = stage(index.groupBy("hash").agg(F.min("owner").alias("first")), "index")
    hits = stage(rows.filter("not indexed").join(first, "hash").filter("first < owner").drop("first"), "hits")
    last = stage(hits.groupBy("hash").agg(F.max("owner").alias("last")), "last")
    members = hits.unionByName(index.join(last, "hash").filter("owner < last").drop("last"))
    listed = F.sort_array(F.collect_list(F.struct("pos", "hash", "low", "high", "indexed")))
    lists = members.groupBy("text_id").agg(listed.alias("members"))
    around = stage(contexts(candidates.drop("anchors").join(lists, "text_id"), window), "around")
    sizes = stage(around.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > hot_rows), "hot")
    if sizes.isEmpty():
        ranges = bucket_spans(around, window, block)
    else:
        ranges = bucket_spans(around.join(sizes, "hash", "left_anti"), window, block).unionByName(
            hot_spans(around.join(sizes, "hash", "left_semi"), window)
        )
    covered = ranges.groupBy("text_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = cut_words(candidates.select("text_id", "text").join(covered, "text_id").select("text_id", "text", "spans"))
    named = found.select("doc_id", "digest", "n_words").join(distinct.select("digest", "text_id", "owner"), "digest")
    # A later copy of a whole text has every passage in the first one.
    gone = (own > F.col("owner")) & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return named.join(cut, "text_id", "left").select(
        "doc_id",
        "n_words",
        "digest",
        F.when(gone, whole).otherwise(F.coalesce("spans", F.array().cast(SPAN))).alias("spans"),
        F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def digest_columns(result: DataFrame) -> DataFrame:
    """Counts and the digest of the kept words."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return result.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.coalesce(F.sha2("kept_text", 256), F.lower(F.hex("digest"))).alias("kept_sha256")
    )
