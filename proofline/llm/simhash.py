"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints that differ in at most ``2 * HALF_RADIUS`` bits have a common variant within
``HALF_RADIUS`` bits of both.  Every distinct fingerprint emits all its variants; rows meet on
variants.  All fingerprints of one variant lie within ``HALF_RADIUS`` of it, so linking each of them
to the least of them keeps every component and needs no pairs within a group; links are deduplicated
and their distance is verified.  A group has at most 65 distinct fingerprints.  Documents with equal
fingerprints are one row before anything is shuffled on variants.

A null or empty text, or one without words, has fingerprint zero and links like any other.  Repeated
rows of a ``doc_id`` are all returned.  A row with a null id belongs to its fingerprint's group, whose
``component_id`` is the least id that is not null; a group without any id has a null one.  An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm.arrays import Words, flat_text, joined_words, pieces
from proofline.llm.components import connected_components
from proofline.llm.staging import keyed_texts, stage

HALF_RADIUS = 1
SHINGLE_WORDS = 3
SEED = 42
BITS = 64

# Shingles whose bits are counted at once.
_BLOCK = 1 << 16


def _lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def shingle_hashes(text: bytes, begins: list[int], ends: list[int]) -> np.ndarray:
    """XXH64 of every range of ``text``."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[b:e], SEED) for b, e in zip(begins, ends)), np.uint64, len(begins))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), _BLOCK):
        block = hashes[start : start + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprint_of(counts: np.ndarray, total: int) -> int:
    """A bit is set if more than half of the hashes have it."""
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def piece_fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[int]:
    """Fingerprint of every text of a piece."""
    lowered = _lower_ascii(data)
    words = Words(lowered, offsets)
    text, starts = joined_words(lowered, words)
    raw = text.tobytes()
    lengths = words.ends - words.begins
    counts = np.diff(words.rows)
    result = []
    for row, count in enumerate(counts):
        if not count:
            result.append(0)
            continue
        sizes = lengths[words.rows[row] : words.rows[row + 1]]
        ends = np.cumsum(sizes + 1) - 1 + starts[row]
        begins = ends - sizes
        if count < shingle:
            begins, ends = begins[:1], ends[-1:]
        else:
            begins, ends = begins[: count - shingle + 1], ends[shingle - 1 :]
        total = np.zeros(BITS, np.int64)
        for block in range(0, len(begins), _BLOCK):
            part = slice(block, block + _BLOCK)
            total += bit_counts(shingle_hashes(raw, begins[part].tolist(), ends[part].tolist()))
        result.append(fingerprint_of(total, len(begins)))
    return result


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row; the fingerprint is a long with the 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            found: list[int] = []
            # A text is never cut here: bits are counted over all its shingles.
            for bounds, _, _ in pieces(offsets, max(1 << 20, int(np.diff(offsets).max(initial=0))), 0):
                found += piece_fingerprints(data[bounds[0] : bounds[-1]], bounds - bounds[0], shingle)
            bits = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), bits], names=["doc_id", "fingerprint"])

    return keyed_texts(docs, id_column, text_column).mapInArrow(run, "doc_id long, fingerprint long")


def variants(fingerprint) -> F.Column:
    """The fingerprint itself and it with each single bit turned."""
    masks = [0] + [1 << i for i in range(BITS - 1)] + [-(1 << (BITS - 1))]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda mask: fingerprint.bitwiseXOR(mask))


def links(distinct: DataFrame) -> DataFrame:
    """Verified links ``(a, b)`` between distinct fingerprints, enough to connect every component."""
    balls = distinct.select("fingerprint", F.explode(variants(F.col("fingerprint"))).alias("variant"))
    # A group has at most 65 members: the fingerprints one bit away from the variant, and itself.
    met = balls.groupBy("variant").agg(F.sort_array(F.collect_set("fingerprint")).alias("met")).filter("size(met) > 1")
    pairs = met.select(F.col("met")[0].alias("a"), F.explode(F.slice("met", 2, BITS + 1)).alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2 * HALF_RADIUS)


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per document with its group.

    ``component_id`` is the smallest ``doc_id`` reachable over links.
    """
    marked = stage(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    distinct = stage(distinct, "distinct")
    roots = connected_components(links(distinct))
    rooted = distinct.join(roots, F.col("node") == F.col("fingerprint"), "left")
    rooted = rooted.select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hexadecimal(fingerprint) -> F.Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
