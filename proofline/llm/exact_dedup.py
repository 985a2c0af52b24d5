"""Exact dedup against a minimal perfect hash over historical digests.

History is a table of rows ``(digest, winner, size)`` with distinct SHA-256 digests.  It is cut into
shards by digest; each shard gets a minimal perfect hash (levels of bit arrays: a key settles on
the first level where no other open key shares its bit), whose slots hold the full 32-byte digest,
the winner and the number of rows.  New rows are first reduced to one row per digest, which
combines on the map side, so a text held by a third of all rows is one row when it is shuffled.
A digest is a member only if the 32 bytes in its slot are its own; the others group among
themselves.  Shards are bounded by ``SHARD_ROWS``, their number follows the table.

Null and empty texts are equal texts.  Rows that share a ``doc_id`` are one document and get the
same decision; so do rows without one, which never win over rows that have one: a text that only they
have gets a null ``keep_id`` and all of them are kept.  An empty table gives no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.llm.arrays import mixed
from proofline.llm.staging import stage

SHARD_ROWS = 8192
SLOTS_PER_KEY = 2.0

GROUPS = "shard long, digest binary, winner long, size long"
INDEX = "shard long, level_bits array<long>, bits binary, digests binary, winners binary, named binary, sizes binary"
MERGED = "digest binary, keep_id long, group_size long, historical boolean"

DIGEST_BYTES = 32


def place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each key on a level; ``words`` has the digests as four 64-bit columns."""
    seed = np.uint64((level * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
    return (mixed(words[:, 0] ^ mixed(words[:, 1] + seed)) % np.uint64(size)).astype(np.int64)


def build_hash(words: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes in bits, all bits, and the slot of every key: a bijection onto ``0 .. n - 1``."""
    sizes, levels = [], []
    slots = np.zeros(len(words), np.int64)
    left, placed = np.arange(len(words)), 0
    while len(left):
        size = max(64, int(SLOTS_PER_KEY * len(left)))
        bit = place(words[left], len(sizes), size)
        alone = np.bincount(bit, minlength=size) == 1
        settled = alone[bit]
        rank = np.cumsum(alone) - 1
        slots[left[settled]] = placed + rank[bit[settled]]
        placed += int(alone.sum())
        sizes.append(size)
        levels.append(alone)
        left = left[~settled]
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool), slots


def probe_hash(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of every key, ``-1`` where no level has its bit; a stranger may get any slot."""
    ranks = np.cumsum(bits) - 1
    slots = np.full(len(words), -1, np.int64)
    left, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not len(left):
            break
        bit = start + place(words[left], level, size)
        found = bits[bit]
        slots[left[found]] = ranks[bit[found]]
        left = left[~found]
        start += size
    return slots


def _words(digests: pa.ChunkedArray) -> np.ndarray:
    joined = b"".join(digests.to_pylist())
    return np.frombuffer(joined, np.uint64).reshape(-1, DIGEST_BYTES // 8)


def _column(table: pa.Table, name: str) -> np.ndarray:
    """Numbers of a column; null is the least of all, so that it never passes through a float."""
    return table.column(name).fill_null(np.iinfo(np.int64).min).to_numpy().astype(np.int64)


def _named(table: pa.Table) -> np.ndarray:
    return table.column("winner").is_valid().to_numpy()


def build_shard(table: pa.Table) -> pa.Table:
    """One index row from the distinct digests of a shard."""
    words = _words(table.column("digest"))
    sizes, bits, slots = build_hash(words)
    order = np.empty_like(slots)
    order[slots] = np.arange(len(slots))
    row = {
        "shard": table.column("shard")[:1],
        "level_bits": pa.array([sizes], pa.list_(pa.int64())),
        "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
        "digests": pa.array([words[order].tobytes()], pa.binary()),
        "winners": pa.array([_column(table, "winner")[order].tobytes()], pa.binary()),
        "named": pa.array([_named(table)[order].tobytes()], pa.binary()),
        "sizes": pa.array([_column(table, "size")[order].tobytes()], pa.binary()),
    }
    return pa.table(row)


def probe_shard(index: pa.Table, incoming: pa.Table) -> pa.Table:
    """Members merged into their slots, nonmembers as they are, untouched slots as they were."""
    words = _words(incoming.column("digest"))
    winners, counts = _column(incoming, "winner"), _column(incoming, "size")
    named = _named(incoming)
    member = np.zeros(len(words), bool)
    slot_words = np.zeros((0, 4), np.uint64)
    slot_winners, slot_sizes, slot_named = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    if index.num_rows:
        row = index.to_pylist()[0]
        sizes = row["level_bits"]
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(sizes)].astype(bool)
        slot_words = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4)
        slot_winners = np.frombuffer(row["winners"], np.int64).copy()
        slot_sizes = np.frombuffer(row["sizes"], np.int64).copy()
        slot_named = np.frombuffer(row["named"], bool).copy()
        slots = probe_hash(words, sizes, bits)
        hit = np.flatnonzero(slots >= 0)
        # The whole digest decides, not the slot.
        hit = hit[(slot_words[slots[hit]] == words[hit]).all(axis=1)]
        member[hit] = True
        slot_winners[slots[hit]] = np.maximum(slot_winners[slots[hit]], winners[hit])
        slot_named[slots[hit]] |= named[hit]
        slot_sizes[slots[hit]] += counts[hit]
    new = ~member
    raw = np.concatenate([slot_words, words[new]]).tobytes()
    total = len(raw) // DIGEST_BYTES
    return pa.table(
        {
            "digest": pa.array([raw[i * DIGEST_BYTES : (i + 1) * DIGEST_BYTES] for i in range(total)], pa.binary()),
            "keep_id": pa.array(np.r_[slot_winners, winners[new]], mask=~np.r_[slot_named, named[new]]),
            "group_size": np.r_[slot_sizes, counts[new]],
            "historical": pa.array(np.r_[np.ones(len(slot_words), bool), np.zeros(int(new.sum()), bool)]),
        }
    )


def digests(docs: DataFrame, is_history: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, digest, old)`` of every row; the digest is of the whole text in UTF-8."""
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)).alias("digest"),
        is_history.alias("old"),
    )
    return stage(texts, "digests")


def distinct_groups(rows: DataFrame, shards: int) -> DataFrame:
    """One row per digest: its shard, its largest ``doc_id`` and its number of rows."""
    groups = rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))
    return groups.select(F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"), "digest", "winner", "size")


def build_index(groups: DataFrame) -> DataFrame:
    """One row per shard of distinct digests: its perfect hash and its slots."""
    return groups.groupBy("shard").applyInArrow(build_shard, INDEX)


def probe_index(index: DataFrame, groups: DataFrame) -> DataFrame:
    """Look the distinct digests of new rows up in the index: the merged groups."""
    return index.groupBy("shard").cogroup(groups.groupBy("shard")).applyInArrow(probe_shard, MERGED)


def exact_groups(docs: DataFrame, is_history: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with its group of equal texts; ``is_history`` says which rows are old.

    Returns ``doc_id, keep_id, group_size, kept, digest, historical``.  The row with the largest
    ``doc_id`` stays, whether it is old or new.
    """
    rows = digests(docs, is_history, id_column, text_column)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    index = build_index(distinct_groups(rows.filter("old"), shards))
    merged = probe_index(index, distinct_groups(rows.filter("not old"), shards))
    return rows.join(merged, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.equal_null("doc_id", "keep_id").alias("kept"),
        "digest",
        "historical",
    )


def even_half(id_column: str = "doc_id") -> Column:
    """The rows taken as history when one table is all there is: half of the ids by CRC-32."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 2 == 0, F.lit(False))
