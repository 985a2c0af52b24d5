"""Comparing rows that share an anchor by what stands left and right of it, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_buckets(batches: Iterator[pa.RecordBatch], key: int, most: int) -> Iterator[pa.Table]:
    """Rows sorted by an integer column ``key``, in tables of about ``most`` rows of whole keys."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        if keys[0] != keys[-1]:
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
            yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
            rows = len(keys) - last
    if rows:
        yield pa.Table.from_batches(held)


def ordered(bucket: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the rows inside their buckets, and each row's common prefix with the row before.

    ``symbols`` has a row of unsigned symbols per suffix.  The first row of a bucket has ``-1``.
    """
    wide = np.ascontiguousarray(symbols, symbols.dtype.newbyteorder(">"))
    lead = np.ascontiguousarray(bucket, ">u4")
    raw = np.concatenate([lead.view(np.uint8).reshape(len(bucket), 4), wide.view(np.uint8).reshape(len(bucket), -1)], axis=1)
    # Rows as fixed byte strings compare byte by byte, as a suffix array needs.
    order = np.argsort(np.ascontiguousarray(raw).view(f"S{raw.shape[1]}")[:, 0], kind="stable")
    sorted_symbols, sorted_bucket = symbols[order], bucket[order]
    common = np.full(len(order), -1, np.int64)
    if len(order) > 1:
        differs = sorted_symbols[1:] != sorted_symbols[:-1]
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), symbols.shape[1])
        common[1:] = np.where(sorted_bucket[1:] == sorted_bucket[:-1], first, -1)
    return order, common


def columns(
    bucket: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, length: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Group the suffixes that start ``d`` symbols before their anchor by their first ``length`` symbols.

    ``left`` holds the symbols before the anchor, nearest first, ``right`` those from it on.  All
    suffixes at one distance are in suffix order when the rows in left order are refined by right
    order, so two sorts of the anchors order the suffixes at every distance.  For each ``d`` yields the
    rows with ``low <= d <= high``, in group order and inside a group in the order given, and
    where each group starts.
    """
    left_order, left_common = ordered(bucket, left)
    right_order, right_common = ordered(bucket, right)
    left_class = np.zeros(len(bucket), np.int64)
    right_class = np.zeros(len(bucket), np.int64)
    for distance in range(int(low.min(initial=0)), int(high.max(initial=-1)) + 1):
        active = np.flatnonzero((low <= distance) & (distance <= high))
        if len(active) < 2:
            continue
        left_class[left_order] = np.cumsum(left_common < distance)
        right_class[right_order] = np.cumsum(right_common < length - distance)
        key = left_class[active] * (len(bucket) + 1) + right_class[active]
        order = np.argsort(key, kind="stable")
        key = key[order]
        yield distance, active[order], np.flatnonzero(np.r_[True, key[1:] != key[:-1]])


class Suffixes:
    """The suffixes that start at every distance before the anchors of a table, in suffix order.

    Two sorts of the anchors are enough for all distances: suffixes at distance ``d`` that share their first ``d`` symbols are
    one class in left order, and inside a class they are in the order of what follows from the anchor on.  The
    common prefix of two of them is ``d`` and the least common prefix, in right order, between them; a sparse table gives it.
    """

    def __init__(self, bucket: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.high = low, high
        self.left_order, self.left_common = ordered(bucket, left)
        right_order, common = ordered(bucket, right)
        self.right_rank = np.empty(len(bucket), np.int64)
        self.right_rank[right_order] = np.arange(len(bucket))
        self.table = [common]
        width = 1
        while 2 * width <= len(common):
            self.table.append(np.minimum(self.table[-1][:-width], self.table[-1][width:]))
            width *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least common prefix on the way from right rank ``first`` to ``last`` (greater)."""
        level = np.frexp(last - first)[1] - 1
        result = np.zeros(len(first), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            result[at] = np.minimum(self.table[k][first[at] + 1], self.table[k][last[at] + 1 - (1 << k)])
        return result

    def distances(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each distance ``d`` the rows with ``low <= d <= high`` in suffix order, and each one's common prefix with the one
        before; less than ``d`` counts as 0."""
        left_class = np.zeros(len(self.low), np.int64)
        for distance in range(int(self.low.min(initial=0)), int(self.high.max(initial=-1)) + 1):
            active = np.flatnonzero((self.low <= distance) & (distance <= self.high))
            if len(active) < 2:
                continue
            left_class[self.left_order] = np.cumsum(self.left_common < distance)
            rows = active[np.argsort(left_class[active] * (len(self.low) + 1) + self.right_rank[active], kind="stable")]
            common = np.zeros(len(rows), np.int64)
            near = np.flatnonzero(left_class[rows[1:]] == left_class[rows[:-1]]) + 1
            rank = self.right_rank[rows]
            common[near] = distance + self.least(rank[near - 1], rank[near])
            yield distance, rows, common


def longest_previous(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with one at a smaller position: its longest previous factor.

    ``position`` is in suffix order, ``common`` has the common prefixes with the suffix before.  The longest is with the previous
    or the next smaller position in that order.
    """
    size = len(position)
    result = np.zeros(size, np.int64)
    for order in (np.arange(size), np.arange(size)[::-1]):
        values = position[order]
        # What lies between a place and its candidate is greater; ``least`` is the common prefix over it.
        candidate = np.arange(-1, size - 1)
        least = common[order].copy() if order[0] == 0 or size == 1 else np.r_[0, common[order][:-1]]
        least[0] = 0
        going = np.flatnonzero(candidate >= 0)
        going = going[values[candidate[going]] > values[going]]
        while len(going):
            at = candidate[going]
            least[going] = np.minimum(least[going], least[at])
            candidate[going] = candidate[at]
            # Without a common prefix nothing further on can have one.
            going = going[(candidate[going] >= 0) & (least[going] > 0)]
            going = going[values[candidate[going]] > values[going]]
        found = (candidate >= 0) & (values[np.maximum(candidate, 0)] < values)
        result[order] = np.maximum(result[order], np.where(found, least, 0))
    return result


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of every run of true cells."""
    edges = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    rows, first = np.nonzero(edges == 1)
    _, after = np.nonzero(edges == -1)
    return rows, first, after - 1


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal disjoint ranges; ranges that touch are one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.r_[True, begins[1:] > ends[:-1]])
    last = np.r_[first[1:], len(begins)] - 1
    return begins[first], ends[last]
