"""Numpy helpers of the operators' tasks: flat texts, words, rolling hashes, window minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked on in pieces of about this many symbols, so a task's memory does not follow the
# size of its batches or of one long text.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the row offsets into them; null is empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    rows = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + rows + 1]
    if rows == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int, overlap: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Cut rows given by ``offsets`` into pieces of about ``size`` symbols.

    Yields ``(bounds, first_row, base)``: the piece holds the rows from ``first_row`` on with these
    bounds.  A longer row comes in several pieces that overlap by ``overlap`` symbols; ``base`` is
    where the piece starts in its row.
    """
    row, rows = 0, len(offsets) - 1
    while row < rows:
        begin, end = int(offsets[row]), int(offsets[row + 1])
        if end - begin > size:
            for start in range(begin, max(begin + 1, end - overlap), size):
                yield np.array([start, min(start + size + overlap, end)]), row, start - begin
            row += 1
        else:
            last = max(int(np.searchsorted(offsets, begin + size, "right")) - 1, row + 1)
            yield offsets[row : last + 1], row, 0
            row = last


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def byte_values() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(count, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up[:count], self.down[:count]


def prefix_hash(values: np.ndarray, powers: Powers) -> np.ndarray:
    """Running polynomial hash: entry ``i`` covers the first ``i`` symbols."""
    result = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers.get(len(values) + 1)[0][:-1], out=result[1:])
    return result


def gram_hashes(prefix: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """Hash of every run of ``length`` symbols, by its first position."""
    if len(prefix) <= length:
        return np.zeros(0, np.uint64)
    grams = prefix[length:] - prefix[:-length]
    return mixed(grams * powers.get(len(prefix))[1][: len(grams)])


def ranges_hash(prefix: np.ndarray, begins: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of the symbols of each range ``[begin, end)``; equals ``gram_hashes`` for equal symbols."""
    return mixed((prefix[ends] - prefix[begins]) * powers.get(len(prefix))[1][begins])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    least, span = values, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def anchors(values: np.ndarray, bounds: np.ndarray, gram: int, window: int, powers: Powers):
    """The gram of least hash in every window of ``window`` symbols inside a row.

    Equal windows choose the same gram at the same place, so comparing rows that share an anchor
    finds every repeated window.  Returns for each anchor ``(row, position, hash, low, high)``:
    it was chosen by the windows that start ``low`` to ``high`` symbols before ``position``.
    Positions count from ``bounds[0]``.
    """
    none = np.zeros(0, np.int64)
    bounds = bounds - bounds[0]
    count = len(values)
    if count < window:
        return none, none, none.astype(np.uint64), none, none
    width = window - gram + 1
    grams = gram_hashes(prefix_hash(values, powers), gram, powers)
    least = sliding_min(grams, width)
    crossing = np.zeros(count + 1, np.int32)
    inner = bounds[1:-1]
    np.add.at(crossing, np.maximum(inner - window + 1, 0), 1)
    np.add.at(crossing, inner, -1)
    inside = np.cumsum(crossing)[: len(least)] == 0
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none.astype(np.uint64), none, none
    wanted = np.zeros(len(grams) + width - 1, np.uint64)
    wanted[width - 1 : width - 1 + len(least)] = np.where(inside, least, np.uint64(0))
    chosen = np.flatnonzero(~sliding_min(~wanted, width)[: len(grams)] == grams)
    # The first chosen position of a window's least hash; few others lie before it.
    at = np.searchsorted(chosen, starts)
    open_ = np.flatnonzero(grams[chosen[at]] != least[starts])
    while len(open_):
        at[open_] += 1
        open_ = open_[grams[chosen[at[open_]]] != least[starts[open_]]]
    # A run: windows next to each other with the same choice.
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    last = np.r_[first[1:], len(starts)] - 1
    position = chosen[at[first]]
    row = np.searchsorted(bounds, position, "right") - 1
    return row, position, grams[position], position - starts[last], position - starts[first]


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts, as ranges of its bytes."""

    __slots__ = ("begins", "ends", "rows")

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        table = np.ones(256, np.uint8)
        table[[9, 10, 11, 12, 13, 32]] = 0
        solid = table[data]
        # Words end with their text: split where a solid byte starts a text.
        edge = np.flatnonzero(np.diff(solid, prepend=0, append=0))
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = cuts[(solid[cuts] & solid[cuts - 1]).astype(bool)] if len(cuts) else cuts
        cuts = np.unique(cuts)
        self.begins = np.sort(np.r_[edge[0::2], cuts])
        self.ends = np.sort(np.r_[edge[1::2], cuts])
        # rows[i] .. rows[i + 1] are the words of text i.
        self.rows = np.searchsorted(self.begins, offsets, "left")
        self.rows[-1] = len(self.begins)

    def hashes(self, data: np.ndarray, powers: Powers) -> np.ndarray:
        """A 64-bit hash of every word."""
        result = np.zeros(len(self.begins), np.uint64)
        table = byte_values()
        done = 0
        while done < len(self.begins):
            start = int(self.begins[done])
            last = max(int(np.searchsorted(self.ends, start + PIECE, "right")), done + 1)
            prefix = prefix_hash(table[data[start : self.ends[last - 1]]], powers)
            result[done:last] = ranges_hash(
                prefix, self.begins[done:last] - start, self.ends[done:last] - start, powers
            )
            done = last
        return result


def joined_words(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words joined by one space: bytes and row offsets."""
    lengths = words.ends - words.begins
    rows = words.rows
    counts = np.diff(rows)
    # A space after each word but the last of its text.
    spaced = np.ones(len(lengths), np.int64)
    spaced[rows[1:][counts > 0] - 1] = 0
    sizes = lengths + spaced
    ends = np.cumsum(sizes)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    source = spans(words.begins, lengths)
    out[spans(ends - sizes, lengths)] = data[source]
    offsets = np.r_[0, ends][rows] if len(ends) else np.zeros(len(rows), np.int64)
    return out, offsets


def spans(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges ``[begin, begin + length)`` one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(begins - (ends - lengths), lengths)


def string_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow string or binary array over flat bytes."""
    large = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}[kind]
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(large, len(offsets) - 1, buffers).cast(kind)
