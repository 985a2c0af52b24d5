"""Periodic runs of words by longest common extensions over a difference cover, and texts without their repetitions.

A run is a stretch of consecutive words with smallest period ``q``, at least ``max(LEAST_LENGTH, LEAST_EXPONENT * q)`` long, that no
neighbouring word extends keeping that period.

A run of period ``p`` holds a point ``i`` of a grid with ``i`` and ``i + p`` in it and at least ``p`` equal words from both on; the grid's
step is the least length of a run without two periods, so at least ``p``.  Over all periods the points are a harmonic sum, about
``n log n`` for ``n`` words.  A point's longest common extension (LCE) to the right gives the end of the stretch; of the
points with one end the first is kept, and its stretch begins less than a step before it, found by halving with more LCEs.
A period that is a multiple of a smaller one has the same stretch, so of equal stretches the least period counts.

Two positions reach, after the same few words, positions that are both in the cover ``COVER`` modulo ``MODULUS``.  An LCE compares
these words, and most pairs differ in the first.  For the others the suffixes at cover positions are sorted: by their first
``MODULUS`` words, then by doubling, which steps from cover position to cover position.  A sparse table over the common
prefixes of neighbours in that order answers an LCE by one range minimum.  Only texts with such a pair are sorted.

Spark deals the texts; a task works on pieces of about ``PIECE`` bytes and on single longer texts, the points in chunks of ``POINTS``.
Words are ``[^\\x20\\x09-\\x0D]+`` and are compared as they are, by their codes in a dictionary of the piece.

Null and empty texts have no words and no runs.  Of runs with the same exponent the first counts, then the one of the
smaller period.  A null id stays null.  Repeated rows are each returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofline.functions.binding import let
from proofline.llm.arrays import Words, flat_text, pieces, spans, string_array
from proofline.llm.staging import keyed_texts

LEAST_LENGTH = 24
LEAST_EXPONENT = 3
PIECE = 1 << 22
POINTS = 1 << 19

# A perfect difference cover, every remainder is a difference of two of these.
MODULUS = 13
COVER = np.array([0, 1, 3, 9])

RUN = "array<struct<start:long,length:long,period:long>>"
FOUND = f"doc_id long, n_runs long, runs {RUN}, best struct<start:long,length:long,period:long>, runs_sha256 string, collapsed_text string"


def _shifts() -> np.ndarray:
    """Least number of words after which positions of two remainders are both in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    step = np.arange(MODULUS)
    both = inside[(step[:, None, None] + step) % MODULUS] & inside[(step[:, None] + step) % MODULUS]
    return both.argmax(axis=2)


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions of pairs of positions in one row of codes, by its cover-sampled suffixes.

    ``longest`` is the length up to which answers are wanted; answers may be more.
    """

    def __init__(self, codes: np.ndarray, longest: int) -> None:
        self.size = len(codes)
        self.codes = np.r_[codes, np.full(2 * MODULUS, -1, codes.dtype)]
        blocks = -(-self.size // MODULUS) + 1
        self.width = len(COVER)
        positions = (np.arange(blocks)[:, None] * MODULUS + COVER).ravel()
        self.samples = positions[positions < self.size]
        self.place = np.full(MODULUS, -1)
        self.place[COVER] = np.arange(self.width)
        self._sort(longest)
        self._common()

    def _sort(self, longest: int) -> None:
        """Ranks of the samples by their first ``MODULUS``, then twice as many words, and so on."""
        count = len(self.samples)
        words = (self.codes[self.samples[:, None] + np.arange(MODULUS)] + 1).astype(">u4")
        keys = np.ascontiguousarray(words).view(f"S{4 * MODULUS}")[:, 0] if count else np.zeros(0, "S1")
        ranks = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        self.levels = [ranks]
        step = self.width
        while MODULUS * step // self.width < longest and count and ranks.max() + 1 < count:
            after = np.full(count, -1)
            after[: max(0, count - step)] = ranks[step:]
            ranks = np.unique(ranks * (count + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
            self.levels.append(ranks)
            step *= 2
        self.order = np.argsort(ranks, kind="stable")
        self.rank = np.empty(count, np.int64)
        self.rank[self.order] = np.arange(count)

    def _common(self) -> None:
        """Common prefixes of neighbours in suffix order, and least ones of 2, 4, 8, ... of them."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        count = len(self.samples)
        common = np.zeros(len(a), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            ranks, step = self.levels[level], self.width << level
            inside = (a < count) & (b < count)
            same = inside.copy()
            same[inside] = ranks[a[inside]] == ranks[b[inside]]
            common[same] += MODULUS << level
            a[same] += step
            b[same] += step
        self.levels.clear()
        # What is left differs within the next words, or is all that is wanted.
        first, second = self.samples[self.order[:-1]] + common, self.samples[self.order[1:]] + common
        common += self._compare(first, second, np.full(len(common), MODULUS))
        self.table = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _compare(self, first: np.ndarray, second: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words are equal from both positions on, up to ``most``."""
        equal = np.zeros(len(first), np.int64)
        going = np.flatnonzero(most > 0)
        step = 0
        while len(going):
            x, y = np.minimum(first[going] + step, self.size), np.minimum(second[going] + step, self.size)
            going = going[(self.codes[x] == self.codes[y]) & (x < self.size) & (y < self.size)]
            step += 1
            equal[going] = step
            going = going[most[going] > step]
        return equal

    def query(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Equal words from ``first`` and ``second`` (greater) on."""
        shift = SHIFTS[first % MODULUS, second % MODULUS]
        equal = self._compare(first, second, shift)
        deep = np.flatnonzero((equal == shift) & (second + shift < self.size))
        if len(deep):
            a, b = (self._ranked(p[deep] + shift[deep]) for p in (first, second))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp(high - low)[1] - 1
            least = np.zeros(len(deep), np.int64)
            for k in np.unique(level).tolist():
                at = np.flatnonzero(level == k)
                row = self.table[k]
                least[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
            equal[deep] += least
        return equal

    def _ranked(self, positions: np.ndarray) -> np.ndarray:
        return self.rank[positions // MODULUS * self.width + self.place[positions % MODULUS]]


def grid(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Points, their periods and the text of each, for texts whose words begin at ``bounds``; all points of a text's period together."""
    sizes = np.diff(bounds)
    most = np.where(sizes >= LEAST_LENGTH, sizes // LEAST_EXPONENT, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = spans(np.zeros(len(most), np.int64), most) + 1
    step = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period) - 2 * period
    points = (sizes[text] - 2 * period) // step + 1
    ends = np.cumsum(points)
    at = 0
    while at < len(points):
        base = ends[at] - points[at]
        upto = max(at + 1, int(np.searchsorted(ends, base + POINTS, "right")))
        some = slice(at, upto)
        number = spans(np.zeros(upto - at, np.int64), points[some])
        of = np.repeat(np.arange(at, upto), points[some])
        yield bounds[:-1][text[of]] + number * step[of], period[of], text[of]
        at = upto


def alike(codes: np.ndarray, first: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The points whose words before the first common cover position are equal."""
    left = np.flatnonzero(codes[first] == codes[first + period])
    step = 1
    while len(left):
        x = first[left]
        most = np.minimum(SHIFTS[x % MODULUS, (x + period[left]) % MODULUS], period[left])
        open_ = most > step
        if not open_.any():
            break
        at = left[open_]
        same = codes[first[at] + step] == codes[first[at] + period[at] + step]
        keep = np.ones(len(left), bool)
        keep[np.flatnonzero(open_)[~same]] = False
        left = left[keep]
        step += 1
    return left


def runs_of_texts(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start in it, length and period of all runs, ordered by text, start and period."""
    none = np.zeros(0, np.int64)
    has = np.zeros(len(bounds) - 1, bool)
    for first, period, text in grid(bounds):
        has[text[alike(codes, first, period)]] = True
    has = np.flatnonzero(has)
    if not len(has):
        return none, none, none, none
    # Only the texts that have a pair of alike points are sorted, one after another without the others.
    sizes = np.diff(bounds)[has]
    begins = np.r_[0, np.cumsum(sizes)]
    codes = codes[spans(bounds[:-1][has], sizes)]
    extensions = Extensions(codes, int(sizes.max()))
    found = [(none, none, none, none)]
    for first, period, text in grid(begins):
        left = alike(codes, first, period)
        first, period, text = first[left], period[left], text[left]
        reach = np.minimum(extensions.query(first, first + period), begins[1:][text] - first - period)
        hit = np.flatnonzero(reach >= period)
        text, period, first, end = text[hit], period[hit], first[hit], (first + period + reach)[hit]
        # A period's points come in order: of one end the first is the one less than a step after the stretch's start.
        new = np.ones(len(hit), bool)
        new[1:] = (text[1:] != text[:-1]) | (period[1:] != period[:-1]) | (end[1:] != end[:-1])
        found.append((text[new], period[new], first[new], end[new]))
    text, period, first, end = (np.concatenate(c) for c in zip(*found))
    if not len(text):
        return none, none, none, none
    opening = begins[:-1][text]
    step = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period) - 2 * period
    low, high = np.maximum(first - step, opening - 1), first.copy()
    while True:
        # The start is above low and at most high.
        open_ = np.flatnonzero(high - low > 1)
        if not len(open_):
            break
        middle = (low[open_] + high[open_]) // 2
        joined = extensions.query(middle, middle + period[open_]) >= first[open_] - middle
        high[open_] = np.where(joined, middle, high[open_])
        low[open_] = np.where(joined, low[open_], middle)
    start, length, text = high - opening, end - high, has[text]
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    least = np.r_[True, (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])]
    least &= length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    text, start, length, period = text[least], start[least], length[least], period[least]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _piece(data: np.ndarray, offsets: np.ndarray, doc_ids: pa.Array) -> pa.RecordBatch:
    words = Words(data, offsets)
    lengths = words.ends - words.begins
    rows = words.rows
    solid = string_array(data[spans(words.begins, lengths)], np.r_[0, np.cumsum(lengths)], pa.binary())
    codes = solid.dictionary_encode().indices.to_numpy().astype(np.int64)
    text, start, length, period = runs_of_texts(codes, rows)
    first = np.searchsorted(text, np.arange(len(rows)))
    # Words that a run covers after its first period.
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, rows[text] + start + period, 1)
    np.add.at(edges, rows[text] + start + length, -1)
    kept = np.flatnonzero(np.cumsum(edges)[:-1] == 0)
    sizes = lengths[kept] + 1
    out = np.full(int(sizes.sum()), 32, np.uint8)
    ends = np.cumsum(sizes)
    out[spans(ends - sizes, sizes - 1)] = data[spans(words.begins[kept], sizes - 1)]
    flat = out.tobytes()
    upto = np.r_[0, ends][np.searchsorted(kept, rows)].tolist()
    collapsed = [flat[b : e - 1].decode() if e > b else "" for b, e in zip(upto[:-1], upto[1:])]
    best, marks = [], []
    cells = list(zip(start.tolist(), length.tolist(), period.tolist()))
    for b, e in zip(first[:-1].tolist(), first[1:].tolist()):
        own = cells[b:e]
        top = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if own else None
        best.append(top and dict(zip(("start", "length", "period"), top)))
        marks.append(hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in own).encode()).hexdigest())
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(kind))
    arrays = [
        doc_ids,
        pa.array(np.diff(first), pa.int64()),
        pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), structs),
        pa.array(best, kind),
        pa.array(marks, pa.string()),
        pa.array(collapsed, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_runs", "runs", "best", "runs_sha256", "collapsed_text"])


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``FOUND``: all runs of every text, the one of greatest exponent, and the words that no run has after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            longest = int(np.diff(offsets).max(initial=0))
            for bounds, first, _ in pieces(offsets, max(PIECE, longest), 0):
                yield _piece(data[bounds[0] : bounds[-1]], bounds - bounds[0], batch.column(0).slice(first, len(bounds) - 1))

    return keyed_texts(docs, id_column, text_column).mapInArrow(run, FOUND)


def looped_tails(text: Column, doc_id: Column) -> Column:
    """A tenth of the texts, by their id, end in a loop: from word ``a`` on the next ``p`` words over and over.

    Texts of a null id stay as they are.
    """
    mark = F.crc32(doc_id.cast("string"))
    drawn = F.floor(mark / 10)

    def looped(words: Column) -> Column:
        count = F.size(words).cast("long")
        a = drawn % count
        p = 1 + F.floor((count - a) / (3 + drawn % 8))
        source = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(source, lambda i: F.get(words, i.cast("int"))), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return F.when((mark % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), let(words, looped)).otherwise(text)
