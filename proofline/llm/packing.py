"""Order-preserving packing of token streams into windows by dynamic programming.

The documents of a partition, in the order they come, are one stream of tokens, each document ending
with ``END_ID``.  The stream may be cut at document ends, at sentence ends for ``SENTENCE_COST``, and
inside sentences of more than ``LONG_SENTENCE`` tokens for ``INNER_COST``.  A window of ``WINDOW`` tokens
or of a power of two needs no padding, any other is filled up to ``WINDOW``.  The cost of all windows up to a
cut is the least, over cuts at most a window before, of the cost there plus padding plus the cost of the cut;
as padding only falls with the earlier cut's place, a monotone queue gives that least value in constant time, and
the few power-of-two windows are looked up beside it.  Costs are counted in tokens.

The stream is optimised in blocks of ``BLOCK`` tokens: at a block's end the cheapest cut in its last
window is final, what follows it goes to the next block, so memory is bounded.  At a partition's end the rest is
one padded window or, if cheaper at ``TAIL_COST`` a piece, windows of powers of two.

Each partition is packed on its own, without a shuffle; ``sequence_id`` starts with the partition's number.  A lost
task is repeated on the same rows in the same order when ``docs`` is a stored table, as Spark splits files the same way.

Null and empty texts are a lone end token.  Repeated rows are packed again.  An empty table gives no rows.
The ids are those of the ``tokenizers`` library: white space separates words in this vocabulary,
so every distinct word of a block is encoded once.  Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from proofline.llm.arrays import Words, flat_text, pieces, spans, string_array
from proofline.llm.staging import keyed_texts

WINDOW = 4096
END_ID = 2
SENTENCE_COST = 8
INNER_COST = 64
TAIL_COST = 64
LONG_SENTENCE = 512
BLOCK = 64 * WINDOW
# Shorter windows than this are no choice before the end of a partition.
SHORTEST = 256
TEXT_PIECE = 8 << 20
KNOWN_WORDS = 1 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
)

# Words whose splitting is plain: letters without composition, then at most one run of marks.  An
# apostrophe is left out, as it may begin a short ending.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_PLAIN = re.compile(f"([A-Za-zÀ-ÖØ-öø-įı-ſ]*)([{re.escape(_MARKS)}]*)")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Token ids of words, each distinct word encoded once while it is remembered."""

    def __init__(self, vocabulary: str) -> None:
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.ids = array("I")
        self.ends = array("q", [0])

    def word(self, raw: bytes) -> list[int]:
        """Ids of a word whose ASCII letters are in lower case."""
        if raw.isalpha():
            return [t.id for t in self.model.tokenize(raw.decode())]
        text = raw.decode()
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        parts = [p.lower().encode().decode("latin-1").translate(self.letters) for p in plain.groups() if p]
        return [t.id for p in parts for t in self.model.tokenize(p)]

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.places) > KNOWN_WORDS:
            self.forget()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        places = list(map(self.places.get, distinct))
        for at, place in enumerate(places):
            if place is None:
                raw = distinct[at]
                places[at] = self.places[raw] = len(self.ends) - 1
                self.ids.extend(self.word(raw))
                self.ends.append(len(self.ids))
        ends = np.array(self.ends)
        begins, counts = ends[:-1], np.diff(ends)
        at = np.array(places)[coded.indices.to_numpy()]
        counts = counts[at]
        return np.array(self.ids)[spans(begins[at], counts)].astype(np.uint32), counts


def apart(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of the words without the marks at their ends, then those marks; and the word of each.

    A letter and a mark are never one token, and most words differ in their marks alone.
    """
    marks = np.zeros(256, bool)
    marks[list(_MARKS.encode())] = True
    solid = np.arange(len(data))
    solid[marks[data]] = -1
    bare = np.maximum.accumulate(solid)[words.ends - 1] if len(words.ends) else words.ends
    last, lead = data[np.maximum(bare, 0)], data[np.maximum(bare - 1, 0)]
    # An ASCII letter, or one of the letters of the Latin-1 block in two bytes.
    letter = ((last >= 97) & (last <= 122)) | ((lead == 0xC3) & (last >= 128) & (last != 0x97) & (last != 0xB7))
    split = np.flatnonzero((bare >= words.begins) & (bare < words.ends - 1) & letter)
    at = bare[split] + 1
    order = np.argsort(np.r_[words.begins, at], kind="stable")
    begins = np.r_[words.begins, at][order]
    ends = words.ends.copy()
    ends[split] = at
    ends = np.r_[ends, words.ends[split]][order]
    return begins, ends, np.r_[np.arange(len(words.ends)), split][order]


def encode_piece(encoder: Encoder, data: np.ndarray, offsets: np.ndarray):
    """Tokens of several texts: ids with end tokens, tokens per text, cuts and their costs.

    Cuts are given as the number of tokens before them.
    """
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    words = Words(data, offsets)
    begins, ends, word = apart(data, words)
    lengths = ends - begins
    solid = string_array(data[spans(begins, lengths)], np.r_[0, np.cumsum(lengths)], pa.binary())
    ids, counts = encoder.encode(solid)
    counts = np.bincount(word, counts, len(words.ends)).astype(np.int64)
    texts = len(offsets) - 1
    row = np.repeat(np.arange(texts), np.diff(words.rows))
    upto = np.cumsum(counts) + row  # tokens up to each word's end, with the end tokens before
    per_text = np.bincount(row, counts, texts).astype(np.int64) + 1
    ends = np.cumsum(per_text)
    stream = np.full(int(ends[-1]), END_ID, np.uint32)
    body = np.ones(len(stream), bool)
    body[ends - 1] = False
    stream[body] = ids
    # A sentence ends with a stop, or where a line ends before the next word.
    last = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    lines = np.r_[0, np.cumsum(data == 10)]
    following = np.r_[words.begins[1:], len(data)]
    closes = np.isin(last, (33, 46, 63)) | (lines[following] > lines[words.ends])
    sentence = upto[closes]
    cuts = np.unique(np.r_[ends, sentence[sentence > 0]])
    costs = np.full(len(cuts), SENTENCE_COST)
    costs[np.searchsorted(cuts, ends)] = 0
    gaps = np.diff(np.r_[0, cuts])
    long_ = np.flatnonzero(gaps > LONG_SENTENCE)
    if len(long_):
        inner = np.concatenate([np.arange(cuts[i] - gaps[i] + LONG_SENTENCE, cuts[i], LONG_SENTENCE) for i in long_])
        order = np.argsort(np.r_[cuts, inner], kind="stable")
        costs = np.r_[costs, np.full(len(inner), INNER_COST)][order]
        cuts = np.r_[cuts, inner][order]
    return stream, per_text, cuts, costs


def padding(size: int) -> int:
    return 0 if size & (size - 1) == 0 else WINDOW - size


def least_costs(cuts: np.ndarray, costs: np.ndarray) -> tuple[list[int], list[int]]:
    """Least cost of cutting at each of ``0, *cuts``, and the cut before in such a solution."""
    ends = np.r_[0, cuts]
    places, own = ends.tolist(), [0, *costs.tolist()]
    exact: dict[int, list[int]] = {}
    size = WINDOW // 2
    while size >= SHORTEST:
        at = np.minimum(np.searchsorted(ends, ends - size), len(ends) - 1)
        hits = np.flatnonzero(ends[at] == ends - size)
        for j, i in zip(hits.tolist(), at[hits].tolist()):
            exact.setdefault(j, []).append(i)
        size //= 2
    total, before, ranks = [0] * len(places), [0] * len(places), [0] * len(places)
    # Of the cuts that can begin the window, those with the least cost of them and all after them.
    queue = deque([0])
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[0]] < place - WINDOW:
            queue.popleft()
        best = queue[0]
        cost = ranks[best] + WINDOW - place
        if j in exact:
            for i in exact[j]:
                if total[i] < cost:
                    best, cost = i, total[i]
        total[j] = cost = cost + own[j]
        before[j] = best
        ranks[j] = rank = cost + place
        while queue and ranks[queue[-1]] >= rank:
            queue.pop()
        queue.append(j)
    return total, before


def walk_back(before: list[int], last: int) -> list[int]:
    """Indices of the chosen cuts up to ``last``, in order, without the start."""
    chosen = []
    while last:
        chosen.append(last)
        last = before[last]
    return chosen[::-1]


def powers_of_two(size: int) -> list[int]:
    return [1 << bit for bit in range(size.bit_length() - 1, -1, -1) if size >> bit & 1]


class Packer:
    """Packs one stream; holds at most a block and the last document."""

    def __init__(self, first_sequence: int) -> None:
        self.sequence = first_sequence
        self.ids = np.zeros(0, np.uint32)
        self.cuts = np.zeros(0, np.int64)
        self.costs = np.zeros(0, np.int64)
        # Documents with tokens in the stream: id, tokens, and where they start (negative: cut before).
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_ids: list, ids: np.ndarray, per_text: np.ndarray, cuts: np.ndarray, costs: np.ndarray) -> None:
        base = len(self.ids)
        starts = base + np.cumsum(per_text) - per_text
        self.docs += zip(doc_ids, per_text.tolist(), starts.tolist())
        self.ids = np.r_[self.ids, ids]
        self.cuts = np.r_[self.cuts, cuts + base]
        self.costs = np.r_[self.costs, costs]

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """Settle full blocks."""
        while len(self.ids) >= BLOCK:
            upto = int(np.searchsorted(self.cuts, BLOCK, "right"))
            total, before = least_costs(self.cuts[:upto], self.costs[:upto])
            end = int(self.cuts[upto - 1])
            ending = range(int(np.searchsorted(self.cuts, end - WINDOW, "right")) + 1, upto + 1)
            last = min(ending, key=lambda j: (total[j], -j))
            yield self.settle([int(self.cuts[j - 1]) for j in walk_back(before, last)])

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Settle what is left."""
        yield from self.blocks()
        size = len(self.ids)
        if not size:
            return
        total, before = least_costs(self.cuts, self.costs)
        places = [0, *self.cuts.tolist()]
        best, tail, cost = len(total) - 1, [], total[-1]
        for j in range(len(places) - 2, -1, -1):
            rest = size - places[j]
            if rest > WINDOW:
                break
            split = powers_of_two(rest)
            if total[j] + TAIL_COST * len(split) < cost:
                best, tail, cost = j, split, total[j] + TAIL_COST * len(split)
        ends = [places[j] for j in walk_back(before, best)]
        start = places[best]
        for part in tail:
            start += part
            ends.append(start)
        yield self.settle(ends)

    def settle(self, ends: list[int]) -> pa.RecordBatch:
        """Emit the windows that end at ``ends`` and go on after the last of them."""
        size = ends[-1]
        starts = np.array([d[2] for d in self.docs])
        edges = np.unique(np.r_[0, ends, starts[(starts > 0) & (starts < size)]])
        begin, end = edges[:-1], edges[1:]
        doc = np.searchsorted(starts, begin, "right") - 1
        window = np.searchsorted(ends, begin, "right")
        opens = np.array([0, *ends[:-1]], np.int64)
        raw = memoryview(self.ids[:size].astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begin.tolist(), end.tolist())]
        arrays = [
            pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            pa.array(begin - starts[doc], pa.int64()),
            pa.array(end - begin, pa.int64()),
            pa.array(crc, pa.int64()),
            pa.array([self.docs[i][1] for i in doc.tolist()], pa.int64()),
            pa.array(self.sequence + window, pa.int64()),
            pa.array(begin - opens[window], pa.int64()),
            pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(self.ids[:size].astype(np.int32))),
        ]
        self.sequence += len(ends)
        self.ids = self.ids[size:]
        later = int(np.searchsorted(self.cuts, size, "right"))
        self.cuts, self.costs = self.cuts[later:] - size, self.costs[later:]
        self.docs = [(i, n, s - size) for i, n, s in self.docs if s + n > size]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in PIECES.split(", ")])


def pack(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of the packed windows: ``PIECES``, without ``ids`` unless they are wanted.

    The vocabulary file is read here and sent to the tasks, so only the driver needs it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text("utf-8"))
    fields = PIECES if with_ids else PIECES.removesuffix(", ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        packer = Packer(TaskContext.get().partitionId() << 32)
        wanted = [f.split()[0] for f in fields.split(", ")]
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            names = batch.column(0).to_pylist()
            longest = int(np.diff(offsets).max(initial=0))
            for bounds, first, _ in pieces(offsets, max(TEXT_PIECE, longest), 0):
                found = encode_piece(encoder, data[bounds[0] : bounds[-1]], bounds - bounds[0])
                packer.add(names[first : first + len(bounds) - 1], *found)
                for settled in packer.blocks():
                    yield settled.select(wanted)
        for settled in packer.finish():
            yield settled.select(wanted)

    return keyed_texts(docs, id_column, text_column).mapInArrow(run, fields)
