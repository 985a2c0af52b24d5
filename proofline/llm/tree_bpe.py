"""BPE encoding of long unsplit text by concatenating encoded halves, and decoding.

A text becomes a string of symbols first: its bytes after normalisation, where the last byte of every word is a symbol of its
own kind.  No merge reaches over a word's last byte, so the merges of the whole unsplit string are those of its words, and a
text may be cut anywhere.  It is halved down to leaves of ``LEAF`` symbols; the leaves are encoded on their own, all leaves
of a batch one after another, and neighbours are joined level by level.

At a join the last and first ``EDGE`` tokens of both sides are encoded again as one window.  If the window begins with the token
that stands there on the left, and ends with the one on the right, it replaces the tokens between; else it grows to twice
as many tokens, up to a whole side.  This is exact.  Merges go by rank, of equal ranks the leftmost first, and the merges
inside a range that ends at token boundaries do not depend on what is outside it.  So neighbouring tokens of an encoding
are, encoded as a pair, the same two tokens; and a row of tokens of which every two neighbours are
so is the encoding of its string, because the first merge over one of its boundaries would be one in the pair around it.

Spark deals the texts; a task works on pieces of about ``PIECE`` bytes and on single longer texts.  The file says how words are
found; normalizers, splits and added tokens other than those of its kind raise ``ValueError``.  Strings of its special tokens
are these tokens, as in the library's ``encode``.  Decoded text is what ``decode`` gives for the ids: their tokens joined by a space.

Null and empty texts have no ids.  A null id stays null.  Repeated rows are each returned; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from proofline.llm.arrays import Words, flat_text, pieces, spans
from proofline.llm.packing import byte_letters
from proofline.llm.staging import keyed_texts

LEAF = 512
EDGE = 2
PIECE = 1 << 20
# Words that need the library's own splitting are remembered up to this many.
KNOWN_WORDS = 1 << 16
# Symbols are written as characters of the private use area.
BASE = 0xE000
FINAL = 256
# Bytes that occur in no UTF-8 text stand for special tokens.
MARKERS = range(0xF8, 0x100)

# Normalization and splitting of the kind of file that is understood.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]
WORD_END = "</w>"

ENCODED = "doc_id long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)


def _kinds() -> np.ndarray:
    """Kind of every byte of a text in lower case; beyond ASCII the first byte of two decides later."""
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    kinds[33:127] = _MARK
    kinds[97:123] = _LETTER
    kinds[48:58] = _DIGIT
    return kinds


class Coder:
    """Symbols of texts, ids of symbols, tokens of ids."""

    def __init__(self, vocabulary: str) -> None:
        stored = json.loads(vocabulary)
        model, added = stored["model"], stored["added_tokens"]
        splits = stored["pre_tokenizer"]["pretokenizers"]
        known = stored["normalizer"]["normalizers"] == NORMALIZERS and splits[0]["pattern"] == {"Regex": SPLIT} and splits[0]["invert"]
        known = known and not splits[1]["add_prefix_space"] and model["end_of_word_suffix"] == WORD_END and not model["ignore_merges"]
        simple = not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added) and len(added) <= len(MARKERS)
        if not known or not simple or stored["decoder"] or len(splits) != 2 or model["type"] != "BPE" or model["dropout"]:
            raise ValueError("the vocabulary file normalizes, splits or decodes in another way")
        self.library = Tokenizer.from_str(vocabulary)
        self.byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.special = {t["content"].encode(): (marker, t["id"]) for marker, t in zip(MARKERS, added)}
        size = max([*model["vocab"].values(), *(t["id"] for t in added)]) + 1
        self.lengths = np.zeros(size, np.int64)
        owned = {}
        tokens = [b""] * size
        for token, i in model["vocab"].items():
            owned[self.spelled(token)] = i
            self.lengths[i] = len(token.removesuffix(WORD_END))
            tokens[i] = token.encode()
        for content, (marker, i) in self.special.items():
            owned[chr(BASE + FINAL + marker)] = i
            self.lengths[i] = 1
            tokens[i] = content
        merges = [tuple(map(self.spelled, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        # The same merges over symbols; it splits nothing.
        self.model = models.BPE(vocab=owned, merges=merges, cache_capacity=0)
        text = [t + b" " for t in tokens]
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.sizes = np.array([len(t) for t in text])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words: dict[bytes, np.ndarray] = {}
        self.kinds = _kinds()

    def spelled(self, token: str) -> str:
        """A token of the file as characters of symbols."""
        body = token.removesuffix(WORD_END)
        symbols = [BASE + self.byte_of[c] for c in body]
        if body != token:
            symbols[-1] += FINAL
        return "".join(map(chr, symbols))

    def _word(self, raw: bytes) -> np.ndarray:
        """Symbols of one word by the library's normalization and splitting."""
        found = self.words.get(raw)
        if found is None:
            if len(self.words) >= KNOWN_WORDS:
                self.words.clear()
            plain = self.library.normalizer.normalize_str(raw.decode())
            parts = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
            symbols = [[self.byte_of[c] for c in p] for p in parts]
            for part in symbols:
                part[-1] += FINAL
            found = self.words[raw] = np.array([s for part in symbols for s in part], np.uint16)
        return found

    def _marked(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Special tokens in the texts as their marker, a word of its own."""
        raw = data.tobytes()
        if not any(content in raw for content in self.special):
            return data, offsets
        texts = [raw[b:e] for b, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        for content, (marker, _) in self.special.items():
            texts = [t.replace(content, b" %c " % marker) for t in texts]
        return np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of texts given as bytes, and where each text begins."""
        data, offsets = self._marked(data, offsets)
        words = Words(data, offsets)
        before = np.r_[np.uint8(0), data[:-1]]
        upper = (data >= 65) & (data <= 90)
        # Letters of two bytes that are plain: the Latin-1 block without its two signs.
        second = (before == 0xC3) & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        low = data + 32 * (upper | (second & (data <= 0x9E))).astype(np.uint8)
        kinds = self.kinds[low]
        kinds[second] = _LETTER
        first = np.flatnonzero(second) - 1
        kinds[first] = _LETTER
        final = np.zeros(len(data), bool)
        if len(data):
            final[:-1] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != _SPACE)
            final |= kinds == _DIGIT
            final[words.ends - 1] = True
            self._endings(low, kinds, final, words)
        symbols = low + FINAL * final.astype(np.uint16)
        marker = data >= MARKERS[0]
        symbols[marker] = data[marker].astype(np.uint16) + FINAL
        kinds[marker] = _LETTER
        counts = words.ends - words.begins
        odd = np.r_[0, np.cumsum(kinds == _OTHER)]
        odd = np.flatnonzero(odd[words.ends] > odd[words.begins])
        begins = words.begins.copy()
        if len(odd):
            raw = data.tobytes()
            found = [self._word(raw[b:e]) for b, e in zip(words.begins[odd].tolist(), words.ends[odd].tolist())]
            counts[odd] = [len(f) for f in found]
            begins[odd] = len(symbols) + np.cumsum(counts[odd]) - counts[odd]
            symbols = np.concatenate([symbols, *found])
        total = np.r_[0, np.cumsum(counts)]
        return symbols[spans(begins, counts)], total[words.rows]

    @staticmethod
    def _endings(low: np.ndarray, kinds: np.ndarray, final: np.ndarray, words: Words) -> None:
        """An apostrophe that no mark precedes begins a short ending, which is a word."""
        at = np.flatnonzero(low == 39)
        inside = np.searchsorted(words.begins, at, "right") - 1
        open_ = (at == words.begins[inside]) | (kinds[at - 1] != _MARK)
        at, stop = at[open_], words.ends[inside[open_]]
        for ending in ENDINGS:
            hit = at + len(ending) < stop
            for i, value in enumerate(ending):
                hit[hit] = low[at[hit] + 1 + i] == value
            final[at[hit]] = False
            final[at[hit] + len(ending)] = True

    def encode(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each begins."""
        text = (symbols + np.uint16(BASE)).astype("<u2").tobytes().decode("utf-16-le")
        counts = -(-np.diff(bounds) // LEAF)
        row = np.repeat(np.arange(len(counts)), counts)
        begins = spans(np.zeros(len(counts), np.int64), counts) * LEAF + bounds[:-1][row]
        ends = np.minimum(begins + LEAF, bounds[1:][row])
        parts = [self._ids(text[b:e]) for b, e in zip(begins.tolist(), ends.tolist())]
        while len(row) > np.count_nonzero(counts):
            parts, row, ends = self._level(text, parts, row, ends)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        sizes = np.zeros(len(counts), np.int64)
        sizes[row] = [len(p) for p in parts]
        return ids, np.r_[0, np.cumsum(sizes)]

    def _ids(self, text: str) -> np.ndarray:
        return np.array([t.id for t in self.model.tokenize(text)], np.int64)

    def _level(self, text: str, parts: list[np.ndarray], row: np.ndarray, ends: np.ndarray):
        """Join the neighbours 0 and 1, 2 and 3, ... of every text."""
        place = np.arange(len(row)) - np.searchsorted(row, row)
        left = np.flatnonzero(place % 2 == 0)
        paired = np.r_[row[1:], -1][left] == row[left]
        joined = [
            self.join(text, parts[i], parts[i + 1], end) if both else parts[i]
            for i, end, both in zip(left.tolist(), ends[left].tolist(), paired.tolist())
        ]
        return joined, row[left], ends[left + paired]

    def join(self, text: str, left: np.ndarray, right: np.ndarray, at: int) -> np.ndarray:
        """Ids of both sides together; ``at`` is the place in ``text`` where they meet."""
        edge = EDGE
        while True:
            a, b = min(edge, len(left)), min(edge, len(right))
            begin = at - int(self.lengths[left[len(left) - a :]].sum())
            end = at + int(self.lengths[right[:b]].sum())
            window = self._ids(text[begin:end])
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return np.concatenate([left[: len(left) - a], window, right[b:]])
            edge *= 2

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The tokens of every text joined by a space."""
        flat = self.text[spans(self.starts[ids], self.sizes[ids])].tobytes()
        upto = np.r_[0, np.cumsum(self.sizes[ids])][ends].tolist()
        return [flat[b : e - 1] if e > b else b"" for b, e in zip(upto[:-1], upto[1:])]


def _coded(docs: DataFrame, vocabulary_path: str, id_column: str, text_column: str, fields: str, columns) -> DataFrame:
    """One Arrow pass; ``columns`` makes the columns after ``doc_id`` from ids, their bounds and the decoded texts.

    The vocabulary file is read here and sent to the tasks, so only the driver needs it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text("utf-8"))
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            longest = int(np.diff(offsets).max(initial=0))
            for bounds, first, _ in pieces(offsets, max(PIECE, longest), 0):
                ids, ends = coder.encode(*coder.symbols(data[bounds[0] : bounds[-1]], bounds - bounds[0]))
                arrays = [batch.column(0).slice(first, len(bounds) - 1), *columns(ids, ends, coder.decode(ids, ends))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return keyed_texts(docs, id_column, text_column).mapInArrow(run, fields)


def encode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``ENCODED``: the ids of every text and the text that they decode to."""

    def columns(ids: np.ndarray, ends: np.ndarray, decoded: list[bytes]) -> list[pa.Array]:
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return [lists, pa.array([d.decode() for d in decoded], pa.string())]

    return _coded(docs, vocabulary_path, id_column, text_column, ENCODED, columns)


def digests(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``DIGESTS`` of the same: ids as little-endian unsigned 32-bit integers, decoded text in UTF-8."""

    def columns(ids: np.ndarray, ends: np.ndarray, decoded: list[bytes]) -> list[pa.Array]:
        raw = memoryview(ids.astype("<u4").tobytes())
        marks = [hashlib.sha256(raw[4 * b : 4 * e]).hexdigest() for b, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
        texts = [hashlib.sha256(d).hexdigest() for d in decoded]
        return [pa.array(np.diff(ends), pa.int64()), pa.array(marks, pa.string()), pa.array(texts, pa.string())]

    return _coded(docs, vocabulary_path, id_column, text_column, DIGESTS, columns)
