"""SentencePiece encoding, and decoding: ids equal those of ``SentencePieceProcessor.encode``.

The vocabulary file says what its scores are.  In a BPE file they are ranks of merges: the best ranked pair of
neighbouring symbols that is a piece is joined first, of equal ranks the leftmost, until no pair is one.  In a
unigram file they are log probabilities, and a streaming Viterbi search finds the segmentation of the highest sum.
Kinds of files whose ids need more than that (other models, normalization, pieces given by the user or unused)
raise ``ValueError``.

The search reads a text character by character and keeps, for the last ``longest`` boundaries, the best score
of a segmentation that ends there and the boundary before.  Every later path passes through one of these
boundaries; as soon as all of them go back to one common boundary, the pieces up to it are final and
their ids are committed, and what lies before it is forgotten.  A window bounded by the longest piece is all that
is needed for scores, whatever the text's length.

Of equal sums the longer last piece wins.  A character without a piece costs more than any piece and is
written as its bytes, in both kinds of files.  A text
is read with a space before it, and spaces as ``▁``.

Between two characters that stand next to each other in no piece all paths always converge and nothing is
merged, so texts are cut there first and every distinct part is searched once while it is remembered.  A part of up to ``WINDOW``
characters fits the window as a whole and converges at its end; a longer one is streamed, or for merges cut at
every such pair of characters.  What is left is held whole.

Null and empty texts have no ids.  Repeated rows are each returned; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from proofline.llm.arrays import spans
from proofline.llm.staging import keyed_texts

SPACE = "▁"
# A character without a piece is that much worse than the worst piece.
UNKNOWN_COST = 10.0
KNOWN_PARTS = 1 << 19
# Parts up to this length are searched as one window.
WINDOW = 64
# Parts up to this length are merged with their pairs in a list.
SHORT = 32
_NO_PIECE = float("-inf")
# Texts are encoded together up to this many characters.
TOGETHER = 2 << 20

_UNIGRAM, _BPE = 1, 2
_USER_DEFINED, _UNUSED = 4, 5

ENCODED = "doc_id long, ids array<int>, decoded binary"
DIGESTS = "doc_id long, n_ids long, ids_crc32 long, n_bytes long, decoded_sha256 string"


def read_vocabulary(path: str) -> dict:
    """Pieces, scores and kinds of a vocabulary file, as plain lists, and whether scores are ranks of merges."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    stored = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    trained, rules = stored.trainer_spec, stored.normalizer_spec
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    if rules.precompiled_charsmap or not plain or trained.treat_whitespace_as_suffix or not trained.byte_fallback:
        raise ValueError(f"{path}: normalizes texts or has no bytes")
    if trained.model_type not in (_UNIGRAM, _BPE) or any(p.type in (_USER_DEFINED, _UNUSED) for p in stored.pieces):
        raise ValueError(f"{path}: neither BPE nor unigram, or has pieces given by the user or unused")
    size = model.get_piece_size()
    return {
        "pieces": [model.id_to_piece(i) for i in range(size)],
        "scores": [model.get_score(i) for i in range(size)],
        "bytes": [i for i in range(size) if model.is_byte(i)],
        "special": [i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)],
        "by_rank": trained.model_type == _BPE,
    }


class Vocabulary:
    """Pieces by text, all beginnings of pieces, and what each id decodes to."""

    def __init__(self, vocabulary: dict) -> None:
        pieces, special = vocabulary["pieces"], set(vocabulary["special"])
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in vocabulary["bytes"]}
        apart = special | set(vocabulary["bytes"])
        self.ids = {p: i for i, p in enumerate(pieces) if i not in apart}
        self.scores = {p: vocabulary["scores"][i] for p, i in self.ids.items()}
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_COST
        self.longest = max(map(len, self.ids), default=1)
        self.begins = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.inside = inside
        # Characters no piece joins with another one, and whether only spaces go before a space.
        self.space_begins = not any(pair[1] == SPACE and pair[0] != SPACE for pair in inside)
        self.line_alone = not any("\n" in pair for pair in inside)
        text = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in special:
            text[i] = b""
        for value, i in self.byte_ids.items():
            text[i] = bytes([value])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        ends = np.cumsum([len(t) for t in text])
        self.sizes = np.diff(ends, prepend=0)
        self.starts = ends - self.sizes

    def spelled(self, piece: str) -> list[int]:
        """Ids of a piece, or of the bytes of a character that is none."""
        found = self.ids.get(piece)
        return [found] if found is not None else [self.byte_ids[b] for b in piece.encode()]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a sequence of ids, the space before a text included."""
        return self.text[spans(self.starts[ids], self.sizes[ids])]


class Stream:
    """One search.  ``push`` takes characters and returns the ids that became final; ``finish`` the others."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.text = ""  # characters since the last final boundary
        self.scores = [0.0]  # by boundary, counted from there
        self.before = [0]
        # Pieces that began and may go on: their start.
        self.open: deque[int] = deque()

    def push(self, characters: str) -> list[int]:
        final: list[int] = []
        for character in characters:
            self._step(character)
            final += self._commit()
        return final

    def _step(self, character: str) -> None:
        words = self.vocabulary
        at = len(self.text)
        self.text += character
        self.open.append(at)
        best, start = None, at
        going: deque[int] = deque()
        for begin in self.open:
            piece = self.text[begin:]
            if piece not in words.begins:
                continue
            going.append(begin)
            score = words.scores.get(piece)
            if score is not None and (best is None or self.scores[begin] + score > best):
                best, start = self.scores[begin] + score, begin
        if character not in words.ids:
            score = self.scores[at] + words.unknown
            if best is None or score > best:
                best, start = score, at
        self.open = going
        # A character always has a piece or is unknown, so every boundary is reached.
        self.scores.append(best)
        self.before.append(start)

    def _commit(self) -> list[int]:
        """Give out what lies before the last boundary that all surviving paths share."""
        last = len(self.text)
        alive = {last, *self.open}
        while len(alive) > 1:
            latest = max(alive)
            alive.discard(latest)
            alive.add(self.before[latest])
        common = alive.pop()
        if not common:
            return []
        ids = self._ids(common)
        self.text = self.text[common:]
        base = self.scores[common]
        # Paths to earlier boundaries are no longer needed: all open pieces begin later.
        self.scores = [s - base for s in self.scores[common:]]
        self.before = [0, *[b - common for b in self.before[common + 1 :]]]
        self.open = deque(b - common for b in self.open)
        return ids

    def _ids(self, upto: int) -> list[int]:
        cuts = [upto]
        while cuts[-1]:
            cuts.append(self.before[cuts[-1]])
        cuts.reverse()
        return [i for b, e in zip(cuts, cuts[1:]) for i in self.vocabulary.spelled(self.text[b:e])]

    def finish(self) -> list[int]:
        ids = self._ids(len(self.text))
        self.__init__(self.vocabulary)
        return ids


def search(vocabulary: Vocabulary, part: str) -> list[int]:
    """Ids of a part that is one window: scores of all its boundaries, forward, then the way back."""
    begins, values, unknown = vocabulary.begins, vocabulary.scores.get, vocabulary.unknown
    size = len(part)
    best: list[float | None] = [None] * (size + 1)
    best[0] = 0.0
    before = [0] * (size + 1)
    for begin in range(size):
        base = best[begin]
        for end in range(begin + 1, size + 1):
            piece = part[begin:end]
            if piece not in begins:
                break
            score = values(piece)
            if score is not None:
                if best[end] is None or base + score > best[end]:
                    best[end], before[end] = base + score, begin
        if part[begin] not in vocabulary.ids:
            if best[begin + 1] is None or base + unknown > best[begin + 1]:
                best[begin + 1], before[begin + 1] = base + unknown, begin
    cuts = [size]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    cuts.reverse()
    return [i for b, e in zip(cuts, cuts[1:]) for i in vocabulary.spelled(part[b:e])]


def merge(vocabulary: Vocabulary, part: str) -> list[int]:
    """Ids of a part by merges: the best ranked pair first, of equal ranks the leftmost.

    A short part keeps the scores of its neighbouring pairs in a list, whose maximum is looked up for every merge.
    """
    if len(part) > SHORT:
        return merge_long(vocabulary, part)
    values = vocabulary.scores.get
    symbols = list(part)
    pairs = [values(a + b, _NO_PIECE) for a, b in zip(symbols, symbols[1:])]
    while pairs and (best := max(pairs)) > _NO_PIECE:
        at = pairs.index(best)
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = values(symbols[at - 1] + symbols[at], _NO_PIECE)
        if at < len(pairs):
            pairs[at] = values(symbols[at] + symbols[at + 1], _NO_PIECE)
    return _spelled(vocabulary, symbols)


def _spelled(vocabulary: Vocabulary, symbols: list[str]) -> list[int]:
    known = vocabulary.ids.get
    ids = list(map(known, symbols))
    return [i for symbol in symbols for i in vocabulary.spelled(symbol)] if None in ids else ids


def merge_long(vocabulary: Vocabulary, part: str) -> list[int]:
    """The same with the pairs in a heap."""
    values, size = vocabulary.scores.get, len(part)
    symbols = list(part)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    waiting = []
    for left in range(size - 1):
        piece = part[left : left + 2]
        if (score := values(piece)) is not None:
            waiting.append((-score, left, left + 1, piece))
    heapq.heapify(waiting)
    while waiting:
        _, left, right, piece = heapq.heappop(waiting)
        # One of the two was merged meanwhile.
        if not symbols[right] or symbols[left] + symbols[right] != piece:
            continue
        symbols[left], symbols[right] = piece, ""
        behind = after[left] = after[right]
        if behind < size:
            before[behind] = left
        for first, second in ((before[left], left), (left, behind)):
            if first >= 0 and second < size:
                piece = symbols[first] + symbols[second]
                if (score := values(piece)) is not None:
                    heapq.heappush(waiting, (-score, first, second, piece))
    return _spelled(vocabulary, [symbol for symbol in symbols if symbol])


class Encoder:
    """Ids of texts; distinct parts between sure boundaries are searched once while they are remembered.

    ``by_rank`` says that the scores are ranks of merges, else they are summed.
    """

    def __init__(self, vocabulary: Vocabulary, by_rank: bool = False) -> None:
        self.vocabulary = vocabulary
        self.by_rank = by_rank
        self.stream = Stream(vocabulary)
        if vocabulary.space_begins and vocabulary.line_alone:
            self.parts = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        else:
            self.parts = lambda text: [text]
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = array("i")
        self.ends = array("q", [0])

    def forget_oldest(self) -> None:
        """Keep the half of the parts that was met last."""
        old = len(self.places) // 2
        ends = np.frombuffer(self.ends, np.int64)
        first = int(ends[old])
        self.places = {part: at for at, part in enumerate(itertools.islice(self.places, old, None))}
        self.ids, self.ends = self.ids[first:], array("q", (ends[old:] - first).tobytes())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        if len(self.places) > KNOWN_PARTS:
            self.forget_oldest()
        places: list[int] = []
        counts = []
        for text in texts:
            parts = self.parts(SPACE + text.replace(" ", SPACE)) if text else []
            found = list(map(self.places.get, parts))
            for at, place in enumerate(found):
                if place is None:
                    found[at] = self._place(parts[at])
            places += found
            counts.append(len(found))
        if not places:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ends = np.array(self.ends)
        sizes = np.diff(ends)[places]
        ids = np.array(self.ids)[spans(ends[:-1][places], sizes)]
        total = np.r_[0, np.cumsum(sizes)]
        bounds = np.r_[0, np.cumsum(counts)]
        return ids, np.diff(total[bounds])

    def _place(self, part: str) -> int:
        place = self.places.get(part)
        if place is None:
            place = self.places[part] = len(self.ends) - 1
            if self.by_rank:
                for short in self._apart(part):
                    self.ids.extend(merge(self.vocabulary, short))
            elif len(part) <= WINDOW:
                self.ids.extend(search(self.vocabulary, part))
            else:
                self.ids.extend(self.stream.push(part))
                self.ids.extend(self.stream.finish())
            self.ends.append(len(self.ids))
        return place

    def _apart(self, part: str) -> Iterator[str]:
        """A long part cut between all characters that no piece joins."""
        start = 0
        if len(part) > WINDOW:
            for at in range(1, len(part)):
                if part[at - 1 : at + 1] not in self.vocabulary.inside:
                    yield part[start:at]
                    start = at
        yield part[start:]


def _together(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > TOGETHER:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def _coded(docs: DataFrame, vocabulary_path: str, id_column: str, text_column: str, fields: str, columns) -> DataFrame:
    """One Arrow pass; ``columns`` makes the columns after ``doc_id`` from the ids, their bounds and the decoded texts.

    The vocabulary file is read here and sent to the tasks, so only the driver needs it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        encoder = Encoder(vocabulary, shared.value["by_rank"])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, after in _together(texts):
                ids, counts = encoder.encode(texts[first:after])
                ends = np.r_[0, np.cumsum(counts)]
                flat = memoryview(vocabulary.decode(ids))
                sizes = np.r_[0, np.cumsum(vocabulary.sizes[ids])][ends]
                # Without the space before the text.
                decoded = [flat[b + 1 : e] for b, e in zip(sizes[:-1].tolist(), sizes[1:].tolist())]
                arrays = [batch.column(0).slice(first, after - first), *columns(ids, ends, decoded)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return keyed_texts(docs, id_column, text_column).mapInArrow(run, fields)


def encode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``ENCODED``: the ids of every text and the bytes they decode to."""

    def columns(ids: np.ndarray, ends: np.ndarray, decoded: list[memoryview]) -> list[pa.Array]:
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return [lists, pa.array([bytes(d) for d in decoded], pa.binary())]

    return _coded(docs, vocabulary_path, id_column, text_column, ENCODED, columns)


def digests(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``DIGESTS``: number and CRC-32 of the ids (unsigned 32-bit, little-endian), length and SHA-256 of what they decode to."""

    def columns(ids: np.ndarray, ends: np.ndarray, decoded: list[memoryview]) -> list[pa.Array]:
        raw = memoryview(ids.astype("<u4").tobytes())
        codes = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [
            pa.array(np.diff(ends), pa.int64()),
            pa.array(codes, pa.int64()),
            pa.array([len(d) for d in decoded], pa.int64()),
            pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
        ]

    return _coded(docs, vocabulary_path, id_column, text_column, DIGESTS, columns)
