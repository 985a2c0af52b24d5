"""Line labelling by a linear-chain conditional random field: content or boilerplate.

A document's lines with a word are a sequence.  Each has features of its characters, words and neighbours'
repeats; the field adds weights for two labels following each other.  Viterbi decoding gives the best
labels of all lines together, and a document is kept if at least ``CONTENT_SHARE`` of its words are on content
lines.  Fixed counts decide first: fewer than ``LEAST_WORDS`` words, or more than half of the words in repeated
three-word windows, fail a document whatever its lines are.

The field is fitted by gradient ascent on the penalised conditional likelihood of a bounded sample: all lines of the
``SAMPLE`` labelled documents of least hash, with the document's quality label on them.  The sample's features are stored, and
every step of the ascent is a pass over them in which each task sums the gradient of its own lines; a long text is
fitted in parts of ``FIT_LINES`` lines.  Without documents of both labels every line is content.

Null and empty texts have no words and fail; repeated rows are each returned; an empty table gives no
rows; other columns are not read.  Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm.arrays import (
    PIECE,
    Powers,
    Words,
    byte_values,
    flat_text,
    gram_hashes,
    mixed,
    pieces,
    prefix_hash,
    ranges_hash,
    spans,
)
from proofline.llm.staging import keyed_texts, stage

LEAST_WORDS = 50
CONTENT_SHARE = 0.5
SAMPLE = 2000
# The sample's longer texts are fitted in parts of this many lines; decoding takes every text whole.
FIT_LINES = 64
# Parts whose gradient is summed at once, and files of the stored sample.
FIT_TOGETHER = 512
FIT_FILES = 4
STEPS = 150
RATE = 0.2
PENALTY = 1e-3

SYMBOLS = b"#*$%&|<>"
CONTENT, BOILERPLATE = 0, 1

FEATURES = (
    "bias",
    "some_symbols",
    "many_symbols",
    "capitals",
    "exclamations",
    "bars",
    "digits",
    "no_stop",
    "short",
    "very_short",
    "repeats_before",
    "few_distinct_words",
    "long_words",
    "address",
)

VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_words long, n_lines long, n_content_lines long"
)


@dataclass
class Field:
    """Weights of boilerplate against content, and of one label after another (``[before, after]``)."""

    weights: np.ndarray
    follows: np.ndarray


@dataclass
class Lines:
    """Lines with a word of a piece: row of each, words of each, features, and the counts per row."""

    row: np.ndarray
    words: np.ndarray
    features: np.ndarray
    counts: dict[str, np.ndarray]


def _per(rows: np.ndarray, size: int, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weight, size).astype(np.int64)


def read_lines(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> Lines:
    """Lines, features and counts of several texts."""
    texts = len(offsets) - 1
    words = Words(data, offsets)
    word_row = np.repeat(np.arange(texts), np.diff(words.rows))
    # Lines end before every newline and at every text's end.
    breaks = np.flatnonzero(data == 10)
    begins = np.sort(np.r_[offsets[:-1], breaks + 1])
    ends = np.sort(np.r_[offsets[1:], breaks])
    line_row = np.repeat(np.arange(texts), np.diff(np.searchsorted(breaks, offsets)) + 1)
    word_line = np.searchsorted(begins, words.begins, "right") - 1
    per_line = np.bincount(word_line, minlength=len(begins))
    solid = np.flatnonzero(per_line)
    begins, ends, line_row, n_words = begins[solid], ends[solid], line_row[solid], per_line[solid]

    prefix = prefix_hash(byte_values()[data], powers)
    line_hash = mixed(ranges_hash(prefix, begins, ends, powers) ^ mixed(line_row.astype(np.uint64)))
    order = np.argsort(line_hash, kind="stable")
    repeated = np.zeros(len(order), bool)
    repeated[order[1:]] = line_hash[order[1:]] == line_hash[order[:-1]]

    values = ranges_hash(prefix, words.begins, words.ends, powers)
    grams = gram_hashes(prefix_hash(values, powers), 3, powers)
    whole = np.flatnonzero(word_row[2:] == word_row[:-2]) if len(word_row) > 2 else np.zeros(0, np.int64)
    keys = mixed(grams[whole] ^ mixed(word_row[whole].astype(np.uint64)))
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = whole[times[place] > 1] if len(whole) else whole
    covered = np.zeros(len(values), bool)
    for step in range(3):
        covered[again + step] = True

    table = np.zeros(256, np.uint8)
    table[list(SYMBOLS)] = 1

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(mask)]
        return total[ends] - total[begins]

    size = np.maximum(ends - begins, 1)
    letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    symbols = table[data].astype(bool)
    last_word = np.cumsum(n_words) - 1
    final = data[words.ends[last_word] - 1] if len(n_words) else np.zeros(0, np.uint8)
    # Distinct words of a line.
    line_of_word = np.repeat(np.arange(len(n_words)), n_words)
    keyed = mixed(values ^ mixed(line_of_word.astype(np.uint64)))
    _, fresh = np.unique(keyed, return_index=True)
    distinct = np.bincount(line_of_word[fresh], minlength=len(n_words))
    columns = [
        np.ones(len(n_words)),
        within(symbols) > 0.02 * size,
        within(symbols) > 0.08 * size,
        within((data >= 65) & (data <= 90)) > 0.5 * np.maximum(within(letters), 1),
        within(data == 33) > 0.05 * size,
        within(data == 124) > 0.02 * size,
        within((data >= 48) & (data <= 57)) > 0.2 * size,
        ~np.isin(final, (33, 46, 63)),
        n_words < 6,
        n_words < 3,
        repeated,
        2 * distinct < n_words,
        size > 14 * n_words,
        within((data == 58) & (np.r_[data[1:], 0] == 47)[: len(data)]) > 0,
    ]
    solid_bytes = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data & 0xC0) != 0x80) & (data != 32) & ((data < 9) | (data > 13)), out=solid_bytes[1:])
    counted = np.r_[0, np.cumsum(symbols)]
    counts = {
        "n_words": np.diff(words.rows),
        "word_chars": solid_bytes[offsets[1:]] - solid_bytes[offsets[:-1]],
        "n_symbols": counted[offsets[1:]] - counted[offsets[:-1]],
        "n_dup_lines": _per(line_row, texts, repeated),
        "n_repeat_words": _per(word_row, texts, covered),
    }
    return Lines(line_row, n_words, np.stack(columns, axis=1).astype(np.float64), counts)


def viterbi(field: Field, row: np.ndarray, features: np.ndarray, rows: int) -> np.ndarray:
    """Best labels of all lines, the texts in step; ``row`` grows."""
    labels = np.zeros(len(row), np.int64)
    counts = np.bincount(row, minlength=rows)
    starts = np.cumsum(counts) - counts
    emission = np.zeros((len(row), 2))
    emission[:, BOILERPLATE] = features @ field.weights
    best = np.zeros((len(row), 2))
    came = np.zeros((len(row), 2), np.int64)
    long_first = np.argsort(-counts, kind="stable")
    sizes = -counts[long_first]
    for step in range(int(counts.max(initial=0))):
        at = starts[long_first[: int(np.searchsorted(sizes, -step, "left"))]] + step
        if step == 0:
            best[at] = emission[at]
            continue
        paths = best[at - 1][:, :, None] + field.follows[None]
        came[at] = paths.argmax(axis=1)
        best[at] = paths.max(axis=1) + emission[at]
    for step in range(int(counts.max(initial=0)) - 1, -1, -1):
        active = long_first[: int(np.searchsorted(sizes, -step, "left"))]
        at = starts[active] + step
        ending = counts[active] == step + 1
        labels[at[ending]] = best[at[ending]].argmax(axis=1)
        going = at[~ending]
        labels[going] = came[going + 1, labels[going + 1]]
    return labels


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradient(field: Field, features: np.ndarray, labels: np.ndarray, mask: np.ndarray):
    """Log likelihood of padded sequences and its gradient, by forward and backward sums.

    ``features`` is sequences x lines x features; ``mask`` marks real lines, padding comes last.
    """
    count, length, _ = features.shape
    emission = np.zeros((count, length, 2))
    emission[:, :, BOILERPLATE] = features @ field.weights
    forward, backward = np.zeros_like(emission), np.zeros_like(emission)
    forward[:, 0] = emission[:, 0]
    for t in range(1, length):
        moved = _log_sum(forward[:, t - 1][:, :, None] + field.follows[None], 1) + emission[:, t]
        forward[:, t] = np.where(mask[:, t, None], moved, forward[:, t - 1])
    total = _log_sum(forward[:, -1], 1)
    for t in range(length - 2, -1, -1):
        moved = _log_sum(field.follows[None] + (emission[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], moved, 0.0)
    chance = np.exp(forward + backward - total[:, None, None])[:, :, BOILERPLATE] * mask
    weights = np.einsum("ntf,nt->f", features, (labels == BOILERPLATE) * mask - chance)
    pairs = (mask[:, 1:] & mask[:, :-1])[:, :, None, None]
    joint = forward[:, :-1, :, None] + field.follows[None, None] + (emission + backward)[:, 1:, None, :] - total[:, None, None, None]
    follows = -(np.exp(np.where(pairs, joint, -np.inf))).sum(axis=(0, 1))
    score = np.take_along_axis(emission, labels[:, :, None], 2)[:, :, 0]
    moves = field.follows[labels[:, :-1], labels[:, 1:]] * pairs[:, :, 0, 0]
    np.add.at(follows, (labels[:, :-1], labels[:, 1:]), pairs[:, :, 0, 0].astype(float))
    likelihood = (score * mask).sum() + moves.sum() - total.sum()
    return likelihood, weights, follows


def ascend(slope_at: Callable[[Field], np.ndarray], size: int) -> Field:
    """Gradient ascent with moment estimates on the mean penalised likelihood.

    ``slope_at`` gives the number of lines and the gradient of their likelihood, weights before follows.
    """
    theta = np.zeros(size + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        total = slope_at(Field(theta[:size], theta[size:].reshape(2, 2)))
        slope = total[1:] / max(1, total[0]) - PENALTY * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:size], theta[size:].reshape(2, 2))


def slope_of(field: Field, parts: list[np.ndarray], quality: np.ndarray) -> np.ndarray:
    """Number of lines and gradient of parts given as codes of their lines."""
    total = np.zeros(1 + len(FEATURES) + 4)
    for at in range(0, len(parts), FIT_TOGETHER):
        some = parts[at : at + FIT_TOGETHER]
        codes = np.zeros((len(some), FIT_LINES), np.int64)
        mask = np.arange(FIT_LINES) < np.array([len(p) for p in some])[:, None]
        codes[mask] = np.concatenate(some)
        features = (codes[:, :, None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)
        labels = np.where(quality[at : at + FIT_TOGETHER, None] == 1, CONTENT, BOILERPLATE) * mask
        _, weights, follows = gradient(field, features, labels, mask)
        total += np.r_[mask.sum(), weights, follows.ravel()]
    return total


def sample_lines(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, sample: int) -> DataFrame:
    """``codes, quality`` of all lines of the sample, in parts of ``FIT_LINES``: a line's features are the bits of its code."""
    marked = labels.filter("quality in (0, 1)").select(F.col("doc_id"), F.col("quality").cast("int").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    # The sample has a fixed bound, and it is what is sent; texts stay where they are until they match.
    texts = keyed_texts(docs, id_column, text_column).join(F.broadcast(chosen), "doc_id").select("text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        bits = 1 << np.arange(len(FEATURES))
        for batch in batches:
            data, offsets = flat_text(batch.column(0))
            for bounds, first, _ in pieces(offsets, max(PIECE, int(np.diff(offsets).max(initial=0))), 0):
                lines = read_lines(data[bounds[0] : bounds[-1]], bounds - bounds[0], powers)
                codes = (lines.features.astype(np.int64) * bits).sum(axis=1).astype(np.int32)
                counts = np.bincount(lines.row, minlength=len(bounds) - 1)
                per_text = -(-counts // FIT_LINES)
                text = np.repeat(np.arange(len(counts)), per_text)
                starts = (np.cumsum(counts) - counts)[text] + spans(np.zeros(len(counts), np.int64), per_text) * FIT_LINES
                cells = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(codes)].astype(np.int32)), pa.array(codes))
                quality = batch.column(1).take(pa.array(first + text))
                yield pa.RecordBatch.from_arrays([cells, quality], names=["codes", "quality"])

    return texts.mapInArrow(run, "codes array<int>, quality int")


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> Field | None:
    """Fit on the labelled documents of least hash, at most ``sample``; ``None`` without both labels.

    What comes to the driver in a step is a row of sums per task.
    """
    stored = stage(sample_lines(docs, labels, id_column, text_column, sample).repartition(FIT_FILES), "lines")
    if stored.select("quality").distinct().count() < 2:
        return None

    def slope_at(field: Field) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(1 + len(FEATURES) + 4)
            for batch in batches:
                lists = batch.column(0)
                parts = np.split(lists.flatten().to_numpy().astype(np.int64), np.cumsum(lists.value_lengths().to_numpy())[:-1])
                total += slope_of(field, parts, batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

        return np.sum([r.total for r in stored.mapInArrow(run, "total array<double>").collect()], axis=0)

    return ascend(slope_at, len(FEATURES))


def judge(docs: DataFrame, field: Field | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``VERDICT`` of every document."""
    weights = field or Field(np.r_[-1.0, np.zeros(len(FEATURES) - 1)], np.zeros((2, 2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            data, offsets = flat_text(batch.column(1))
            for bounds, first, _ in pieces(offsets, max(PIECE, int(np.diff(offsets).max(initial=0))), 0):
                texts = len(bounds) - 1
                lines = read_lines(data[bounds[0] : bounds[-1]], bounds - bounds[0], powers)
                content = viterbi(weights, lines.row, lines.features, texts) == CONTENT
                n_words, repeats = lines.counts["n_words"], lines.counts["n_repeat_words"]
                in_content = _per(lines.row, texts, lines.words * content)
                failed = (n_words < LEAST_WORDS) | (100 * repeats > 50 * n_words)
                kept = ~failed & (in_content >= CONTENT_SHARE * n_words)
                arrays = [batch.column(0).slice(first, texts), *map(pa.array, lines.counts.values()), pa.array(failed), pa.array(kept)]
                arrays += [pa.array(in_content), pa.array(_per(lines.row, texts)), pa.array(_per(lines.row, texts, content))]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in VERDICT.split(", ")])

    return keyed_texts(docs, id_column, text_column).mapInArrow(run, VERDICT)
