import collections
import itertools
import random
import re

import numpy as np

from proofline.llm import line_quality, queries
from proofline.llm.line_quality import Field


def brute(text: str | None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), failed)


def _texts():
    rng = random.Random(9)
    pool = ["a", "be", "Éa", "x#", "|", "日本", "c.", "d"] + [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(60):
        chosen = pool if rng.random() < 0.5 else pool[:6]
        texts.append("".join(rng.choice(chosen) + rng.choice([" ", " ", " ", "\n", "\t", "\r\n", "\x0b "]) for _ in range(rng.randrange(0, 150))))
    return [*texts, "", None, "\n\n", "a b\na b\n", "x\n", " x \n x \n", "a a a a"]


def test_counts_equal_brute_force(spark):
    rows = list(enumerate(_texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_quality.judge(docs, None).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(text), text
        assert r.kept == (not r.base_failed)
    assert line_quality.judge(docs.limit(0), None).count() == 0


def _paths(field, features):
    scores = {}
    for labels in itertools.product((0, 1), repeat=len(features)):
        score = sum(features[i] @ field.weights for i, y in enumerate(labels) if y == line_quality.BOILERPLATE)
        score += sum(field.follows[a, b] for a, b in zip(labels, labels[1:]))
        scores[labels] = score
    return scores


def test_viterbi_and_gradient_equal_enumeration():
    rng = np.random.default_rng(4)
    field = Field(rng.normal(size=3), rng.normal(size=(2, 2)))
    sizes = [1, 4, 0, 6, 3]
    features = rng.normal(size=(sum(sizes), 3))
    row = np.repeat(np.arange(5), sizes)
    labels = line_quality.viterbi(field, row, features, 5)
    likelihood = 0.0
    padded, marks, mask = np.zeros((5, 6, 3)), np.zeros((5, 6), np.int64), np.zeros((5, 6), bool)
    for i, size in enumerate(sizes):
        if not size:
            continue
        scores = _paths(field, features[row == i])
        assert tuple(labels[row == i]) == max(scores, key=scores.get)
        padded[i, :size], mask[i, :size] = features[row == i], True
        marks[i, :size] = rng.integers(0, 2, size)
        likelihood += scores[tuple(marks[i, :size])] - np.log(sum(np.exp(s) for s in scores.values()))
    keep = np.array([0, 1, 3, 4])
    args = padded[keep], marks[keep], mask[keep]
    value, weights, follows = line_quality.gradient(field, *args)
    assert abs(value - likelihood) < 1e-8
    for k in range(3):
        moved = Field(field.weights + 1e-6 * np.eye(3)[k], field.follows)
        assert abs((line_quality.gradient(moved, *args)[0] - value) / 1e-6 - weights[k]) < 1e-3
    for a, b in itertools.product((0, 1), repeat=2):
        shift = np.zeros((2, 2))
        shift[a, b] = 1e-6
        moved = Field(field.weights, field.follows + shift)
        assert abs((line_quality.gradient(moved, *args)[0] - value) / 1e-6 - follows[a, b]) < 1e-3


def test_noise_is_told_from_prose(spark):
    rng = random.Random(2)
    prose = lambda: "\n".join(" ".join(rng.choice(["tree", "house", "river", "walks", "quiet"]) + str(rng.randrange(99)) for _ in range(12)) + "." for _ in range(8))
    noise = lambda: "\n".join(" | ".join(f"LINK{rng.randrange(999)}" for _ in range(12)) + " |" for _ in range(8))
    rows = [(i, prose() if i % 2 else noise()) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    field = line_quality.fit(docs, labels)
    assert all(r.kept == bool(r.doc_id % 2) for r in line_quality.judge(docs, field).collect())
    assert line_quality.fit(docs, labels.filter("quality = 1")) is None


def test_every_line_of_the_sample_is_fitted(spark, monkeypatch):
    """Noise that comes after hundreds of lines of prose is in the sample, in parts that end with their text."""
    monkeypatch.setattr(line_quality, "FIT_LINES", 8)
    text = "\n".join([f"some quiet words number {i} stand here." for i in range(300)] + ["| | LINK"] * 21)
    docs = spark.createDataFrame([(1, text), (2, "a b\n\nc d"), (3, None), (4, "x"), (5, "left out")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1), (9, 1)], "doc_id long, quality int")
    rows = line_quality.sample_lines(docs, labels, "doc_id", "text", 100).collect()
    assert sorted(len(r.codes) for r in rows if r.quality == 0) == [1] + [8] * 40
    assert sorted(len(r.codes) for r in rows if r.quality == 1) == [1, 2]
    bars = 1 << line_quality.FEATURES.index("bars")
    assert sum(bool(c & bars) for r in rows if r.quality == 0 for c in r.codes) == 21


def test_slopes_of_parts_add_up(spark):
    rng = np.random.default_rng(5)
    field = Field(rng.normal(size=len(line_quality.FEATURES)), rng.normal(size=(2, 2)))
    parts = [rng.integers(0, 1 << len(line_quality.FEATURES), rng.integers(1, line_quality.FIT_LINES + 1)) for _ in range(9)]
    quality = rng.integers(0, 2, 9)
    whole = line_quality.slope_of(field, parts, quality)
    one_by_one = sum(line_quality.slope_of(field, [p], quality[i : i + 1]) for i, p in enumerate(parts))
    assert np.allclose(whole, one_by_one) and whole[0] == sum(map(len, parts))


def test_verdicts_equal_an_own_decoding(spark):
    """``kept`` of the registered query from the texts alone: counts by brute force, labels by trying the field's paths."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    field = line_quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    got = {r.doc_id: r for r in queries.op5_line_quality(spark, folder).collect()}
    powers = line_quality.Powers()
    for row in docs.select("doc_id", "text").collect():
        counts = brute(row.text)
        raw = np.frombuffer((row.text or "").encode(), np.uint8)
        features = line_quality.read_lines(raw, np.array([0, len(raw)]), powers).features
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", line)) for line in (row.text or "").split("\n")]
        words = [n for n in words if n]
        # Scores of the best paths that end in either label, and the labels on them.
        best = [(0.0, []), (0.0, [])]
        for at, line in enumerate(features):
            emitted = (0.0, float(line @ field.weights))
            step = lambda y: max(
                ((best[x][0] + (field.follows[x, y] if at else 0.0), best[x][1]) for x in ((0, 1) if at else (y,))), key=lambda p: p[0]
            )
            best = [(step(y)[0] + emitted[y], step(y)[1] + [y]) for y in (0, 1)]
        labels = max(best, key=lambda p: p[0])[1]
        content = sum(n for n, y in zip(words, labels) if y == line_quality.CONTENT)
        kept = not counts[5] and content >= line_quality.CONTENT_SHARE * counts[0]
        assert (got[row.doc_id].kept, got[row.doc_id].n_words, got[row.doc_id].base_failed) == (kept, counts[0], counts[5])
