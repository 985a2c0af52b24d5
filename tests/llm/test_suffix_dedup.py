import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from proofline.llm import contexts, suffix_dedup


def _texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    passages = [word(30) for _ in range(4)]
    texts = []
    for _ in range(40):
        parts = [word(rng.randrange(0, 25)) for _ in range(3)]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(3), rng.choice(passages)[rng.randrange(8) :])
        texts.append("".join(parts))
    texts += [texts[3], texts[3], texts[7], "", "x" * 60, "ab" * 30]
    return texts


def brute(rows: list[tuple[int, str | None]], length: int, keep_first: bool):
    seen: dict[bytes, list[tuple[int, int]]] = {}
    raw = {i: (t or "").encode() for i, t in rows}
    for i in sorted(raw):
        for at in range(len(raw[i]) - length + 1):
            seen.setdefault(raw[i][at : at + length], []).append((i, at))
    result = {}
    for i, data in raw.items():
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            places = seen[data[at : at + length]]
            if len(places) > 1 and not (keep_first and places[0] == (i, at)):
                gone[at : at + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        result[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return result


@pytest.mark.parametrize(
    ("keep_first", "hot_rows", "piece"), [(False, 10_000, 1 << 20), (True, 10_000, 16), (False, 2, 16), (True, 2, 1 << 20)]
)
def test_equals_brute_force(spark, monkeypatch, keep_first, hot_rows, piece):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    rows = [(i * 3, t) for i, t in enumerate(_texts(5))] + [(1000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).repartition(3)
    found = suffix_dedup.repeated_strings(docs, keep_first, length=12, gram=5, hot_rows=hot_rows)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digest_columns(found).collect()}
    assert got == brute(rows, 12, keep_first)


def test_null_ids_and_texts_under_one_id(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, other, third = word(60), word(60), word(60)
    rows = [
        (None, word(9) + shared), (2, shared + word(9)), (7, other + word(5)), (7, word(5) + other), (None, third + word(3)), (None, word(4) + third),
        (None, word(8) + word(30)), (9, word(20)),
    ]
    rows += [(None, rows[6][1]), (None, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot_rows in (10_000, 1):
        found = suffix_dedup.repeated_strings(docs, False, length=12, gram=5, hot_rows=hot_rows)
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in suffix_dedup.digest_columns(found).collect())
        # A copy under the same (null) id is the same document; the copy of 9 under a null id is another one.
        removed = [60, 60, 60, 60, 60, 60, 0, 20, 0, 20]
        assert got == sorted((str(i), len(t), n) for (i, t), n in zip(rows, removed))
        first = suffix_dedup.repeated_strings(docs, True, length=12, gram=5, hot_rows=hot_rows)
        gone = {(str(r.doc_id), r.n_bytes): sum(s.end - s.start for s in r.spans) for r in first.collect() if r.doc_id != 7}
        # Ids come before null ones, so their copies stay.
        assert gone[("2", 69)] == gone[("9", 20)] == 0 and gone[("None", 69)] == 60 and gone[("None", 20)] == 20
        sevens = sorted(sum(s.end - s.start for s in r.spans) for r in first.filter("doc_id = 7").collect())
        assert sevens == [0, 60]


def test_longest_previous_factors_equal_comparison():
    rng = np.random.default_rng(6)
    for size in (1, 2, 40, 300):
        texts = ["".join(rng.choice(list("ab"), rng.integers(1, 9))) for _ in range(size)]
        order = sorted(range(size), key=lambda i: texts[i])
        prefix = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        common = np.array([0] + [prefix(texts[a], texts[b]) for a, b in zip(order, order[1:])])
        got = contexts.longest_previous(np.array(order), common)
        for at, i in enumerate(order):
            assert got[at] == max((prefix(texts[i], texts[j]) for j in range(i)), default=0)


def test_suffix_order_at_every_distance():
    rng = np.random.default_rng(8)
    left, right = rng.integers(1, 3, (200, 6)).astype(np.uint8), rng.integers(1, 3, (200, 8)).astype(np.uint8)
    bucket = np.sort(rng.integers(0, 3, 200))
    high = rng.integers(0, 6, 200)
    low = rng.integers(0, 6, 200) * 0
    seen = 0
    for distance, rows, common in contexts.Suffixes(bucket, left, right, low, high).distances():
        text = [bytes(left[r, :distance][::-1]) + bytes(right[r]) for r in rows]
        for k in range(1, len(rows)):
            same = bucket[rows[k]] == bucket[rows[k - 1]]
            real = next((n for n, (x, y) in enumerate(zip(text[k - 1], text[k])) if x != y), len(text[k])) if same else 0
            assert common[k] == (real if real >= distance and same else 0)
            seen += common[k] > distance
    assert seen > 100


@pytest.mark.parametrize("bytes_", [380, 400, 900])
def test_passages_of_over_and_under_the_length(spark, bytes_):
    """With the registered query's length: every passage of 400 bytes and more is found, clean texts are left alone."""
    rng = random.Random(bytes_)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passages = [letters(bytes_) for _ in range(20)]
    rows = [(i, letters(rng.randrange(300)) + "|" + passages[i % 20] + "|" + letters(rng.randrange(300))) for i in range(60)]
    rows += [(100 + i, letters(3000)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.digest_columns(suffix_dedup.repeated_strings(docs, False)).collect()
    removed = {r.doc_id: r.n_removed for r in found}
    assert all(removed[100 + i] == 0 for i in range(30))
    caught = sum(removed[i] >= bytes_ for i in range(60)) / 60
    # The mark on both sides belongs to what the three copies share.
    assert caught == (1.0 if bytes_ + 2 >= 400 else 0.0)


def test_repeated_rows_and_empty_table(spark):
    text = "abcdefghijklmnopqrstuvwxyz0123456789"
    docs = spark.createDataFrame([(1, text), (1, text), (2, "")], "doc_id long, text string")
    found = suffix_dedup.digest_columns(suffix_dedup.repeated_strings(docs, False, length=12, gram=5)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 0)]
    assert suffix_dedup.repeated_strings(docs.limit(0), False, length=12, gram=5).count() == 0
