import hashlib
import random

import pytest
from pyspark.sql import functions as F

from proofline.llm import block_dedup


def _texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    words = lambda n: [rng.choice(["a", "b", "é", "dd"]) for _ in range(n)]
    passages = [words(20) for _ in range(4)]
    texts = []
    for _ in range(50):
        parts = [words(rng.randrange(0, 14)) for _ in range(3)]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(3), rng.choice(passages)[rng.randrange(7) :])
        texts.append(rng.choice([" ", "\n ", "\t"]).join(w for p in parts for w in p))
    return [*texts, texts[3], texts[3].replace(" ", "  "), "", "a " * 40, "a b " * 20, "a\xa0b"]


def brute(rows, window):
    words = {i: (t or "").encode().split() for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for at in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][at : at + window]), i)
    result = {}
    for i, own in words.items():
        gone = set()
        for at in range(len(own) - window + 1):
            if first[tuple(own[at : at + window])] < i:
                gone.update(range(at, at + window))
        kept = b" ".join(w for k, w in enumerate(own) if k not in gone)
        result[i] = (len(own), len(gone), hashlib.sha256(kept).hexdigest())
    return result


@pytest.mark.parametrize(("window", "block", "gram"), [(10, 5, 4), (9, 4, 3)])
@pytest.mark.parametrize(("hot_rows", "piece"), [(10_000, 16), (2, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, window, block, gram, hot_rows, piece):
    monkeypatch.setattr(block_dedup, "PIECE", piece)
    rows = [(i * 3, t) for i, t in enumerate(_texts(2))] + [(1000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit(1)).repartition(3)
    found = block_dedup.repeated_passages(docs, window=window, block=block, gram=gram, hot_rows=hot_rows)
    got = {r.doc_id: tuple(r)[1:] for r in block_dedup.digest_columns(found).collect()}
    expected = brute(rows, window)
    assert sum(r[1] for r in expected.values()) > 0
    assert got == expected


@pytest.mark.parametrize("hot_rows", [10_000, 1])
def test_null_ids_and_texts_under_one_id(spark, hot_rows):
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, other, third = words(20), words(20), words(20)
    texts = [words(5) + shared, shared + words(5), other + words(3), words(3) + other, third + words(2), words(2) + third, words(30)]
    ids = [None, 5, 7, 7, None, None, 9]
    rows = [(i, " ".join(t)) for i, t in zip(ids, texts)] + [(None, "  ".join(texts[6])), (3, " ".join(words(4) + other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = block_dedup.digest_columns(block_dedup.repeated_passages(docs, window=10, block=5, gram=4, hot_rows=hot_rows))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in found.collect())
    # A null id comes last; texts under one id, or under null ones, are not earlier than each other.
    removed = [20, 0, 20, 20, 0, 0, 0, 30, 0]
    assert got == sorted((str(i), len(t.split()), n) for (i, t), n in zip(rows, removed))


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    found = block_dedup.digest_columns(block_dedup.repeated_passages(docs, window=10, block=5, gram=4)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 30)]
    assert block_dedup.repeated_passages(docs.limit(0), window=10, block=5, gram=4).count() == 0
