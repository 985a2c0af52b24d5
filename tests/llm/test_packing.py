import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from proofline.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _tokenizer():
    found = Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return found


def _texts():
    rng = random.Random(3)
    words = "The the Thé straße naïve it's don't l'été x_y 12,5 «non» … İstanbul été 日本 😀 a.b <|endoftext|> \x1c end. what? yes! ŉ ſ".split(" ")
    texts = [" ".join(rng.choice(words) + rng.choice(["", ".", ",", "\n", "  ", "\t", "\x85", "\xa0"]) for _ in range(rng.randrange(0, 400))) for _ in range(120)]
    return [*texts, "", None, " \n ", "word " * 9000, "x" * 30000, "a\x00b\nc"]


def _check(rows, texts, partitions=None):
    """Every id in one piece, windows gapless and at most full; returns the share of padding."""
    tokenizer = _tokenizer()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in texts}
    at = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()}
    sizes: dict[int, int] = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sizes.get(r.sequence_id, 0)
        sizes[r.sequence_id] = r.offset + r.length
    assert max(sizes.values(), default=0) <= packing.WINDOW
    return sum(map(packing.padding, sizes.values())) / max(1, sum(len(x) for x in ids.values()))


@pytest.mark.parametrize("partitions", [1, 3])
def test_every_token_is_packed_once(spark, partitions):
    texts = list(enumerate(_texts()))
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).repartition(partitions)
    rows = packing.pack(docs, VOCABULARY).collect()
    assert _check(rows, texts) < 0.01
    tokenizer = _tokenizer()
    whole = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts}
    assert all(r.ids == whole[r.doc_id][r.start : r.start + r.length] for r in rows)


@pytest.mark.parametrize("words", [[0], [None], [255], [256], [4095], [4096], [8191], [packing.BLOCK - 1, 4095], [packing.BLOCK - 1, 0], [packing.BLOCK, 255]])
def test_partitions_that_end_with_one_window(spark, words):
    texts = [(i, None if n is None else "a " * n) for i, n in enumerate(words)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    _check(packing.pack(docs, VOCABULARY, with_ids=False).collect(), texts)
    assert [f.dataType.typeName() for f in packing.pack(docs, VOCABULARY).schema][:-1] == ["long"] * 7


def test_order_is_kept(spark):
    docs = spark.createDataFrame([(i, f"word {i}. " * (i % 50)) for i in range(300)], "doc_id long, text string").coalesce(1)
    rows = sorted(packing.pack(docs, VOCABULARY, with_ids=False).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, ids int")
    assert packing.pack(docs, VOCABULARY).count() == 0


def test_least_costs_equal_brute_force(monkeypatch):
    monkeypatch.setattr(packing, "WINDOW", 64)
    monkeypatch.setattr(packing, "SHORTEST", 4)
    rng = random.Random(1)
    for _ in range(200):
        cuts = np.cumsum([rng.randrange(1, 20) for _ in range(rng.randrange(1, 40))])
        costs = np.array([rng.choice([0, 3, 9]) for _ in cuts])
        places = [0, *cuts.tolist()]
        best = [0.0] + [float("inf")] * len(cuts)
        for j in range(1, len(places)):
            for i in range(j):
                size = places[j] - places[i]
                short = size & (size - 1) == 0 and 4 <= size <= 64
                if size <= 64:
                    best[j] = min(best[j], best[i] + (0 if short else 64 - size) + costs[j - 1])
        total, before = packing.least_costs(cuts, costs)
        assert total == best
        ends = [0, *[places[k] for k in packing.walk_back(before, len(cuts))]]
        assert ends[-1] == cuts[-1] and all(0 < b - a <= 64 for a, b in zip(ends, ends[1:]))


def test_words_are_encoded_as_the_library_does():
    encoder = packing.Encoder(open(VOCABULARY, encoding="utf-8").read())
    words = [w for t in _texts() if t for w in t.encode().lower().split()]
    ids, counts = encoder.encode(pa.array(words, pa.binary()))
    tokenizer = _tokenizer()
    at = 0
    for word, count in zip(words, counts):
        assert ids[at : at + count].tolist() == tokenizer.encode(word.decode(), add_special_tokens=False).ids
        at += count
