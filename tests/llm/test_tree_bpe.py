import hashlib
import random

import numpy as np
import pytest

from proofline.llm import queries, tree_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _texts() -> list[str | None]:
    rng = random.Random(7)
    words = (
        "The Thé straße naïve it's IT'S don't ''s 'step x's't 5's y'all've l'été x_y 12,5 «non» … İstanbul É È ÀÖØÞ × ÷ été œuvre 日本語 😀 a.b "
        "<|endoftext|> a<|startoftext|>b <|endoftext|><|endoftext|> <|end \x1c end. what?! ŉ ſ Σας éte ́ ١٢ 'ſ a\x00b"
    ).split(" ")
    texts: list[str | None] = [
        "".join(rng.choice(words) + rng.choice(["", " ", ".", ",", "\n", "  ", "\t", "\x85", "\xa0", "'"]) for _ in range(rng.randrange(0, 400)))
        for _ in range(150)
    ]
    # Unsplit text: letters, marks and repeated letters without any place to cut.
    texts += ["".join(rng.choice("abcdehinorst") for _ in range(n)) for n in (511, 512, 513, 1024, 5000, 40_000)]
    texts += ["a" * 9001, "ha" * 4000, "!" * 3001, "é" * 3000, "international" * 700, "日本" * 900, "7" * 2000, "'" * 1500, "'s" * 1200]
    return [*texts, "", None, " \n ", "'", "<|endoftext|>", "word " * 9000]


def test_ids_and_decoded_texts_equal_the_library(spark):
    texts = list(enumerate(_texts()))
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumnRenamed("text", "body")
    docs = docs.selectExpr("doc_id", "body", "'x' as ids", "1 as decoded", "doc_id as text").repartition(3)
    found = {r.doc_id: r for r in tree_bpe.encode(docs, VOCABULARY, text_column="body").collect()}
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert len(found) == len(texts)
    for i, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert found[i].ids == ids, text
        assert found[i].decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = {}
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False).encode()
        marks = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected[r.doc_id] = (len(ids), marks, hashlib.sha256(decoded).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op12_tree_bpe(spark, FOLDER).collect()}
    assert got == expected


@pytest.mark.parametrize(("leaf", "edge"), [(1, 1), (2, 1), (7, 1), (64, 3)])
def test_any_cut_gives_the_same_ids(monkeypatch, leaf, edge):
    monkeypatch.setattr(tree_bpe, "LEAF", leaf)
    monkeypatch.setattr(tree_bpe, "EDGE", edge)
    coder = tree_bpe.Coder(open(VOCABULARY, encoding="utf-8").read())
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [(t or "")[:600] for t in _texts()[::7]]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, ends = coder.encode(*coder.symbols(data, np.r_[0, np.cumsum([len(r) for r in raw])]))
    for text, b, e in zip(texts, ends[:-1], ends[1:]):
        assert ids[b:e].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_windows_grow_until_both_sides_agree(monkeypatch):
    """Random merges over two letters: the merges of a side often reach far back."""
    coder = tree_bpe.Coder(open(VOCABULARY, encoding="utf-8").read())
    rng = random.Random(2)
    for _ in range(60):
        symbols, merges = ["a", "b"], []
        while len(merges) < 12:
            pair = (rng.choice(symbols), rng.choice(symbols))
            if pair not in merges and len("".join(pair)) <= 9:
                merges.append(pair)
                symbols.append("".join(pair))
        vocabulary = {s: i for i, s in enumerate(dict.fromkeys(symbols))}
        coder.model = tree_bpe.models.BPE(vocab=vocabulary, merges=merges, cache_capacity=0)
        coder.lengths = np.array([len(s) for s in vocabulary])
        text = "".join(rng.choice("ab") for _ in range(200)) + "a" * rng.randrange(30)
        at = rng.randrange(1, len(text))
        joined = coder.join(text, coder._ids(text[:at]), coder._ids(text[at:]), at)
        assert joined.tolist() == coder._ids(text).tolist()


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, None)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_tokens) for r in tree_bpe.digests(docs, VOCABULARY).collect())
    assert found == [(0, 2), (1, 2), (1, 2), (2, 0)]
    assert tree_bpe.digests(docs.limit(0), VOCABULARY).count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        tree_bpe.Coder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
