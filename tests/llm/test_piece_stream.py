import hashlib
import random
import zlib

import numpy as np
import pytest

from proofline.llm import piece_stream
from proofline.llm.piece_stream import SPACE, Encoder, Stream, Vocabulary

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _number(raw, at):
    value = shift = 0
    while True:
        value |= (raw[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if raw[at - 1] < 128:
            return value, at


def _highest_score_model():
    """The same vocabulary for the library's own search by score: field 3 of the file's field 2 is set to 1."""
    raw = open(PATH, "rb").read()
    out, at = b"", 0
    while at < len(raw):
        begin = at
        key, at = _number(raw, at)
        size, at = _number(raw, at)
        body, at = raw[at : at + size], at + size
        if key >> 3 == 2:
            kind = body.index(b"\x18\x02")
            changed = body[:kind] + b"\x18\x01" + body[kind + 2 :]
            out += raw[begin : at - size] + changed
        else:
            out += raw[begin:at]
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def brute(vocabulary, text):
    """Best segmentation of a whole text: scores of all prefixes."""
    if not text:
        return []
    text = SPACE + text.replace(" ", SPACE)
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - vocabulary.longest), end):
            piece = text[begin:end]
            score = vocabulary.scores.get(piece, vocabulary.unknown if end - begin == 1 else None)
            if score is not None and (best[end] is None or best[begin][0] + score > best[end][0]):
                best[end] = (best[begin][0] + score, begin)
    cuts = [len(text)]
    while cuts[-1]:
        cuts.append(best[cuts[-1]][1])
    cuts.reverse()
    return [i for b, e in zip(cuts, cuts[1:]) for i in vocabulary.spelled(text[b:e])]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(piece_stream.read_vocabulary(PATH))


def _texts():
    rng = random.Random(6)
    pool = ["the", "thing", "straße", "été", "日本", "x", "unglich", "Ñó", "😀", "...", "12", "\t", "ﬁ", "\x00", "<s>"]
    return ["".join(rng.choice(pool) + rng.choice([" ", "", "\n", "  "]) for _ in range(rng.randrange(0, 60))) for _ in range(150)]


@pytest.mark.parametrize("window", [64, 0])
def test_equals_brute_force(vocabulary, monkeypatch, window):
    monkeypatch.setattr(piece_stream, "WINDOW", window)
    encoder = Encoder(vocabulary)
    texts = [*_texts(), "", " ", "   a", "a   ", "\n\n", "a" * 300]
    ids, counts = encoder.encode(texts)
    at = 0
    for text, count in zip(texts, counts):
        assert ids[at : at + count].tolist() == brute(vocabulary, text), text
        at += count


def test_equals_the_library(vocabulary):
    model = _highest_score_model()
    encoder = Encoder(vocabulary)
    rng = random.Random(8)
    words = ["thing", "unglichkeit", "nation,", "été", "Ñoñomente", "Hello", "world."]
    for _ in range(100):
        # Single spaces and known characters, as the library adds 32-bit floats; and no word like "the", where
        # it takes the whole word (-13) although its two parts score higher (-2 and -6).
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))
        assert encoder.encode([text])[0].tolist() == model.encode(text)


def test_ids_are_committed_early_and_the_window_is_bounded(vocabulary):
    stream = Stream(vocabulary)
    rng = random.Random(1)
    text = SPACE + SPACE.join(rng.choice(["nation", "thing", "unglich", "été"]) for _ in range(500))
    got, longest = [], 0
    for character in text:
        got += stream.push(character)
        longest = max(longest, len(stream.text))
    assert longest < 4 * vocabulary.longest
    assert got + stream.finish() == brute(vocabulary, text[1:].replace(SPACE, " "))


def test_decoding(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = list(enumerate([*_texts(), "", None]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    encoded = piece_stream.encode(docs, PATH)
    got = {r.doc_id: r for r in encoded.collect()}
    short = {r.doc_id: r for r in piece_stream.digests(docs, PATH).collect()}
    for i, text in rows:
        assert bytes(got[i].decoded).decode() == (text or "")
        if "\x00" not in (text or ""):
            assert model.decode(got[i].ids) == (text or "")
        raw = np.array(got[i].ids, "<u4").tobytes()
        assert (short[i].n_ids, short[i].ids_crc32) == (len(got[i].ids), zlib.crc32(raw))
        assert short[i].n_bytes == len((text or "").encode())
        assert short[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert piece_stream.encode(docs.limit(0), PATH).count() == 0


@pytest.mark.parametrize("window", [64, 0])
def test_ids_equal_the_unpatched_library(spark, monkeypatch, window):
    monkeypatch.setattr(piece_stream, "WINDOW", window)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    more = ["the language of the nation", "", " ", "   a", "a   ", "a" * 300, "日本語の文" * 40, "hyphen-ated_words/" * 20, "ab\n\n cd\r\n"]
    texts = [*_texts(), *more]
    ids, counts = Encoder(Vocabulary(piece_stream.read_vocabulary(PATH)), by_rank=True).encode(texts)
    ends = np.cumsum(counts)
    for text, found in zip(texts, np.split(ids, ends[:-1])):
        assert found.tolist() == model.encode(text), text
    docs = spark.createDataFrame(list(enumerate(more)), "doc_id long, text string")
    assert {r.doc_id: list(r.ids) for r in piece_stream.encode(docs, PATH).collect()} == dict(enumerate(map(model.encode, more)))


def test_both_ways_of_merging_agree_and_old_parts_are_forgotten(vocabulary, monkeypatch):
    rng = random.Random(12)
    for _ in range(3000):
        part = "".join(rng.choice("▁aeinstho日é") for _ in range(rng.randrange(1, piece_stream.SHORT + 1)))
        assert piece_stream.merge(vocabulary, part) == piece_stream.merge_long(vocabulary, part)
    monkeypatch.setattr(piece_stream, "KNOWN_PARTS", 40)
    encoder, fresh = Encoder(vocabulary, by_rank=True), Encoder(vocabulary, by_rank=True)
    for text in _texts():
        fresh.forget()
        assert encoder.encode([text])[0].tolist() == fresh.encode([text])[0].tolist()
    assert len(encoder.places) < 200


def test_other_kinds_of_files_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    stored = sentencepiece_model_pb2.ModelProto.FromString(open(PATH, "rb").read())
    stored.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(stored.SerializeToString())
    with pytest.raises(ValueError, match="normalizes"):
        piece_stream.read_vocabulary(str(tmp_path / "other.model"))
