import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from test_packing import _check  # noqa: E402
from test_simhash import brute_components, brute_fingerprint  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows():
    rng = random.Random(11)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop"}
    prose = lambda lang, n: " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 9))) + rng.choice(["", "", "."]) for _ in range(n))
    passage = {lang: prose(lang, 120) for lang in letters}
    texts = []
    for _ in range(150):
        lang = rng.choice("ab") * 2
        text = prose(lang, rng.randrange(20, 200))
        if rng.random() < 0.2:
            text += " é " + passage[lang] + " " + prose(lang, 10)
        texts.append((text, lang))
    long = prose("aa", 3000)
    texts += [texts[4], texts[4], texts[9], (None, None), ("", "aa"), ("123 !", "bb"), ("жшщ юяэ " * 60, None)]
    texts += [(long, "aa"), (long.replace(".", " .", 1), "aa"), (long + " x", "aa")]
    return [(i * 7, t, lang, "s", len(t or "")) for i, (t, lang) in enumerate(texts)]


def brute_cut(rows, length=400):
    """Texts by id without any string of ``length`` bytes that started before, by id and place."""
    seen: set[bytes] = set()
    result = {}
    for i, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            string = data[at : at + length]
            if string in seen:
                gone[at : at + length] = b"\x01" * length
            seen.add(string)
        result[i] = bytes(b for b, g in zip(data, gone) if not g).decode("utf-8", "ignore")
    return result


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.createDataFrame(_rows(), SCHEMA).repartition(3)
    tables = [docs]
    for name, step in corpus_pipeline.STAGES:
        path = str(folder / name)
        step(spark, tables[-1], str(folder)).write.parquet(path)
        tables.append(spark.read.parquet(path))
    docs.coalesce(1).write.parquet(str(folder / "documents.parquet"))
    return folder, tables


def _texts(table):
    return {r.doc_id: r.text for r in table.collect()}


def test_columns_and_order_of_stages(stages):
    _, tables = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "suffix_dedup", "packing"]
    assert all(t.columns == COLUMNS for t in tables[:-1])


def test_language_stage_drops_what_is_in_no_language(stages):
    _, tables = stages
    expected = {r[0] for r in _rows() if r[1] and "abcdefghijklmnop".find(r[1][0]) >= 0}
    assert set(_texts(tables[1])) == expected


def test_duplicate_stages_equal_brute_force(stages):
    _, tables = stages
    before, after = _texts(tables[1]), _texts(tables[2])
    assert after == {max(i for i, t in before.items() if t == text): text for text in before.values()}
    near = brute_components({i: brute_fingerprint(t) for i, t in after.items()})
    assert _texts(tables[3]) == {i: t for i, t in after.items() if near[i] == i}
    assert len(set(near.values())) < len(near)


def test_repeated_strings_are_cut_but_their_first_copy(stages):
    _, tables = stages
    before = _texts(tables[3])
    expected = brute_cut(list(before.items()))
    got = {r.doc_id: (r.text, r.n_chars) for r in tables[4].collect()}
    assert got == {i: (t, len(t)) for i, t in expected.items()}
    assert expected != before


def test_packing_covers_every_token(stages):
    _, tables = stages
    rows = tables[5].collect()
    # Small partitions: most of the padding is in their last windows.
    assert _check(rows, list(_texts(tables[4]).items())) < 0.05


def test_run_applies_all_stages(spark, stages):
    folder, tables = stages
    key = lambda r: (r.doc_id, r.start)
    tokens = lambda rows: {i: sum(r.length for r in rows if r.doc_id == i) for i in {r.doc_id for r in rows}}
    found = sorted(corpus_pipeline.run(spark, str(folder)).collect(), key=key)
    assert tokens(found) == tokens(tables[5].collect())


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, "").count() == 0


def test_texts_that_share_an_id_are_told_apart(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    copy, alone, passage = prose(30), prose(30), prose(90)
    rows = [(1, copy), (1, alone), (2, copy), (3, passage + " one"), (4, "two " + passage), (4, alone + " four"), (None, copy)]
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.drop_exact_copies(spark, docs, "")
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted((str(i), t) for i, t in rows if (i, t) != (1, copy))
    cut = {(r.doc_id, r.n_chars): r.text for r in corpus_pipeline.cut_repeated_strings(spark, kept, "").filter("doc_id >= 3").collect()}
    assert cut[(3, len(passage) + 4)] == passage + " one"
    assert (4, len(alone) + 5) in cut and cut[(4, len(alone) + 5)] == alone + " four"
    assert [t for (i, n), t in cut.items() if i == 4 and n < 60] == ["two "]


def test_passages_of_over_fifty_words_are_cut_but_their_first_copy(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 6))) for _ in range(n))
    passage = prose(52)
    assert corpus_pipeline.PASSAGE < len(passage) < 400
    rows = [(1, prose(40) + " " + passage), (2, passage + " " + prose(30)), (3, prose(9) + " " + passage + " " + prose(9)), (4, prose(200))]
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], SCHEMA)
    cut = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeated_strings(spark, docs, "").collect()}
    expected = brute_cut(rows, corpus_pipeline.PASSAGE)
    assert cut == {i: (t, len(t)) for i, t in expected.items()}
    assert [i for i, t in rows if passage in cut[i][0]] == [1] and cut[4][0] == rows[3][1]
