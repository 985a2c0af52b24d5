import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from proofline.llm import language_id
from proofline.llm.language_id import _START, ORDER, packed, score_texts, train, unit_table, units_of

LETTERS = {"aa": "abcde", "bb": "cdefg", "cc": "xyzäö"}


def _text(rng, lang, words=40):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(1, 8))) for _ in range(words))


def _model(texts: dict[str, list[str]]):
    table = unit_table()
    runs = {}
    for lang, own in texts.items():
        _, keys = packed(units_of(own, table))
        runs[lang] = np.unique(keys, return_counts=True)
    return train(sorted(texts), runs), table


def brute(texts: list[str], alphabet: int, table):
    """Interpolated Kneser-Ney with dictionaries; returns ``p(unit | context)``."""
    counts = Counter()
    for text in texts:
        units = [_START] * (ORDER - 1) + [u for u in units_of([text], table).tolist() if u != _START]
        counts.update(tuple(units[i - ORDER + 1 : i + 1]) for i in range(ORDER - 1, len(units)))
    levels = [counts]
    for _ in range(ORDER - 1):
        levels.insert(0, Counter(gram[1:] for gram in levels[0]))

    def p(context: tuple, unit: int) -> float:
        order = len(context)
        level = levels[order]
        once, twice = (sum(1 for n in level.values() if n == k) for k in (1, 2))
        discount = once / (once + 2 * twice) if once and twice else 0.5
        below = p(context[1:], unit) if order else 1 / alphabet
        own = {g: n for g, n in level.items() if g[:-1] == context}
        total = sum(own.values())
        if not total:
            return below
        return max(level.get((*context, unit), discount) - discount, 0) / total + discount * len(own) / total * below

    return p


def test_scores_equal_brute_force():
    rng = random.Random(1)
    texts = {lang: [_text(rng, lang, 12) for _ in range(3)] for lang in ("aa", "bb")}
    model, table = _model(texts)
    alphabet = len({u for own in texts.values() for u in units_of(own, table).tolist() if u != _START}) + 1
    tested = "abc fgc, ädé cde abc"
    units = [_START] * (ORDER - 1) + [u for u in units_of([tested], table).tolist() if u != _START]
    sums, counts = score_texts(model, [tested], table)
    assert counts[0] == len(units) - ORDER + 1
    for column, lang in enumerate(sorted(texts)):
        p = brute(texts[lang], alphabet, table)
        expected = sum(math.log(p(tuple(units[i - ORDER + 1 : i]), units[i])) for i in range(ORDER - 1, len(units)))
        assert abs(sums[0, column] - expected) < 0.02 * len(units)
        # A distribution: all known units and the share of the unknown ones.
        known = {u for own in texts.values() for u in units_of(own, table).tolist() if u != _START}
        assert abs(sum(p((97, 98, 99), u) for u in known) + p((97, 98, 99), -1) - 1) < 1e-9


def _docs(spark, count=240):
    rng = random.Random(3)
    rows = [(i, _text(rng, (lang := rng.choice(sorted(LETTERS)))), lang) for i in range(count)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_held_out_texts_and_odd_input(spark):
    docs = _docs(spark)
    odd = spark.createDataFrame(
        [(1000, None, None), (1001, "", "aa"), (1002, "12 #!", "bb"), (1003, "жшщ юяэ " * 40, None), (None, "abab ab", "aa"), (1004, "abcab " * 50_000, None)],
        docs.schema,
    )
    docs = docs.union(odd).withColumn("score", F.lit("clash"))
    fitted = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, fitted).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.lang for r in docs.filter("doc_id < 1000").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 50 and all(got[i].lang_pred == truth[i] and not got[i].rejected for i in held)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [(got[i].lang_pred, got[i].rejected) for i in (1000, 1001, 1002)] == [("und", True)] * 3
    assert got[1003].rejected and got[1003].lang_pred in LETTERS
    assert got[1004].lang_pred == "aa"
    kept = language_id.accepted(docs, fitted)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = _docs(spark, 90)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    changed = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang")))
    ordered = lambda d: language_id.identify(d, language_id.fit(d)).orderBy("doc_id").collect()
    assert ordered(docs) == ordered(changed)


def test_empty_tables_and_bounds(spark):
    docs = _docs(spark, 30)
    none = docs.limit(0)
    assert language_id.fit(none) is None and language_id.identify(none, None).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.accepted(docs, None).count() == 0
    many = docs.withColumn("lang", F.col("doc_id").cast("string"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(language_id, "MAX_LANGUAGES", 3)
        with pytest.raises(ValueError, match="languages"):
            language_id.fit(many)


@pytest.mark.parametrize("chunk", [1 << 23, 500])
def test_a_model_that_is_not_sent_gives_the_same_results(spark, monkeypatch, chunk):
    monkeypatch.setattr(language_id, "CHUNK", chunk)
    odd = [(1000, None, None), (1001, "", "aa"), (1002, "12 #!", "bb"), (1003, "жшщ юяэ " * 40, None), (1004, "abcab " * 3000, None)]
    docs = _docs(spark).union(spark.createDataFrame(odd, "doc_id long, text string, lang string")).withColumn("chunk", F.lit("clash"))
    sent, apart = language_id.fit(docs), language_id.fit(docs, together=0)
    assert isinstance(sent.model, language_id.Model) and isinstance(apart.model, language_id.Spread)
    assert apart.temperature == sent.temperature
    assert np.allclose(apart.centre, sent.centre, atol=1e-5) and np.allclose(apart.bound, sent.bound, atol=1e-3)
    one, two = ({r.doc_id: r for r in language_id.identify(docs, fitted).collect()} for fitted in (sent, apart))
    assert one.keys() == two.keys() and len(one) == docs.count()
    for i, r in one.items():
        assert (r.lang_pred, r.rejected) == (two[i].lang_pred, two[i].rejected)
        assert np.allclose([r.score, r.cross_entropy or 0.0], [two[i].score, two[i].cross_entropy or 0.0], atol=1e-4)
    kept = [sorted(map(tuple, language_id.accepted(docs, fitted).collect())) for fitted in (sent, apart)]
    assert kept[0] == kept[1] and kept[0]


def test_every_run_of_a_varied_language_is_in_the_model(spark):
    # More runs than 2^18 and most of them once: cut by count, nothing of this language would be left.
    rng = random.Random(9)
    signs = [chr(c) for c in range(0x4E00, 0x9FA5)]
    rows = [(i, "".join(rng.choices(signs, k=4000)), "zz") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").union(_docs(spark).selectExpr("doc_id + 1000", "text", "lang"))
    fitted = language_id.fit(docs)
    got = language_id.identify(docs, fitted).filter("doc_id < 1000").collect()
    assert {r.lang_pred for r in got} == {"zz"}
    learns, calibrates = language_id.learning_rows(docs, "doc_id", "lang")
    counted = docs.filter(learns & ~calibrates)
    runs = language_id.count_runs(counted.select("lang", "text")).select("key").distinct().count()
    assert runs > 1 << 18 and len(fitted.model.runs[-1].hashes) == runs
