import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from proofline.llm import periodic_runs, queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of all runs: every period by comparing all words."""
    codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    n = len(words)
    found: dict[tuple[int, int], int] = {}
    for p in range(1, n // 3 + 1):
        equal = np.r_[0, (codes[:-p] == codes[p:]).astype(int), 0]
        begins = np.flatnonzero(np.diff(equal) == 1)
        ends = np.flatnonzero(np.diff(equal) == -1)
        for b, e in zip(begins.tolist(), ends.tolist()):
            if e - b >= p:
                found.setdefault((b, e - b + p), p)
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(24, 3 * q))


def brute_tail(doc_id: int | None, words: list[str]) -> list[str]:
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_row(doc_id: int | None, text: str | None) -> tuple:
    words = brute_tail(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2] or (run[1] * best[2] == best[1] * run[2] and (run[0], run[2]) < (best[0], best[2])):
            best = run
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    expected = {r.doc_id: brute_row(r.doc_id, r.text) for r in rows}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, FOLDER).collect()}
    assert got == expected
    assert sum(r[0] > 0 for r in expected.values()) > 10


def _texts() -> list[str | None]:
    rng = random.Random(11)
    texts: list[str | None] = []
    for _ in range(150):
        words: list[str] = []
        for _ in range(rng.randrange(1, 6)):
            period = [rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 13, 14, 26, 40]))]
            loop = period * rng.randrange(1, 12)
            words += loop[: len(loop) - rng.randrange(len(period))]
            words += [rng.choice("abc") for _ in range(rng.randrange(0, 4))]
        texts.append(rng.choice([" ", "\n", "  ", "\t"]).join(words))
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 700:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    square_free = "".join("abc"[bin(i).count("1") % 3] for i in range(600))
    texts += [" ".join(fibonacci[-1]), " ".join(square_free), "w " * 23, "w " * 24, "w " * 25, "é\x85 " * 3000, "a b " * 12, "a b " * 11 + "a"]
    texts += [" ".join(f"w{i % 997}" for i in range(997 * 3 + k)) for k in (-1, 0, 1)]
    return [*texts, "", None, " \n ", "one", " ".join(f"u{i}" for i in range(5000))]


@pytest.mark.parametrize(("points", "piece"), [(1 << 19, 1 << 22), (64, 300)])
def test_runs_equal_brute_force(spark, monkeypatch, points, piece):
    monkeypatch.setattr(periodic_runs, "POINTS", points)
    texts = _texts()
    for text in texts if points == 64 else []:
        words = WORD.findall(text or "")
        codes = np.unique(np.array(words or [""]), return_inverse=True)[1][: len(words)]
        _, start, length, period = periodic_runs.runs_of_texts(codes, np.array([0, len(words)]))
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == brute_runs(words)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'x' as runs", "1 as best")
    for r in periodic_runs.periodic_runs(docs.repartition(3)).collect():
        words = WORD.findall(texts[r.doc_id] or "")
        runs = brute_runs(words)
        assert [tuple(x) for x in r.runs] == runs and r.n_runs == len(runs)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed_text == " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_extensions_equal_comparison():
    rng = np.random.default_rng(3)
    for size, letters in ((1, 1), (5, 1), (60, 1), (300, 2), (500, 3), (400, 400)):
        codes = rng.integers(0, letters, size)
        codes[size // 2 :] = codes[: size - size // 2]
        extensions = periodic_runs.Extensions(codes, size)
        first, second = (c.ravel() for c in np.triu_indices(size, 1))
        got = extensions.query(first, second)
        for i, j, n in zip(first.tolist(), second.tolist(), got.tolist()):
            assert n == next((k for k in range(size - j) if codes[i + k] != codes[j + k]), size - j)


def test_looped_tails_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(90))
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(i, text) for i in ids] + [(ids[0], text), (None, text), (ids[1], None), (ids[2], " "), (-7, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    looped = docs.select("doc_id", periodic_runs.looped_tails(docs.text, docs.doc_id).alias("text"))
    found = periodic_runs.periodic_runs(looped).collect()
    assert len(found) == len(rows)
    expected = sorted((str(i), brute_row(i, t)[0], brute_row(i, t)[-2]) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_runs, r.runs_sha256) for r in found) == expected
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
