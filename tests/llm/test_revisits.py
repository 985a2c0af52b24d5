import random

from pyspark.sql import functions as F

from proofline.llm import revisits

SCHEMA = "record_id long, warc_type string, target_uri string, warc_date string, http_headers string, payload string"


def test_canonical_urls(spark):
    cases = {
        "HTTP://WWW.Example.com:80/A/b/#x": "example.com/A/b",
        "https://example.com/A/b?utm_source=f": "example.com/A/b",
        "https://example.com/A/b?x=1&utm_source=f&utm_x=2&y=2": "example.com/A/b?x=1&y=2",
        "example.com": "example.com",
        "": "",
    }
    frame = spark.createDataFrame([(k,) for k in [*cases, None]], "u string")
    got = {r.u: r.c for r in frame.select("u", revisits.canonical_url(F.col("u")).alias("c")).collect()}
    assert got == cases | {None: None}


def _block(code, *lines):
    return "\r\n".join([f"HTTP/1.1 {code} X", *lines])


def test_as_of_equals_brute_force(spark):
    rng = random.Random(4)
    full, later = [], []
    for i in range(400):
        row = (i, rng.choice("aaab"), rng.randrange(0, 60))
        (full if rng.random() < 0.3 else later).append(row)
    frame = lambda rows: spark.createDataFrame(rows, "record_id long, url string, at long").repartition(3)
    expected = {}
    for i, url, at in later:
        before = [(t, j) for j, u, t in full if u == url and (t, j) < (at, i)]
        expected[i] = max(before)[1] if before else None
    for seconds in (7, 1000):
        got = {r.record_id: r.original_id for r in revisits.as_of(frame(full), frame(later), seconds).collect()}
        assert got == expected


def test_outcomes_and_headers(spark):
    page = _block(200, "Date: one", 'ETag: "e"', "Last-Modified: m", "Content-Type: text/html", "Vary: a")
    rows = [
        (1, "response", "http://a/", "2024-01-01T00:00:00Z", page, "body"),
        (2, "revisit", "https://a", "2024-01-01T00:00:01Z", _block(304, "date: two", 'ETag: W/"e"', "Content-Type: none", "X: y"), None),
        (3, "revisit", "https://a", "2024-01-02T00:00:01Z", _block(304, 'ETag: "f"'), None),
        (4, "revisit", "https://a", "2024-01-02T00:00:01Z", _block(304, "Last-Modified: m"), None),
        (5, "revisit", "https://a", "2024-01-02T00:00:01Z", _block(304), None),
        (6, "revisit", "https://a", "2023-01-02T00:00:01Z", _block(304), None),
        (7, "revisit", None, "bad", _block(304), None),
        (8, None, "https://a", None, None, None),
        (9, "response", "https://a", "2024-01-01T12:00:00Z", _block(500, 'ETag: "f"'), "error"),
        (10, "revisit", "https://a", "bad", _block(304), None),
    ]
    records = spark.createDataFrame(rows, SCHEMA).withColumn("url", F.lit("clash"))
    got = {r.record_id: r for r in revisits.resolve(records).collect()}
    assert {i: (r.outcome, r.original_id, r.payload) for i, r in got.items()} == {
        2: ("resolved", 1, "body"),
        3: ("mismatch", 1, None),
        4: ("resolved", 1, "body"),
        5: ("unvalidated", 1, "body"),
        6: ("no_original", None, None),
        7: ("no_original", None, None),
        10: ("no_original", None, None),
    }
    assert [tuple(h) for h in got[2].headers] == [
        ("Last-Modified", "m"),
        ("Content-Type", "text/html"),
        ("Vary", "a"),
        ("date", "two"),
        ("ETag", 'W/"e"'),
    ]
    assert revisits.resolve(records.limit(0)).count() == 0
    assert revisits.resolve(records.union(records)).count() == 14


def test_an_original_with_many_revisits_and_a_repeated_one(spark, monkeypatch):
    monkeypatch.setattr(revisits, "SHARE", 4)
    page = lambda tag: _block(200, f'ETag: "{tag}"')
    rows = [(1, "response", "http://a/", "2024-01-01T00:00:00Z", page("e"), "hot"), (2, "response", "http://b/", "2024-01-01T00:00:00Z", page("f"), "twice")]
    rows += [rows[1], rows[1], (2, "response", None, "2024-01-01T00:00:00Z", page("g"), "nowhere")]
    rows += [(100 + i, "revisit", "http://a/", "2024-01-02T00:00:00Z", _block(304, 'ETag: "e"'), None) for i in range(50)]
    rows += [(200 + i, "revisit", "http://b/", "2024-01-02T00:00:00Z", _block(304, 'ETag: "f"'), None) for i in range(3)]
    rows += [(300 + i, "revisit", "http://c/", "2024-01-02T00:00:00Z", _block(304), None) for i in range(20)]
    found = revisits.resolve(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(found) == 73
    expected = {1: ("resolved", 1, "hot"), 2: ("resolved", 2, "twice"), 3: ("no_original", None, None)}
    assert all((r.outcome, r.original_id, r.payload) == expected[r.record_id // 100] for r in found)
