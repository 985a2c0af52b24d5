import datetime

import pytest

from proofline.operators import analyses

CLEAN = "event_date_utc date, level string, service string, error_type string"


def day(number):
    return datetime.date(2026, 7, number)


def clean(spark, *rows):
    return spark.createDataFrame(list(rows), CLEAN)


def tuples(frame):
    return [tuple(r) for r in frame.collect()]


def test_services_rank_by_count_then_name(spark):
    frame = clean(spark, *[(day(1), "ERROR", s, "X") for s in "bbaac"], (day(1), "INFO", "z", None))
    assert tuples(analyses.service_error_counts(frame).orderBy("rank")) == [(1, "a", 2), (2, "b", 2), (3, "c", 1)]
    assert tuples(analyses.service_error_counts(frame, "INFO")) == [(1, "z", 1)]
    assert tuples(analyses.service_error_counts(frame, "WARN")) == []


def test_ranks_of_many_services(spark):
    rows = [(day(1), "ERROR", f"s{i}", "X") for i in range(60) for _ in range(i % 7 + 1)]
    counts = sorted(((i % 7 + 1, f"s{i}") for i in range(60)), key=lambda c: (-c[0], c[1]))
    found = tuples(analyses.service_error_counts(clean(spark, *rows)).orderBy("rank"))
    assert found == [(k, s, n) for k, (n, s) in enumerate(counts, 1)]


def test_days_are_dense_and_flagged_above_twice_the_median(spark):
    rows = [(day(1), "ERROR", "a", "X")] * 2 + [(day(3), "ERROR", s, "X") for s in "bbba"] + [(day(4), "ERROR", "a", "X")]
    found = tuples(analyses.daily_error_counts(clean(spark, *rows)).orderBy("event_date_utc"))
    assert found == [
        (day(1), 2, 1.5, 2 / 1.5, False, ""),
        (day(2), 0, 1.5, 0.0, False, ""),
        (day(3), 4, 1.5, 4 / 1.5, True, "a:1;b:3"),
        (day(4), 1, 1.5, 1 / 1.5, False, ""),
    ]
    wide = tuples(analyses.daily_error_counts(clean(spark, *rows), day(1), day(7)).orderBy("event_date_utc"))
    assert [r[1] for r in wide] == [2, 0, 4, 1, 0, 0, 0] and wide[0][2:5] == (0.0, None, True)
    with pytest.raises(ValueError):
        analyses.daily_error_counts(clean(spark, *rows), day(1))


def test_tie_at_the_third_rank_and_unclassified_total(spark):
    types = ["B"] * 3 + ["A"] * 2 + ["D"] + ["C"] + ["UNCLASSIFIED_ERROR"]
    frame = clean(spark, *[(day(1), "ERROR", 's"1' if i % 2 else "s0", t) for i, t in enumerate(types)])
    found = tuples(analyses.top_error_types(frame).orderBy("rank"))
    assert [(r[0], r[1], r[2], r[4]) for r in found] == [(1, "B", 3, 1), (2, "A", 2, 1), (3, "C", 1, 1)]
    assert found[0][3] == '{"s\\"1":1,"s0":2}'
    none = analyses.top_error_types(clean(spark, (day(1), "ERROR", "s", "A")))
    assert tuples(none) == [(1, "A", 1, '{"s":1}', 0)]


def ledger(spark, *rows):
    schema = "source_line long, final_action string, issues array<struct<issue_code:string,action:string>>"
    return spark.createDataFrame(list(rows), schema)


def test_reconciliation(spark):
    book = ledger(
        spark,
        (1, "ACCEPT", [("U", "ACCEPT"), ("U", "ACCEPT")]),
        (2, "REPAIR", [("S", "REPAIR")]),
        (3, "REJECT", [("M", "REJECT"), ("U", "ACCEPT"), ("M", "REJECT")]),
    )
    kept = clean(spark, *[(day(1), "INFO", "a", None)] * 2)
    assert tuples(analyses.quality_reconciliation(book, kept)) == [
        ("record_total", None, "ACCEPT", 1, None, None),
        ("record_total", None, "REPAIR", 1, None, None),
        ("record_total", None, "REJECT", 1, None, None),
        ("issue_occurrence", "M", "REJECT", 1, 2, None),
        ("issue_occurrence", "S", "REPAIR", 1, 1, None),
        ("issue_occurrence", "U", "ACCEPT", 2, 3, None),
        ("conservation", None, "INPUT_EQUALS_ACTIONS", 3, 3, True),
        ("conservation", None, "ANALYTICAL_EQUALS_PARQUET", 2, 2, True),
    ]
    lost = tuples(analyses.quality_reconciliation(book, kept.limit(1)))
    assert lost[-1][3:] == (2, 1, False)
    empty = tuples(analyses.quality_reconciliation(book.limit(0), kept.limit(0)))
    assert [r[3] for r in empty] == [0, 0, 0, 0, 0] and empty[-1][5] is True


def test_report_without_an_unusual_day(spark):
    facts = analyses.report_facts(ledger(spark, (1, "ACCEPT", [])), clean(spark, (day(1), "ERROR", "a", "X")))
    sections = {r["section"] for r in facts.collect()}
    assert "unusual_day" not in sections and {"top_service", "quality", "unclassified"} <= sections


def test_registry(spark):
    with pytest.raises(ValueError, match="unknown analysis"):
        analyses.run_analysis("nope", None, None)
    frame = clean(spark, (day(1), "ERROR", "a", "X"))
    assert analyses.run_analysis("service-error-counts", ledger(spark), frame).count() == 1
