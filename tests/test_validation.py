import hashlib
import json

from pyspark.sql import functions as F

from proofline.functions import strict_json
from proofline.functions.text import quote_json
from proofline.operators import duplicates, ledger, validation
from proofline.operators.duplicates import resolve_duplicates
from proofline.plans import log_quality
from proofline.sources.lines import from_table

VALID = {
    "timestamp": "2026-07-27T00:02:47Z",
    "service": "notification-worker",
    "level": "INFO",
    "message": "Heartbeat ok",
    "request_id": "req-1",
}


def source(spark, *texts):
    rows = [(i + 1, t if isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return from_table(spark.createDataFrame(rows, "source_line long, raw_line string"), "log.jsonl")


def ledger_rows(spark, *texts):
    return ledger.quality_ledger(source(spark, *texts)).orderBy("source_line").collect()


def codes(row):
    return [i["issue_code"] for i in row["issues"]]


def test_strict_json(spark):
    texts = [
        '{"timestamp": "broken',
        "",
        '{"a":1} trailing',
        '{"a":NaN}',
        '{"a":-Infinity}',
        "﻿{}",
        '{"a":1e400}',
        r'{"a":"\ud800"}',
        "[" * 20000,
        "[1,2]",
        '"text"',
        "null",
        "01",
    ]
    rows = ledger_rows(spark, *texts)
    assert [codes(r) for r in rows] == [["JSON_MALFORMED"]] * 9 + [["JSON_NOT_OBJECT"]] * 3 + [["JSON_MALFORMED"]]
    assert rows[0]["issues"][0]["original_value"] == json.dumps(texts[0])
    assert rows[9]["issues"][0]["original_value"] == "[1,2]"
    assert all(r["record_digest"] is None and r["final_action"] == "REJECT" for r in rows)


def test_several_issues_in_fixed_order(spark):
    record = {**VALID, "timestamp": "2026-07-27T00:02:47", "service": "", "level": "DEBUG", "message": 7,
              "request_id": None, "trace_id": "", "b": [1.0, 1], "a": {"y": 1, "x": "é"}}
    row = ledger_rows(spark, record)[0]
    assert [(i["issue_code"], i["field"], i["original_value"]) for i in row["issues"]] == [
        ("REQUIRED_FIELD_EMPTY", "service", '""'),
        ("REQUIRED_FIELD_TYPE", "message", "7"),
        ("REQUIRED_FIELD_MISSING", "request_id", None),
        ("TIMESTAMP_OFFSET_MISSING", "timestamp", '"2026-07-27T00:02:47"'),
        ("LEVEL_UNKNOWN", "level", '"DEBUG"'),
        ("TRACE_ID_TYPE", "trace_id", '""'),
        ("UNEXPECTED_FIELD", "a", '{"x":"é","y":1}'),
        ("UNEXPECTED_FIELD", "b", "[1.0,1]"),
    ]
    assert row["final_action"] == "REJECT"
    for issue in row["issues"]:
        assert issue["action"] == validation.ISSUE_CATALOG[issue["issue_code"]][0]
        assert issue["reason"] == validation.ISSUE_CATALOG[issue["issue_code"]][1]


def test_extra_fields_are_accepted_and_digest_ignores_order_and_spacing(spark):
    record = {**VALID, "service": "future-service", "trace_id": "t", "deployment": "canary"}
    text = json.dumps(dict(reversed(record.items())), indent=None, separators=(" , ", " : "))
    first, second, third = ledger_rows(spark, record, text, {**record, "deployment": 1.0})
    assert codes(first) == ["UNEXPECTED_FIELD"] and first["final_action"] == "ACCEPT"
    canonical = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert first["record_digest"] == hashlib.sha256(canonical.encode()).hexdigest() == second["record_digest"]
    assert codes(second)[-1] == "EXACT_DUPLICATE" and second["retained_source_line"] == 1
    assert third["final_action"] == "ACCEPT"


def test_repeated_keys_keep_the_last(spark):
    text = json.dumps(VALID)[:-1] + ',"level":"ERROR"}'
    assert ledger.clean_records(source(spark, text)).first()["level"] == "ERROR"


def test_duplicates_point_to_the_first_retained_line(spark):
    invalid = {**VALID, "level": "DEBUG"}
    rows = ledger_rows(spark, invalid, VALID, invalid, VALID, VALID)
    assert [r["final_action"] for r in rows] == ["REJECT", "ACCEPT", "REJECT", "REJECT", "REJECT"]
    assert [r["retained_source_line"] for r in rows] == [None, 2, None, 2, 2]
    assert codes(rows[0]) == codes(rows[2]) == ["LEVEL_UNKNOWN"]
    duplicate = rows[3]["issues"][-1]
    assert json.loads(duplicate["original_value"]) == rows[3]["record_digest"]
    assert duplicate["normalized_value"] == "2"


def test_a_digest_held_by_most_rows(spark):
    texts = [VALID if i % 3 else {**VALID, "request_id": f"r{i}"} for i in range(3000)]
    checked = validation.check_lines(source(spark, *texts).lines)
    expected = None
    for parts in (1, 13):
        rows = resolve_duplicates(checked.repartition(parts)).groupBy("final_action", "retained_source_line").count()
        found = sorted(map(tuple, rows.collect()))
        assert expected in (None, found)
        expected = found
        assert ("REJECT", 2, 1999) in found and ("ACCEPT", 2, 1) in found
    clean = ledger.clean_records(source(spark, *texts))
    assert clean.count() == 1001 and clean.agg(F.min("source_line")).first()[0] == 1


def test_records_of_earlier_batches_come_first(spark):
    checked = validation.check_lines(source(spark, VALID, VALID, {**VALID, "request_id": "new"}).lines)
    digest = checked.filter("source_line = 1").first()["record_digest"]
    retained = spark.createDataFrame([(digest, (5 << 36) + 77)], "record_digest string, retained_seq long")
    rows = resolve_duplicates(checked, retained).orderBy("source_line").collect()
    assert [r["final_action"] for r in rows] == ["REJECT", "REJECT", "ACCEPT"]
    assert [(r["retained_file_no"], r["retained_source_line"]) for r in rows] == [(5, 77), (5, 77), (0, 3)]


def test_reject_beats_repair(spark):
    for found, action in ((["SYNTHETIC_REPAIR"], "REPAIR"), (["SYNTHETIC_REPAIR", "TRACE_ID_TYPE"], "REJECT"), ([], "ACCEPT")):
        issues = F.array(*[validation.issue(c) for c in found]) if found else F.expr(
            "cast(array() as array<struct<action:string>>)"
        )
        assert spark.range(1).select(validation.final_action(issues)).first()[0] == action


def test_ledger_and_clean_records_agree(spark):
    texts = [{**VALID, "message": f"m{i % 40}", "level": ["INFO", "ERROR"][i % 2]} for i in range(200)] + ["{", "[]"]
    lines = source(spark, *texts)
    book, clean = ledger.quality_ledger(lines), ledger.clean_records(lines)
    kept = {r["source_line"] for r in book.filter("final_action = 'ACCEPT'").collect()}
    assert kept == {r["source_line"] for r in clean.collect()}
    row = ledger.row_conservation(book, clean).first()
    assert row["input_equals_actions"] and row["analytical_equals_clean"] and row["input_lines"] == 202
    ledger.require_conservation(book, clean)
    assert all(r["holds"] for r in ledger.schema_contract(clean).collect())


def test_trace_of_lines(spark):
    lines = source(spark, VALID, "{", {**VALID, "level": "ERROR", "message": "ERR NullPointer"})
    book, clean = ledger.quality_ledger(lines), ledger.clean_records(lines)
    row = ledger.trace_line(book, clean, 3).first()
    assert (row["error_type"], row["service_error_count"]) == ("NULL_POINTER", 1)
    for bad in (0, 2, 9):
        try:
            ledger.trace_line(book, clean, bad)
        except ValueError:
            continue
        raise AssertionError(f"line {bad} was traced")


def test_rows_are_not_shuffled_for_a_short_list_of_copies(spark, tmp_path, monkeypatch):
    texts = [dict(VALID, request_id=f"r{i % 3}") for i in range(8)]
    plans, write = [], log_quality.write_ledger
    monkeypatch.setattr(log_quality, "write_ledger", lambda frame, path: (plans.append(frame._jdf.queryExecution().executedPlan().toString()), write(frame, path)))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        run = log_quality.publish(source(spark, *texts), str(tmp_path / "short"))
        monkeypatch.setattr(duplicates, "fits_broadcast", lambda *a, **k: False)
        long = log_quality.publish(source(spark, *texts), str(tmp_path / "long"))
    finally:
        spark.conf.set(threshold, before)
    joins = ["hashpartitioning(copy_key" in p for p in plans]
    assert joins == [False, True]
    shown = lambda r: r.ledger.orderBy("source_line").collect()
    assert shown(run) == shown(long) and run.clean.count() == long.clean.count() == 3


def test_canonical_text_of_strings_is_that_of_the_encoder():
    parser = strict_json._Parser(["a"], False, False)
    for value in ({}, {"b": "", "a": "\n\u0001\u007f\u2028é\"\\/"}, {"é": "x", "": "y"}, {"a": "x", "b": 1}, {"a": {"b": "c"}}):
        text = json.dumps(value)
        for spaced in (text, f" {text}\n"):
            assert parser.parse(spaced) == (strict_json.OBJECT, parser.encode(value), value)
    assert parser.parse('{"a":"b"}x')[0] == parser.parse('{"a":"\\ud800"}')[0] == parser.parse("")[0] == strict_json.MALFORMED


def test_quoted_text_is_json(spark):
    texts = ["", "plain [text]", "a/b~ ", 'q"', "b\\", "\x7f", "é", "tab\t", "\x1f", "[]", "]", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.q for r in rows.select("i", quote_json(F.col("t")).alias("q")).orderBy("i").collect()]
    assert got[:-1] == [json.dumps(t, ensure_ascii=False) for t in texts[:-1]]
