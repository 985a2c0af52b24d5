import json

import pytest
from pyspark.sql import functions as F

from proofline.operators import history
from proofline.operators.history import DigestHistory
from proofline.plans import log_quality
from proofline.sources import lines
from proofline.streaming import daily


def record(number, day=27, **extra):
    return json.dumps(
        {"timestamp": f"2026-07-{day}T00:00:00Z", "service": "s", "level": "INFO", "message": "m", "request_id": str(number), **extra}
    )


def actions(tables, spark):
    ledger = tables.read(spark, "ledger")
    rows = ledger.select(F.regexp_extract("source_path", "([^/]+)$", 1).alias("f"), "source_line", "final_action", "retained_source_line", "batch_id")
    return sorted(tuple(r) for r in rows.collect())


def test_runs_take_only_what_is_new_and_replays_change_nothing(spark, tmp_path):
    incoming, tables = tmp_path / "in", daily.DailyTables(str(tmp_path / "out"))
    incoming.mkdir()
    (incoming / "day1.jsonl").write_text("\n".join([record(1), record(2), record(1), "{"]) + "\n")
    assert daily.run_available(spark, str(incoming), tables) == 1
    (incoming / "day2.jsonl").write_text("\n".join([record(3, 28), record(2), record(3, 28)]))
    assert daily.run_available(spark, str(incoming), tables) == 1
    assert daily.run_available(spark, str(incoming), tables) == 0
    expected = [
        ("day1.jsonl", 1, "ACCEPT", 1, 0),
        ("day1.jsonl", 2, "ACCEPT", 2, 0),
        ("day1.jsonl", 3, "REJECT", 1, 0),
        ("day1.jsonl", 4, "REJECT", None, 0),
        ("day2.jsonl", 1, "ACCEPT", 1, 1),
        ("day2.jsonl", 2, "REJECT", 2, 1),
        ("day2.jsonl", 3, "REJECT", 1, 1),
    ]
    assert actions(tables, spark) == expected
    row = tables.read(spark, "ledger").filter("batch_id = 1 and source_line = 2").first()
    assert (row["file_no"], row["retained_file_no"]) == (1, 0)
    assert row["issues"][-1]["issue_code"] == "EXACT_DUPLICATE"
    # A failed run repeats its last batch: same files, same number.
    for number, name in ((0, "day1.jsonl"), (1, "day2.jsonl")):
        daily.ingest_batch(lines.scan_text(spark, str(incoming / name)), number, tables)
    assert actions(tables, spark) == expected
    curated = tables.read(spark, "curated")
    assert {str(r[0]): r[1] for r in curated.groupBy("event_date_utc").count().collect()} == {"2026-07-27": 2, "2026-07-28": 1}
    assert tables.read(spark, "quarantine").count() == 4


def test_publish_writes_tables_that_reconcile(spark, tmp_path):
    texts = [(i + 1, record(i % 30, 20 + i % 5)) for i in range(100)] + [(101, "[]")]
    source = lines.from_table(spark.createDataFrame(texts, "source_line long, raw_line string"), "x.jsonl")
    published = log_quality.publish(source, str(tmp_path / "p"))
    assert published.ledger.count() == 101 and published.clean.count() == 30
    assert {p.name for p in (tmp_path / "p" / "clean").glob("event_date_utc=*")} == {f"event_date_utc=2026-07-{d}" for d in range(20, 25)}


def test_a_replayed_batch_leaves_other_days_untouched_and_the_table_is_read_by_name(spark, tmp_path):
    incoming, tables = tmp_path / "in", daily.DailyTables(str(tmp_path / "out"), "curated_for_test")
    incoming.mkdir()
    (incoming / "day1.jsonl").write_text("\n".join([record(1), record(2), record(9, 28)]))
    daily.run_available(spark, str(incoming), tables)
    (incoming / "day2.jsonl").write_text("\n".join([record(3, 28), record(4, 29)]))
    daily.run_available(spark, str(incoming), tables)
    counts = lambda: {(str(r[0]), r[1]): r[2] for r in spark.table("curated_for_test").groupBy("event_date_utc", "batch_id").count().collect()}
    expected = {("2026-07-27", 0): 2, ("2026-07-28", 0): 1, ("2026-07-28", 1): 1, ("2026-07-29", 1): 1}
    assert counts() == expected
    parts = {r[0] for r in spark.sql("SHOW PARTITIONS curated_for_test").collect()}
    assert parts == {f"event_date_utc={d}/batch_id={b}" for d, b in expected}
    files = lambda: {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "out" / "curated").rglob("*.parquet")}
    before = files()
    daily.ingest_batch(lines.scan_text(spark, str(incoming / "day2.jsonl")), 1, tables)
    after = files()
    untouched = {p for p in before if "batch_id=0" in p}
    assert untouched and all(after[p] == before[p] for p in untouched)
    assert not {p for p in after if "batch_id=1" in p} & set(before)
    assert counts() == expected
    # Another session has an empty catalog: the partitions are found again.
    spark.sql("DROP TABLE curated_for_test")
    daily.register_curated(spark, spark.read.parquet(tables.path("curated")).schema, tables)
    assert counts() == expected
    # What only the steps of a batch read is gone.
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["checked", "checkpoint", "copies", "curated", "digests", "files", "ledger", "quarantine", "resolved", "scan", "splits"]
    assert not list((tmp_path / "out" / "checked").glob("batch_id=*"))
    spark.sql("DROP TABLE curated_for_test")


def test_a_lost_row_stops_the_publication(spark, tmp_path, monkeypatch):
    texts = [(i + 1, record(i % 30, 20 + i % 5)) for i in range(100)]
    source = lines.from_table(spark.createDataFrame(texts, "source_line long, raw_line string"), "x.jsonl")
    whole = log_quality.clean_from_checked
    monkeypatch.setattr(log_quality, "clean_from_checked", lambda *a: whole(*a).filter("source_line <> 7"))
    with pytest.raises(ValueError, match="row conservation failed"):
        log_quality.publish(source, str(tmp_path / "a"))
    monkeypatch.setattr(log_quality, "clean_from_checked", whole)
    book = log_quality.ledger_from_resolved
    monkeypatch.setattr(log_quality, "ledger_from_resolved", lambda *a: book(*a).unionByName(book(*a).limit(1)))
    with pytest.raises(ValueError, match="row conservation failed"):
        log_quality.publish(source, str(tmp_path / "b"))


def test_history_reads_only_the_prefixes_of_a_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "MAX_PAGES", 2)
    digests = DigestHistory(str(tmp_path / "digests"))
    assert digests.matching(spark, 1, spark.createDataFrame([("a",)], "record_digest string")).count() == 0
    rows = spark.range(20_000).selectExpr("sha2(cast(id as string), 256) as record_digest", "id as retained_seq")
    digests.append(1, rows.filter("retained_seq % 2 = 0"))
    digests.append(2, rows.filter("retained_seq % 2 = 1"))
    digests.append(2, rows.filter("retained_seq % 2 = 1"))
    assert digests.before(spark, 3).count() == 20_000 and digests.before(spark, 2).count() == 10_000
    asked = rows.filter("retained_seq < 2000").select("record_digest").unionByName(spark.createDataFrame([("zz",), (None,)], "record_digest string"))
    found = digests.matching(spark, 2, asked)
    wanted = {r[0] for r in rows.filter("retained_seq < 2000 and retained_seq % 2 = 0").select("retained_seq").collect()}
    got = [r["retained_seq"] for r in found.collect()]
    # All that are there, and few others.
    assert wanted <= set(got) and len(got) == len(set(got)) < len(wanted) + 1500
    few = rows.filter("record_digest like 'a%' and retained_seq < 200").select("record_digest")
    plan = digests.matching(spark, 3, few)._jdf.queryExecution().executedPlan().toString()
    assert "(prefix#" in plan.split("PartitionFilters")[1] and "= a)" in plan.split("PartitionFilters")[1]
    assert len(digests.matching(spark, 3, few).filter("record_digest not like 'a%'").collect()) == 0
