import pytest

from proofline.schemas import LEDGER_SCHEMA
from proofline.sources import sinks


def test_ledger_survives_json_lines(spark, tmp_path):
    issue = ("LEVEL_UNKNOWN", "level", '"DEBUG"', None, "REJECT", "why")
    rows = [("a", "b", 1, "d", "{}", [issue], [], "REJECT", None, 0, None), ("a", "b", 2, None, "é\n", [], [("f", "x", "y", "r")][:0], "ACCEPT", 2, 0, 0)]
    frame = spark.createDataFrame(rows, LEDGER_SCHEMA)
    path = str(tmp_path / "ledger")
    sinks.write_json_lines(frame, path)
    again = sinks.read_json_lines(spark, path, LEDGER_SCHEMA)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text('{"source_line": "no number"}\n')
    with pytest.raises(Exception):
        sinks.read_json_lines(spark, str(tmp_path / "bad"), LEDGER_SCHEMA).collect()


def test_table_as_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_table_csv(spark.createDataFrame([(1, "a,b"), (2, None)], "n int, t string").coalesce(1), path)
    quoted = str(tmp_path / "quoted")
    rows = [('{"a":1,"b":"x\\\\y"}', "line\nbreak"), ("", None), ("é", '""')]
    sinks.write_table_csv(spark.createDataFrame(rows, "j string, t string"), quoted)
    again = sorted(map(tuple, sinks.read_table_csv(spark, quoted, ["j", "t"]).fillna("").collect()))
    assert again == sorted((a or "", b or "") for a, b in rows)
    with pytest.raises(Exception):
        sinks.read_table_csv(spark, quoted, ["j", "other"]).collect()
    assert [tuple(r) for r in spark.read.option("header", "true").csv(path).orderBy("n").collect()] == [("1", "a,b"), ("2", None)]
