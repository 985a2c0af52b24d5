import hashlib

import pytest

from proofline.operators import ledger, validation
from proofline.sources import lines


def write(path, content: bytes):
    path.write_bytes(content)
    return str(path.parent)


def physical(content: bytes):
    parts = content.split(b"\n")
    if parts[-1] == b"":
        parts.pop()
        sizes = [len(p) + 1 for p in parts]
    else:
        sizes = [len(p) + 1 for p in parts[:-1]] + [len(parts[-1])]
    return [
        (i + 1, p.decode("utf-8", errors="replace").rstrip("\r\n"), size)
        for i, (p, size) in enumerate(zip(parts, sizes))
    ]


def test_line_numbers_across_many_splits(spark, tmp_path):
    contents = {
        "a.log": b"".join(b"line %d of a\r\n" % i if i % 3 else b"\n" for i in range(4000)),
        "b.log": "\n".join(f"dòng {i} carriage\rreturn" for i in range(2500)).encode(),
    }
    for name, content in contents.items():
        write(tmp_path / name, content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        found = lines.number_lines(lines.stage_scan(lines.scan_text(spark, str(tmp_path))))
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for file_no, (name, content) in enumerate(sorted(contents.items())):
        mine = sorted(
            (r["source_line"], r["raw_line"], r["byte_length"]) for r in rows if r["source_path"].endswith(name)
        )
        assert mine == physical(content)
        assert {r["file_no"] for r in rows if r["source_path"].endswith(name)} == {file_no}


def test_invalid_utf8_and_oversize_lines(spark, tmp_path):
    good = '{"timestamp":"2026-07-27T00:02:47Z","service":"s","level":"INFO","message":"☃ �","request_id":"r"}'
    content = good.encode() + b"\n" + b'{"message":"\xff\xfe"}\n' + b"x" * 300 + b"\n" + b"\xef\xbb\xbf{}"
    source = lines.read_lines(spark, write(tmp_path / "a.log", content))
    rows = ledger.quality_ledger(source, max_line_bytes=200).orderBy("source_line").collect()
    assert [[i["issue_code"] for i in r["issues"]] for r in rows] == [
        [],
        ["TEXT_INVALID_UTF8"],
        ["LINE_TOO_LARGE"],
        ["JSON_MALFORMED"],
    ]
    assert rows[1]["raw_line"] == '{"message":"��"}'
    assert rows[2]["issues"][0]["original_value"] == "301"
    assert {r["source_sha256"] for r in rows} == {hashlib.sha256(content).hexdigest()}


def test_size_limit_must_be_positive(spark):
    frame = spark.createDataFrame([(1, "x")], "source_line long, raw_line string")
    try:
        validation.guard_lines(lines.from_table(frame, "x").lines, 0)
    except ValueError:
        return
    raise AssertionError("limit 0 was accepted")


def test_files_are_hashed_in_pieces(spark, tmp_path):
    mark = b"\xef\xbb\xbf"
    contents = {
        "a.bin": b"0123456789" * 50_000,
        "b.bin": bytes(range(256)) * 700,
        "c.bin": b"x\n" * 30_000,
        "d.bin": b"\n\n\n",
        "f.bin": mark + b"a\nb",
        "g.bin": mark + b"a\nb\n",
        "h.bin": mark,
        "i.bin": b"\r\n\xff\x00\r",
        "j.txt": b"left out",
    }
    for name, content in contents.items():
        write(tmp_path / name, content)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        found = lines.file_fingerprints(spark, str(tmp_path), "*.bin").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r["source_path"].rsplit("/", 1)[1]: (r["byte_size"], r["source_sha256"]) for r in found}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items() if n != "j.txt"}
    # Spark's readers do not list files without a byte.


def test_paths_with_spaces_and_other_letters(spark, tmp_path):
    folder = tmp_path / "nhật ký 1"
    folder.mkdir()
    content = b'{"a":1}\n{"b":2}\n'
    write(folder / "ngày 1%.log", content)
    for prints in (lines.file_fingerprints(spark, str(folder)), None):
        source = lines.read_lines(spark, str(folder), prints)
        assert [r["source_sha256"] for r in source.files.collect()] == [hashlib.sha256(content).hexdigest()]


def test_numbers_are_checked_and_do_not_depend_on_a_second_scan(spark, tmp_path):
    write(tmp_path / "a.log", b"".join(b"line %d\n" % i for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        staged = lines.stage_scan(lines.scan_text(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert staged.select("block_start").distinct().count() > 3
    splits = lines.stage_splits(staged)
    numbered = lines.number_lines(staged.repartition(3), splits)
    files = lines.scanned_files(splits)
    assert [tuple(r)[1:] for r in lines.numbering_check(numbered, files).collect()] == [(3000, True)]
    assert all(r["raw_line"] == f"line {r['source_line'] - 1}" for r in numbered.collect())
    wrong = numbered.withColumn("source_line", numbered.source_line - (numbered.source_line == 9).cast("int"))
    assert [r["ok"] for r in lines.numbering_check(wrong, files).collect()] == [False]
    with pytest.raises(Exception, match="without gaps"):
        lines.number_lines(staged, lines.stage_splits(staged.filter("row_id % 1000 <> 5"))).collect()


def test_a_table_is_known_by_its_lines(spark):
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "source_line int, raw_line string")
    digest = lambda f: lines.from_table(f, "p").files.first()["source_sha256"]
    assert digest(frame) == digest(frame.repartition(3)) != digest(frame.limit(1))
    assert digest(frame) != digest(frame.selectExpr("source_line", "upper(raw_line) as raw_line"))


def test_a_line_number_that_does_not_fit_is_an_error(spark):
    frame = spark.createDataFrame([(1 << 36, "x")], "source_line long, raw_line string")
    with pytest.raises(Exception, match="does not fit"):
        lines.from_table(frame, "x").lines.collect()
