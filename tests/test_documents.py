import hashlib

from proofline.operators import documents
from proofline.sources import documents as source

HEAD = "# POL-01 — Sao lưu\n\n**Công ty — Phòng CNTT** · Phiên bản 2.0 · Ban hành: 5/2026 · Thay thế phiên bản trước · Người duyệt: Trưởng phòng · x\n\n"


def frame(spark, *rows):
    return source.from_table(spark.createDataFrame(list(rows), "file_name string, md_text string"))


def test_inventory_of_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "SOP-09_x.md").write_text("# no")
    (tmp_path / "notes.txt").write_text("no")
    raw = (HEAD + "## A\nx\n").replace("\n", "\r\n").encode()
    (tmp_path / "POL-01_sao_luu_V2.md").write_bytes(raw)
    (tmp_path / "readme.draft.md").write_text("plain\n**open only\n")
    rows = documents.document_inventory(source.read_documents(spark, str(tmp_path))).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == ["POL-01", "readme.draft"]
    first, second = rows
    assert first["sha256"] == hashlib.sha256(raw).hexdigest() and "\r" not in first["md_text"]
    assert first["filename_version_hint"] == "_v2" and second["filename_version_hint"] is None
    assert (first["version"], first["effective_date"], first["department"], first["approver"]) == (
        "2.0",
        "2026-05",
        "Công ty — Phòng CNTT",
        "Trưởng phòng",
    )
    assert first["supersedes_previous"] and not second["supersedes_previous"]
    assert second["version"] is second["effective_date"] is second["department"] is second["approver"] is None


def test_header_spellings(spark):
    lines = {
        "**A** · Cập nhật: 07/2026": (None, "2026-07", "A", None),
        "**A** · Phien  ban 1.12 · Ban hanh: 12/2025": ("1.12", "2025-12", "A", None),
        "no header": (None, None, None, None),
    }
    rows = spark.createDataFrame([(t,) for t in lines], "line string")
    for row in documents.header_metadata(rows, "line").collect():
        found = (row["version"], row["effective_date"], row["department"], row["approver"])
        assert found == lines[row["line"]]


def chunks(spark, text, **options):
    inventory = documents.document_inventory(frame(spark, ("POL-01_a_v2.md", text)))
    rows = documents.chunk_sections(inventory, **options).orderBy("chunk_index").collect()
    return [(r["section"], r["content"]) for r in rows], rows


def test_sections_repeat_the_header(spark):
    text = HEAD + "lost preamble\n\n##  First  \n\nbody 1  \n\n### deeper\n##No ## no\n## ## Odd\nend\n\n"
    found, rows = chunks(spark, text)
    head = HEAD
    assert found == [
        ("First", head + "##  First\n\n\nbody 1  \n\n### deeper\n##No ## no\n"),
        ("## Odd", head + "## ## Odd\n\nend\n"),
    ]
    assert rows[1]["chunk_id"] == "POL-01_2.0_chunk1"
    assert rows[0]["content_hash"] == hashlib.sha256(rows[0]["content"].encode()).hexdigest()
    kept, _ = chunks(spark, text, keep_preamble=True)
    assert [s for s, _ in kept] == ["(preamble)", "First", "## Odd"]


def test_documents_without_sections(spark):
    found, rows = chunks(spark, "intro\n# T \n**M** · Phiên bản 1.0\n\n\nbody\n\n")
    assert found == [("(full document)", "# T\n\n**M** · Phiên bản 1.0\n\nbody\n")]
    assert rows[0]["chunk_id"] == "POL-01_1.0_chunk0"
    found, rows = chunks(spark, "just text")
    assert found == [("(full document)", "\n\njust text\n")] and rows[0]["chunk_id"] == "POL-01_v2_chunk0"


def test_current_versions(spark):
    rows = [
        ("A", "a1", False, "2026-01"),
        ("B", "b1", True, "2024-01"),
        ("B", "b2", False, "2026-01"),
        ("C", "c1", True, "2024-01"),
        ("C", "c2", True, "2025-01"),
        ("D", "d2", False, "2026-01"),
        ("D", "d1", False, "2026-01"),
        ("E", "e1", False, None),
        ("E", "e2", False, "2020-01"),
        *[("F", f"f{i:04d}", False, f"20{i % 90:02d}-01") for i in range(2000)],
    ]
    docs = spark.createDataFrame(rows, "doc_id string, source_path string, supersedes_previous boolean, effective_date string")
    found = {r["source_path"] for r in documents.resolve_versions(docs, docs).filter("is_current").collect()}
    assert found == {"a1", "b1", "c2", "d1", "e2", "f0089"}
    stats = documents.build_stats(docs, documents.resolve_versions(docs, docs)).first()
    assert (stats["documents"], stats["chunks"], stats["current_chunks"]) == (2009, 2009, 6)
