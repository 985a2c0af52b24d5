import random
import sqlite3

import pytest

from proofline.functions import sizing
from proofline.operators import search
from proofline.plans import knowledge_base
from proofline.sources.documents import from_table

WORDS = ["log", "Log", "sao", "lưu", "Sao", "trữ", "đường", "ngưỡng", "CRITICAL", "502", "a", "ERR", "naïve", "x-y", "kết"]


def corpus(seed=3, size=40):
    rng = random.Random(seed)
    return [
        (f"c{i:03d}", f"D{i % 7}", f"s{i}", None, None, i % 3 != 0,
         " ".join(rng.choice(WORDS) for _ in range(rng.randrange(3, 60))), f"p{i}")
        for i in range(size)
    ]


SCHEMA = (
    "chunk_id string, doc_id string, section string, version string, effective_date string, is_current boolean,"
    " content string, source_path string"
)
QUERIES = ["log", "sao lưu", "LOG log", "a a", "502 ERR naive", "x y", 'log" OR "sao', "   ", "*", "missing word",
           "sao log 502", "ngưỡng", "ket", "duong", "log sao lưu trữ"]


def sqlite_results(rows, current, k):
    database = sqlite3.connect(":memory:")
    database.execute("CREATE VIRTUAL TABLE f USING fts5(content, tokenize='unicode61')")
    database.executemany("INSERT INTO f(rowid, content) VALUES (?, ?)", [(i + 1, r[6]) for i, r in enumerate(rows)])
    found = {}
    for number, query in enumerate(QUERIES):
        if not query.strip():
            continue
        phrase = '"' + query.strip().replace('"', '""') + '"'
        hits = database.execute("SELECT rowid, bm25(f) FROM f WHERE f MATCH ?", (phrase,)).fetchall()
        ranked = sorted((round(s, 9), rows[i - 1][0], s) for i, s in hits if not current or rows[i - 1][5])[:k]
        if ranked:
            found[number] = [(c, pytest.approx(s, abs=1e-9)) for _, c, s in ranked]
    return found


@pytest.mark.parametrize("broadcast", [True, False])
def test_phrases_and_scores_match_a_full_text_engine(spark, monkeypatch, tmp_path, broadcast):
    if not broadcast:
        monkeypatch.setattr(search, "fits_broadcast", lambda *a, **k: False)
        monkeypatch.setattr(search, "NAMED_TERMS", 0)
    rows = corpus()
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).repartition(5), str(tmp_path / "index"), 7 if broadcast else 1)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, query_text string")
    for current, k, run in ((True, 5, search.search_current), (False, 10, search.search_all)):
        found = {}
        for row in run(index, queries).orderBy("query_id", "rank").collect():
            found.setdefault(row["query_id"], []).append((row["chunk_id"], row["bm25_score"]))
        assert found == sqlite_results(rows, current, k)


def test_equal_phrases_share_results_and_copies_do_not_multiply(spark, tmp_path):
    rows = [(f"c{i:04d}", "D", "s", None, None, True, "the same passage again", f"p{i}") for i in range(500)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "index"))
    queries = spark.createDataFrame([(i, "Same PASSAGE") for i in range(50)], "query_id int, query_text string")
    found = search.search_current(index, queries).collect()
    assert len(found) == 250 and {r["chunk_id"] for r in found} == {f"c000{i}" for i in range(5)}


def test_term_statistics_and_postings(spark, tmp_path):
    rows = [("c1", "D", "s", None, None, True, "b a b a b", "p1"), ("c2", "D", "s", None, None, True, "b", "p2"),
            ("c3", "D", "s", None, None, True, "--", "p3"), ("c1", "D", "s", None, None, False, "a", "p0")]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "index"))
    assert sorted(map(tuple, search.term_statistics(index).collect())) == [("a", 2, 3), ("b", 2, 4)]
    assert tuple(index.stats.first()) == (4, 7, pytest.approx(7 / 4), search.BUCKETS)
    found = search.named(index, index.postings).select("chunk_id", "source_path", "first", "second", "positions").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("c1", "p1", "b", "a", [0, 2]), ("c1", "p1", "a", "b", [1, 3]), ("c1", "p1", "b", None, [4]), ("c2", "p2", "b", None, [0]), ("c1", "p0", "a", None, [0])],
        key=str,
    )
    # Numbers are in the order of ids, then paths.
    order = [tuple(r) for r in index.chunks.orderBy("chunk_no").select("chunk_id", "source_path").collect()]
    assert order == sorted(order)


def test_a_search_reads_only_its_buckets_and_terms(spark, tmp_path):
    rows = [(f"c{i:03d}", "D", "s", None, None, True, f"w{i} w{i + 1} common", f"p{i}") for i in range(300)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "index"), 16)
    asked = spark.createDataFrame([("w5 w6",), ("common",)], "phrase string")
    matches = search.phrase_matches(index, asked)
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(first" in plan or "EqualTo(first" in plan
    assert {r["phrase"]: r["count"] for r in matches.groupBy("phrase").count().collect()} == {"w5 w6": 1, "common": 300}
    read = search.pruned_postings(index, asked.selectExpr("phrase as first"))
    assert len(read.select("bucket").distinct().collect()) <= 2
    many = spark.range(1000).selectExpr("concat('w', id) as phrase")
    assert search.phrase_matches(index, many).count() == 600


def test_an_index_is_built_once_for_the_same_input(spark, tmp_path):
    source = str(tmp_path / "docs")
    spark.range(3).selectExpr("cast(id as string) as value").coalesce(1).write.text(source)
    state = knowledge_base.input_state(spark, source)
    assert state == knowledge_base.input_state(spark, source)
    built = []

    def documents():
        built.append(1)
        frame = spark.createDataFrame([(1, "# A\n\n**x** \n\n## B one\n", "A-1_x_v1.md")], "doc_id long, md_text string, file_name string")
        return from_table(frame)

    first = knowledge_base.stored(spark, state, documents)
    again = knowledge_base.stored(spark, state, documents)
    assert built == [1] and first.chunks.collect() == again.chunks.collect()
    spark.range(1).selectExpr("'x' as value").write.mode("append").text(source)
    assert knowledge_base.input_state(spark, source) != state


def test_size_check(spark):
    frame = spark.createDataFrame([("abc",)] * 10, "t string")
    assert sizing.fits_broadcast(frame, "t")
    assert not sizing.fits_broadcast(frame, "t", max_rows=9)
    assert not sizing.fits_broadcast(frame, "t", max_bytes=29)


def test_frequent_pairs_of_a_rare_phrase_send_no_rows(spark, tmp_path):
    texts = ["a b x", "y b c", "c d z", "b c d"] * 50 + ["a b c d", "a b c d a b c d e", "a b"]
    rows = [(f"c{i:03d}", "D", "s", None, None, True, t, f"p{i}") for i, t in enumerate(texts)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "index"))
    pieces = search._pieces(spark.createDataFrame([("a b c d",)], "phrase string"))
    assert sorted(r["pos"] for r in search._met_grams(index, pieces).collect()) == [0, 0, 4]


@pytest.mark.parametrize("rows_sent", ["broadcast", "gate", "all"])
def test_phrases_of_all_lengths_match_brute_force(spark, monkeypatch, tmp_path, rows_sent):
    if rows_sent != "broadcast":
        monkeypatch.setattr(search, "fits_broadcast", lambda *a, **k: False)
    if rows_sent == "all":
        monkeypatch.setattr(search, "GATE_ROWS", 0)
    rng = random.Random(8)
    texts = [[rng.choice("abc") for _ in range(rng.randrange(1, 30))] for _ in range(40)] + [list("ab") * 10, ["c"]]
    rows = [(f"c{i:03d}", "D", "s", None, None, True, " ".join(t), f"p{i}") for i, t in enumerate(texts)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "index"), 3)
    wanted = {" ".join(t[: n + 1]) for t in texts for n in range(12)} | {"a " * 8 + "b", "q", "a q"}
    expected = {}
    for phrase in wanted:
        terms = phrase.split()
        for i, t in enumerate(texts):
            tf = sum(t[at : at + len(terms)] == terms for at in range(len(t)))
            if tf:
                expected[phrase, f"c{i:03d}"] = tf
    asked = spark.createDataFrame([(" ".join(w.split()),) for w in wanted], "phrase string")
    found = search.named(index, search.phrase_matches(index, asked)).collect()
    assert {(r["phrase"], r["chunk_id"]): r["tf"] for r in found} == expected and len(found) == len(expected)


def test_term_statistics_shuffle_terms_only(spark, tmp_path):
    rows = [(f"c{i:03d}", "D", "s", None, None, True, "a b a c a b", f"p{i}") for i in range(60)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "index"))
    found = search.term_statistics(index)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, found.collect())) == [("a", 60, 180), ("b", 60, 120), ("c", 60, 60)]


def test_chunks_without_text_have_no_postings(spark, tmp_path):
    rows = [("c1", "D", "s", None, None, True, None, "p1"), ("c2", "D", "s", None, None, True, "", "p2"), ("c3", "D", "s", None, None, True, "a b", "p3")]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "index"))
    assert index.chunks.count() == 3
    found = search.named(index, index.postings).select("chunk_id", "first", "positions").collect()
    assert sorted(map(tuple, found)) == [("c3", "a", [0]), ("c3", "b", [1])]


def test_places_of_whole_phrases_are_shuffled_once(spark, tmp_path):
    texts = ["a b c d a b c d a b c e", "a b c", "x a b c d", "a b a b a b", "d"]
    rows = [(f"c{i}", "D", "s", None, None, True, t, f"p{i}") for i, t in enumerate(texts)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).repartition(2), str(tmp_path / "index"))
    matches = search.phrase_matches(index, spark.createDataFrame([("a b",), ("a b c",), ("a b c d",), ("a b a b",)], "phrase string"))
    plan = matches._jdf.queryExecution().executedPlan().toString()
    # One exchange of what was counted where it lies; the other is that of the phrases, below their broadcast.
    assert plan.split("BroadcastExchange")[0].count("Exchange hashpartitioning") == 1
    found = {(r["phrase"], r["chunk_id"]): r["tf"] for r in search.named(index, matches).collect()}
    assert found == {
        ("a b", "c0"): 3, ("a b", "c1"): 1, ("a b", "c2"): 1, ("a b", "c3"): 3, ("a b c", "c0"): 3, ("a b c", "c1"): 1,
        ("a b c", "c2"): 1, ("a b c d", "c0"): 2, ("a b c d", "c2"): 1, ("a b a b", "c3"): 2,
    }


def test_rows_go_to_their_bucket_without_a_sort_and_nothing_is_kept_twice(spark, tmp_path):
    rows = [(f"c{i:03d}", "D", "s", None, None, True, f"w{i % 9} w{i % 5} w{i % 7} x", f"p{i}") for i in range(200)]
    root = tmp_path / "index"
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).repartition(3), str(root), 4)
    assert sorted(p.name for p in root.iterdir()) == ["chunks", "postings", "stats"]
    assert "tokens" not in index.chunks.columns and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == writers
    # A bucket's rows lie as a run of chunks gave them: by pair, then chunk.
    files = [sorted(p.glob("*.parquet")) for p in (root / "postings").glob("bucket=*")]
    for path in (p for found in files for p in found):
        keys = [(r["first"], r["second"] is None, r["second"], r["chunk_no"]) for r in spark.read.parquet(str(path)).collect()]
        assert keys == sorted(keys)
    assert tuple(index.stats.first())[:2] == (200, 800)


def test_a_knowledge_base_cuts_texts_once(spark, tmp_path, monkeypatch):
    calls = []
    cut = knowledge_base.document_inventory
    monkeypatch.setattr(knowledge_base, "document_inventory", lambda *a: calls.append(1) or cut(*a))
    text = "# A\n\n**x** · Phiên bản {v}.0{s}\n\n## B one\n\n## C two\n"
    rows = [(text.format(v=1, s=""), "A-1_x_v1.md"), (text.format(v=2, s=" · Thay thế phiên bản trước"), "A-1_x_v2.md"), (None, "B-2_v1.md")]
    documents = from_table(spark.createDataFrame(rows, "md_text string, file_name string"))
    index = knowledge_base.build(documents, str(tmp_path / "kb"))
    assert calls == [1] and not (tmp_path / "kb" / "sections").exists()
    found = sorted((r["source_path"], r["section"], r["is_current"]) for r in index.chunks.collect())
    assert [(p, c) for p, _, c in found] == [
        ("docs/A-1_x_v1.md", False), ("docs/A-1_x_v1.md", False), ("docs/A-1_x_v2.md", True), ("docs/A-1_x_v2.md", True), ("docs/B-2_v1.md", True)
    ]


def test_an_export_of_chunks_builds_no_index(spark, tmp_path, monkeypatch):
    from catalog import knowledge

    monkeypatch.setattr(knowledge_base, "build_index", lambda *a, **k: pytest.fail("the postings were built"))
    rows = [(i, f"First words of document {i}\nSecond line", "en", f"src{i % 2}") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    found = knowledge.chunk_files(spark, str(tmp_path))
    expected = knowledge.chunk_export(spark, str(tmp_path))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.count() >= 12


@pytest.mark.parametrize("broadcast", [True, False])
def test_postings_made_for_one_batch_give_what_stored_ones_give(spark, monkeypatch, tmp_path, broadcast):
    if not broadcast:
        monkeypatch.setattr(search, "fits_broadcast", lambda *a, **k: False)
        monkeypatch.setattr(search, "NAMED_TERMS", 0)
    rows = [*corpus(), ("c999", "D1", "s", None, None, True, None, "p999")]
    chunks = spark.createDataFrame(rows, SCHEMA).repartition(5)
    stored = search.build_index(chunks, str(tmp_path / "stored"))
    scanned = search.scan_index(chunks, str(tmp_path / "scanned"))
    assert scanned.stats.collect() == stored.stats.collect()
    for asked in (QUERIES, ["log", "ngưỡng"], ["sao log 502 x"]):
        queries = spark.createDataFrame(list(enumerate(asked)), "query_id int, query_text string")
        shown = lambda index: sorted(tuple(r) for r in search.search_all(index, queries).select("query_id", "rank", "chunk_id", "bm25_score").collect())  # noqa: B023, E731
        assert shown(scanned) == shown(stored)
    assert sorted(p.name for p in (tmp_path / "scanned").iterdir()) == ["chunks", "stats"]


def test_a_batch_without_an_index_writes_chunks_only(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(knowledge_base, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    monkeypatch.setattr(knowledge_base, "named_folder", lambda spark, name: str(tmp_path / name))
    made = lambda: from_table(spark.createDataFrame([("A_v1.md", "# A\n\n**x**\n\n## S\none two three\n")], "file_name string, md_text string"))
    queries = spark.createDataFrame([(1, "one two")], "query_id int, query_text string")
    for read in (knowledge_base.stored_or_scanned, knowledge_base.stored, knowledge_base.stored_or_scanned):
        index = read(spark, "state", made)
        assert [r["section"] for r in search.search_all(index, queries).collect()] == ["S"]
        assert index.stored == (tmp_path / "knowledge-base").exists()
    assert not [p for p in (tmp_path / "scanned-chunks").iterdir() if p.name not in ("chunks", "stats", "current")]


@pytest.mark.parametrize("longest", [1 << 15, 4])
def test_a_token_of_a_run_of_chunks_is_one_list(spark, monkeypatch, tmp_path, longest):
    monkeypatch.setattr(search, "LIST_PLACES", longest)
    monkeypatch.setattr(search, "SENT_PLACES", 8)
    rows = [(f"c{i:03d}", "D", "s", None, None, i % 2 == 0, f"a b a w{i % 3}", f"p{i}") for i in range(30)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "index"), 3)
    stored = index.lists.groupBy("first").agg({"*": "count"}).collect()
    sizes = {"a": 60, "b": 30, "w0": 10, "w1": 10, "w2": 10}
    assert {r["first"]: r[1] for r in stored} == {w: -(-n // longest) for w, n in sizes.items()}
    chunks = {"a": 30, "b": 30, "w0": 10, "w1": 10, "w2": 10}
    assert {tuple(r) for r in search.term_statistics(index).collect()} == {(w, chunks[w], n) for w, n in sizes.items()}
    asked = spark.createDataFrame([("a",), ("a b a w1",), ("a b a w1 a",), ("b a",), ("a w2",)], "phrase string")
    found = search.phrase_matches(index, asked).collect()
    counted = {}
    for r in found:
        counted.setdefault(r["phrase"], []).append(r["tf"])
    assert {p: (len(n), set(n)) for p, n in counted.items()} == {"a": (30, {2}), "a b a w1": (10, {1}), "b a": (30, {1}), "a w2": (10, {1})}


def test_a_list_lies_in_the_bucket_that_a_search_reads(spark, tmp_path):
    words = ["a", "đường", "ngưỡng", "x1", "東京", "kết"]
    rows = [(f"c{i}", "D", "s", None, None, True, w, f"p{i}") for i, w in enumerate(words)]
    index = search.build_index(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "index"), 5)
    read = index.lists.select("bucket", search.bucket_of(index.lists["first"], search.F.lit(5)).alias("read")).collect()
    assert len(read) == len(words) and all(r["bucket"] == r["read"] for r in read)


def test_texts_cut_by_tables_have_the_tokens_of_the_expression(spark):
    from proofline.functions.tokens import token_tables, tokens

    rng = random.Random(5)
    letters = "aZ9 _-é́̂ếĐßİıſΣς·ﬁ東𝔸𐐀\U0001f600٣Ⅷ\n\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(500)]
    texts += ["".join(map(chr, range(at, min(at + 64, 0xD800)))) for at in range(0, 0xD800, 64)]
    texts += ["", "́", "a", "plain ASCII text 7", "x" * 70]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    expected = [r[0] for r in frame.orderBy("i").select(tokens(search.F.col("t"))).collect()]
    sizes, found = token_tables(spark).cut(search.pa.array(texts)[:])
    found, at = found.to_pylist(), 0
    for size, wanted in zip(sizes.tolist(), expected, strict=True):
        assert found[at : at + size] == wanted
        at += size
    assert at == len(found)
    part = search.pa.array(["a b", "ć d", "e f g"])[1:]
    assert token_tables(spark).cut(part)[1].to_pylist() == ["c", "d", "e", "f", "g"]


def test_a_pass_over_chunks_sends_only_places_that_a_piece_may_meet(spark, tmp_path):
    rows = [(f"c{i:03d}", "D", "s", None, None, True, f"w{i} w{i + 1} common w{i + 2}", f"p{i}") for i in range(300)]
    index = search.scan_index(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "index"))
    pieces = search._pieces(spark.createDataFrame([("w5 w6",), ("w7 w8 common w9",), ("w11",)], "phrase string"))
    asked = pieces.fillna("", ["second", "third", "fourth"])
    met = {(r["first"], r["second"], r["third"], r["fourth"], r["pos"]) for r in search._met_in_chunks(index, asked, [1, 2, 4]).collect()}
    wanted = {("w5", "w6", "", "", 0), ("w7", "w8", "common", "w9", 0), ("w11", "", "", "", 0), ("w11", "", "", "", 1), ("w11", "", "", "", 3)}
    # A filter never loses a place; the 3,000 others hardly pass.
    assert wanted <= met and len(met) < 40


def test_texts_of_cases_are_split_once(spark, monkeypatch, tmp_path):
    from catalog import knowledge

    rows = [(i, f"Alpha{i} beta gamma delta epsilon", "en", "src0") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    plan = knowledge.cases(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
    read = []
    made = knowledge.cases
    monkeypatch.setattr(knowledge, "cases", lambda *a: read.append(1) or made(*a))
    found = knowledge.run_evaluation(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert read == [1] and "split(text" not in plan and found.count() == 6
