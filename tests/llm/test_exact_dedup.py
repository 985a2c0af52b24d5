import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from proofline.llm import exact_dedup


def _words(values):
    raw = b"".join(hashlib.sha256(str(v).encode()).digest() for v in values)
    return np.frombuffer(raw, np.uint64).reshape(-1, 4)


def test_the_hash_is_perfect_and_minimal():
    for count in (0, 1, 2, 63, 5000):
        words = _words(range(count))
        sizes, bits, slots = exact_dedup.build_hash(words)
        assert sorted(slots.tolist()) == list(range(count)) and int(bits.sum()) == count
        if count:
            assert (exact_dedup.probe_hash(words, sizes, bits) == slots).all()


def test_strangers_are_told_by_their_digest():
    members, strangers = [hashlib.sha256(b"m%d" % i).digest() for i in range(500)], [hashlib.sha256(b"s%d" % i).digest() for i in range(500)]
    table = lambda digests: pa.table(
        {"shard": [0] * len(digests), "digest": pa.array(digests, pa.binary()), "winner": list(range(len(digests))), "size": [1] * len(digests)}
    )
    index = exact_dedup.build_shard(table(members))
    found = exact_dedup.probe_shard(index, table(strangers + members[:10])).to_pylist()
    assert len(found) == 1000
    assert {r["digest"] for r in found if r["historical"]} == set(members)
    assert all(r["group_size"] == 2 for r in found if r["digest"] in set(members[:10]))


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_ROWS", 16)
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "A", "é", "", None, "x" * 5000, f"own {i}"])) for i in range(300)]
    rows += [(7, rows[7][1]), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(0)).repartition(3)
    groups: dict[str, list] = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    for history in (exact_dedup.even_half(), F.lit(False), F.lit(True)):
        got = exact_dedup.exact_groups(docs, history).collect()
        assert len(got) == len(rows)
        for r in got:
            text = next(t or "" for i, t in rows if i == r.doc_id)
            own = groups[text]
            assert (r.keep_id, r.group_size) == (max(i for i in own if i is not None), len(own))
            assert r.kept == (r.doc_id == r.keep_id) and r.digest == hashlib.sha256(text.encode()).digest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_groups(docs, exact_dedup.even_half()).count() == 0


def test_texts_that_only_null_ids_have(spark):
    large = 2**53 + 1
    rows = [(None, "only null"), (None, "only null"), (large, "a"), (large + 2, "a"), (large + 4, "own"), (None, "own"), (-(2**63), "least")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keep = {"only null": None, "a": large + 2, "own": large + 4, "least": -(2**63)}
    expected = sorted((i is None, i or 0, keep[t] or 0, keep[t] is None, sum(u == t for _, u in rows), i == keep[t]) for i, t in rows)
    for history in (exact_dedup.even_half(), F.lit(False), F.lit(True), F.col("doc_id").isNull(), F.col("doc_id").isNotNull()):
        got = exact_dedup.exact_groups(docs, F.coalesce(history, F.lit(False))).collect()
        found = [(r.doc_id is None, r.doc_id or 0, r.keep_id or 0, r.keep_id is None, r.group_size, r.kept) for r in got]
        assert sorted(found) == expected
