import random

import xxhash
from pyspark.sql import functions as F

from proofline.llm import simhash
from proofline.llm.components import connected_components


def brute_fingerprint(text: str | None) -> int:
    words = b"".join(bytes([b + 32]) if 65 <= b <= 90 else bytes([b]) for b in (text or "").encode()).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    codes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(c >> bit & 1 for c in codes) > len(codes))


def brute_components(fingerprints: dict[int, int]) -> dict[int, int]:
    root = {i: i for i in fingerprints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fingerprints)
    for a in ids:
        for b in ids:
            if a < b and bin(fingerprints[a] ^ fingerprints[b]).count("1") <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups_equal_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.choice(["tree", "House", "été", "x", "river"]) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 120))] for _ in range(25)]
    texts = []
    for words in base:
        texts.append(" ".join(words))
        for _ in range(4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "new"
            texts.append(rng.choice([" ", "\n ", "\t"]).join(copy))
    texts += [None, "", " \n", "ABC def", "abc DEF", "one", "\x85 É É", "w " * 20_000, texts[0], texts[0].upper()]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).repartition(3)
    marked = {i: brute_fingerprint(t) for i, t in rows}
    expected = brute_components(marked)
    groups = simhash.near_groups(docs).withColumn("hex", simhash.hexadecimal("fingerprint"))
    got = {r.doc_id: (r.hex, r.component_id) for r in groups.collect()}
    assert got == {i: (f"{marked[i]:016x}", expected[i]) for i in marked}
    assert len(set(expected.values())) < len({*marked.values()})


def test_links_reach_over_single_bits_and_the_sign(spark):
    values = [0, 1, 3, 7, 1 << 62, -(1 << 63), -(1 << 63) + 3, 0x0F0F0F0F]
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {(r.a, r.b) for r in simhash.links(frame).collect()}
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in found)
    linked = spark.createDataFrame(list(found), "a long, b long")
    roots = {r.node: r.root for r in connected_components(linked).collect()}
    assert len({roots[v] for v in values[:-1]}) == 1 and values[-1] not in roots


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {roots[i] for i in range(41)} == {0} and {roots[i] for i in range(100, 140)} == {100} and 200 not in roots
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (3, "a b c")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_groups(docs).collect()] == [3, 3, 3]
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_null_ids(spark):
    rows = [(None, "a b c"), (7, "a b c"), (None, "quite another text than that"), (4, "a b c"), (None, None)]
    found = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == sorted(
        [("None", "4"), ("7", "4"), ("4", "4"), ("None", "None"), ("None", "None")]
    )
