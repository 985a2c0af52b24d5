import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from proofline.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score int, chunk string"


def brute(rows, n_positives=5, n_negatives=10):
    """All scores by plain sums."""
    known = {}
    for i, label, vector in rows:
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known[(i, label, tuple(math.floor(256 * float(x)) for x in vector))] = True
    known = sorted(known, key=lambda r: (r[0], r[1]))
    anchors = {}
    for i, label, q in known:
        if i % 100 == 0:
            anchors.setdefault(i, (label, q))
    result = []
    for a, (label, q) in anchors.items():
        scored = [(sum(x * y for x, y in zip(q, v)), i, other == label) for i, other, v in known if i != a]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p_score, p, _ in [s for s in scored if s[2]][:n_positives]:
            inside = [s for s in scored if not s[2] and 30 * p_score <= 100 * s[0] <= 90 * p_score]
            result += [(a, p, rank, i, p_score, score) for rank, (score, i, _) in enumerate(inside[:n_negatives], 1)]
    return sorted(result)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found)


def _rows(seed, count, dims, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.2, dims)
    return [(i * 10, int(rng.integers(labels)), (centre + rng.normal(0, 0.15, dims)).astype(np.float32).tolist()) for i in range(count)]


@pytest.mark.parametrize(("dims", "block"), [(64, 512), (13, 3), (1, 512)])
def test_negatives_equal_brute_force(spark, monkeypatch, dims, block):
    monkeypatch.setattr(hard_negatives, "CHUNK", (40, 60))
    rows = _rows(dims, 220, dims)
    expected = brute(rows)
    assert mined(spark, rows, block_rows=block) == expected
    assert len(expected) > 20


def test_ties_nulls_repeated_rows_and_uneven_vectors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK", (30, 60))
    rng = random.Random(4)
    # Few values, so that scores are equal very often; one vector for a third of the rows.
    rows = [(i * 4, rng.randrange(2), [rng.choice([0.5, 0.25, -0.5]) for _ in range(8)] if i % 3 else [0.5] * 8) for i in range(150)]
    rows += rows[:40] + [(0, 1, [0.25] * 8), (0, 0, [1.0] * 9), (100, 3, [0.5] * 3), (100, 3, []), (200, 5, [0.0] * 8), (300, 7, [0.5] * 8)]
    rows += [(None, 0, [0.5] * 8), (400, None, [0.5] * 8), (404, 0, None), (408, 0, [0.5, None]), (412, 0, [float("nan")]), (416, 1, [float("inf")] * 8)]
    expected = brute(rows)
    assert mined(spark, rows) == expected
    assert len(expected) > 50


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 0, [0.5]), (2, 1, [0.5])]) == []
    assert mined(spark, [(100, 0, [0.5])]) == []


def test_tables_give_inner_products():
    rng = np.random.default_rng(1)
    for low, high, dims in ((-3, 4, 8), (0, 1, 8), (-(1 << 20), 1 << 20, 21), (-(1 << 27), 1 << 27, 3)):
        rows, anchors = (rng.integers(low, high, (n, dims)) for n in (50, 7))
        needed, planes = hard_negatives.bit_planes(rows)
        codes = [planes[i, planes.shape[1] - n :].tobytes() for i, n in enumerate(needed.tolist())]
        bytes_ = hard_negatives.unpacked(needed, codes)
        assert (hard_negatives.numbers_of(bytes_)[:, :dims] == rows).all()
        padded = np.pad(anchors, ((0, 0), (0, -dims % 8)))
        tables = hard_negatives.Tables(padded, 1 << (bytes_.shape[1] - 1))
        assert (tables.scores(bytes_) == rows @ anchors.T).all()


def test_scores_beyond_a_long_are_refused():
    with pytest.raises(ValueError, match="fit"):
        hard_negatives.Tables(np.full((1, 8), 1 << 31), 1 << 31)
