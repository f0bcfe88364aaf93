import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.negatives import Summary, hard_negatives, highest

SCHEMA = "vec_id long, embedding array<float>, label int, row long, bands string, LABEL string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=10, positives=5, negatives=10, low=30, high=90):
    good = []
    for r in rows:
        if r[0] is not None and r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]):
            v = [math.floor(256 * float(np.float32(x))) for x in r[1]]
            if sum(x * x for x in v) <= 1 << 56:
                good.append((r[0], r[2], v))
    found = []
    for i, (a, label, v) in enumerate(good):
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), b, j, o == label) for j, (b, o, w) in enumerate(good) if j != i and len(w) == len(v))
        same = [s for s in scores if s[3]][:positives]
        for p in same:
            within = [s for s in scores if not s[3] and low * -p[0] <= 100 * -s[0] <= high * -p[0]][:negatives]
            found += [(a, p[1], rank + 1, s[1], -p[0], -s[0]) for rank, s in enumerate(within)]
    return sorted(found)


def mined(spark, rows, every=10, **options):
    out = hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, **options)
    return sorted(tuple(r) for r in out.select(*COLUMNS).collect())


def vectors(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    made = [rng.normal(size=dims) / 8 for _ in range(5)]
    rows = []
    for i in range(n):
        v = made[rng.integers(len(made))] + rng.normal(size=dims) * rng.choice([0, 0.02, 0.2])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(labels)), 1, "x", "y"))
    return rows


@pytest.mark.parametrize(("dims", "seed"), [(24, 1), (64, 2), (3, 3), (1, 4)])
def test_random_vectors(spark, dims, seed):
    rows = vectors(300, dims, seed)
    expected = brute(rows)
    assert expected and mined(spark, rows) == expected


def test_small_blocks_and_other_numbers(spark):
    rows = vectors(200, 16, 5)
    options = {"positives": 3, "negatives": 4, "low": 10, "high": 97}
    assert mined(spark, rows, 4, block=9, blocks=5, **options) == brute(rows, 4, **options)


def test_one_common_vector_and_one_common_label(spark):
    rows = [(i, [0.5, 0.25, -0.125, 0.0], 1 if i % 3 else 2, 0, "", "") for i in range(150)]
    rows += [(1000 + i, [0.3, 0.2, 0.001 * i, 0.0], 2, 0, "", "") for i in range(30)]
    assert mined(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [
        (10, None, 1, 0, "", ""),
        (20, [nan, 1.0, 0.0], 1, 0, "", ""),
        (30, [1.0, None, 0.0], 1, 0, "", ""),
        (40, [inf, 0.0, 1.0], 1, 0, "", ""),
        (50, [1.0, 0.5, 0.25], None, 0, "", ""),
        (None, [1.0, 0.5, 0.25], 1, 0, "", ""),
        (60, [], 1, 0, "", ""),
        (70, [0.0, 0.0, 0.0], 1, 0, "", ""),
        (80, [1.0, 0.5], 1, 0, "", ""),
        (90, [3e38, 0.0, 0.0], 1, 0, "", ""),
        (100, [900000.0, 5.0, -3.0], 1, 0, "", ""),
        (101, [-0.001, 0.0, 0.0], 2, None, None, None),
        (101, [-0.001, 0.0, 0.0], 2, None, None, None),
        (110, [1.0, 0.5, 0.25], 1, 0, "", ""),
        (110, [1.0, 0.5, 0.25], 1, 0, "", ""),
    ]
    rows = odd + [(200 + i, [0.7, 0.3, 0.1 * (i % 4)], i % 3, 0, "", "") for i in range(40)]
    assert mined(spark, rows) == brute(rows)


def test_no_vectors_no_anchors_one_label(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(3, [1.0], 1, 0, "", ""), (4, [1.0], 2, 0, "", "")]) == []
    assert mined(spark, [(i, [1.0, 0.5], 1, 0, "", "") for i in range(30)]) == []


def test_large_numbers_stay_exact():
    rng = np.random.default_rng(6)
    v = rng.integers(-(1 << 25), 1 << 25, size=(40, 8))
    everything = [(-math.inf, math.inf)]
    for i, at, scores in highest(Summary(v), Summary(v), np.ones((40, 40), bool), [np.array(everything)] * 40, 3):
        exact = [sum(int(x) * int(y) for x, y in zip(v[i], w)) for w in v]
        assert scores.tolist() == [exact[j] for j in at]
        assert set(sorted(range(40), key=lambda j: -exact[j])[:3]) <= set(at.tolist())


def test_segments_settle_most_pairs():
    # vectors that are even within segments are told apart by means alone
    rng = np.random.default_rng(7)
    v = np.repeat(rng.integers(-200, 200, size=(500, 4)), 16, axis=1)
    found = list(highest(Summary(v[:50]), Summary(v), np.ones((50, 500), bool), [np.array([(-math.inf, math.inf)])] * 50, 5))
    assert sum(len(at) for _, at, _ in found) < 50 * 20
