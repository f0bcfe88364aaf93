import math

import numpy as np

from ledgerlens.llm.vectors import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, links long, id string, EMBEDDING string"


def brute(rows, least=0.95):
    ids, good = [r[0] for r in rows], []
    for i, r in enumerate(rows):
        v = r[1]
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.append((i, np.array(v, np.float32).astype(float)))
    links, root = [0] * len(rows), list(range(len(rows)))
    near = []
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least:
                links[i] += 1
                links[j] += 1
                near.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in near:
            low = min(root[i], root[j], key=lambda k: ids[k])
            changed |= root[i] != low or root[j] != low
            root[i] = root[j] = low
    return sorted((r[0], n, ids[k], r[0] == ids[k]) for r, n, k in zip(rows, links, root))


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in near_vectors(df, **options).select("vec_id", "n_links", "component_id", "kept").collect())


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    made = []
    for i in range(n):
        v = rng.normal(size=dims)
        if made and rng.random() < 0.5:
            v = made[rng.integers(len(made))] + rng.normal(size=dims) * rng.choice([0, 0.02, 0.2, 0.32, 0.4])
        made.append(v)
    return [(i, [float(np.float32(x)) for x in v], i % 3, 5, "x", "y") for i, v in enumerate(made)]


def test_random_vectors(spark):
    rows = vectors(300, 24, 1)
    assert found(spark, rows) == brute(rows)


def test_small_blocks_and_many_in_one_range(spark):
    # all share the leading coordinate but for rounding, so ranges hold more than a block
    rows = [(i, [1.0, 0.001 * (i % 7), 0.0005 * i], 0, 0, "", "") for i in range(120)]
    assert found(spark, rows, block=8, blocks=3) == brute(rows)
    rows = vectors(200, 40, 2)
    assert found(spark, rows, block=16, blocks=2) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0, 0, "", ""),
        (2, [2.0, 0.0, 0.0], 0, 0, "", ""),
        (3, [2.0, 0.0, 0.0], 0, 0, "", ""),
        (4, None, 0, 0, "", ""),
        (5, [], 0, 0, "", ""),
        (6, [0.0, 0.0, 0.0], 0, 0, "", ""),
        (7, [1.0, None, 0.0], 0, 0, "", ""),
        (8, [nan, 1.0, 0.0], 0, 0, "", ""),
        (9, [inf, 1.0, 0.0], 0, 0, "", ""),
        (10, [1.0, 0.0], 0, 0, "", ""),
        (11, [3e38, 0.0, 0.0], 0, 0, "", ""),
        (12, [1e-38, 1e-40, 0.0], 0, 0, "", ""),
        (13, [-1.0, 0.0, 0.0], 0, 0, "", ""),
        (14, [1.0], None, None, None, None),
    ]
    assert found(spark, rows) == brute(rows)


def test_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None, 0, 0, "", "")]) == [(1, 0, 1, True)]


def test_null_id_counts_as_a_copy(spark):
    rows = [(None, [1.0, 0.0], 0, 0, "", ""), (1, [1.0, 0.0], 0, 0, "", ""), (None, [0.0, 1.0], 0, 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in near_vectors(df).collect()}
    assert (1, 1, 1) in got and (None, 1, 1) in got and len(got) == 3


def test_null_ids_lose_no_links(spark):
    """A vector whose class has no id at all still links with other classes, and ids shared by classes are kept apart."""
    rows = [(1, [1.0, 0.0], 0, 0, "", ""), (None, [1.0, 0.01], 0, 0, "", ""), (7, [0.0, 1.0], 0, 0, "", ""), (7, [0.01, 1.0], 0, 0, "", ""),
            (7, [-1.0, 0.0], 0, 0, "", ""), (None, [1.0, -1.0], 0, 0, "", ""), (9, [1.0, 0.02], 0, 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(df).collect()), key=str)
    want = [(1, 2, 1, True), (0, 2, 1, False), (9, 2, 1, False), (7, 1, 7, True), (7, 1, 7, True), (7, 0, 7, True), (0, 0, None, True)]
    assert got == sorted(want, key=str)
