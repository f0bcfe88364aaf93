import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.operators import forest
from ledgerlens.operators.forest import Forest, Top, Tree, drawn, fit
from ledgerlens.plans import models
from ledgerlens.schemas import TRAIN_VARS
from ledgerlens.sources import files

COLUMNS = ["a", "b", "c"]
SCHEMA = "key long, a double, b double, c double, label int"


def rows_of(seed, n=300):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.randrange(6) + 0.0, round(rng.gauss(0, 2), 2), rng.randrange(30) + 0.0
        out.append((i, a, b, c, int((a > 3) + (b > 1) - c / 20 + rng.gauss(0, 0.3) > 0)))
    return out


def chances(model, df):
    return {r.key: r.p for r in df.select("key", model.chance().alias("p")).collect()}


def brute(bins, label, weight, heap, levels, tries, tree, seed):
    """(column, bin, left, right) or a leaf's share of ones, row by row."""
    at = [i for i in range(len(label)) if weight[i]]
    n, ones = sum(int(weight[i]) for i in at), sum(int(weight[i]) * int(label[i]) for i in at)
    order = np.argsort(forest._mixed(seed, tree, heap, np.arange(bins.shape[1])), kind="stable")
    columns = [c for c in order.tolist() if len({bins[i, c] for i in at}) > 1][:tries]
    if not levels or ones in (0, n) or not columns:
        return ones / n
    best = None
    for c in columns:
        for cut in sorted({int(bins[i, c]) for i in at})[:-1]:
            left = [i for i in at if bins[i, c] <= cut]
            n1, p1 = sum(int(weight[i]) for i in left), sum(int(weight[i]) * int(label[i]) for i in left)
            mixed = p1 * (n1 - p1) / n1 + (ones - p1) * (n - n1 - ones + p1) / (n - n1)
            if best is None or mixed < best[0]:
                best = mixed, c, cut
    _, c, cut = best
    sides = [np.where(bins[:, c] <= cut, weight, 0), np.where(bins[:, c] > cut, weight, 0)]
    return c, cut, *[brute(bins, label, w, 2 * heap + i, levels - 1, tries, tree, seed) for i, w in enumerate(sides, 1)]


def nested(tree, at=0):
    if tree.column[at] < 0:
        return float(tree.chance[at])
    left = int(tree.left[at])
    return int(tree.column[at]), int(tree.bin[at]), nested(tree, left), nested(tree, left + 1)


@pytest.mark.parametrize("depth", [3, 30])
def test_trees_are_those_of_brute_force(depth):
    rng = np.random.default_rng(depth)
    bins = rng.integers(1, 9, (120, 4)).astype(np.uint8)
    label = (bins[:, 0] + rng.integers(0, 5, 120) > 7).astype(int)
    for tree in range(3):
        weight = drawn(np.arange(120), tree, 5)
        here = weight > 0
        got = forest.grown(bins[here], label[here], weight[here], 0, depth, 2, tree, 5)
        assert nested(got) == brute(bins, label, weight, 0, depth, 2, tree, 5)
        assert nested(Top().whole({0: got}, 4)) == nested(got) == nested(Tree.unpacked(got.packed()))


def test_draws_have_a_mean_of_one():
    counts = np.bincount(drawn(np.arange(200_000), 3, 0), minlength=5) / 200_000
    assert counts[:4] == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.004)


def test_large_nodes_are_split_level_by_level_to_the_same_trees(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(1), SCHEMA)
    whole = fit(df, COLUMNS, "label", trees=4)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 40)
    parts = fit(df, COLUMNS, "label", trees=4)
    assert [nested(t) for t in parts.trees] == [nested(t) for t in whole.trees]
    assert parts.importance() == pytest.approx(whole.importance())
    assert sum(whole.importance().values()) == pytest.approx(1)


def test_counts_of_many_nodes_are_given_a_few_at_a_time(monkeypatch):
    """One batch of rows held the counts of all trees and nodes that it came to."""
    rng = np.random.default_rng(0)
    ids, bins, label = np.arange(200), rng.integers(0, 20, (200, 2)).astype(np.uint8), rng.integers(0, 2, 200)
    tops = [Top({0: (0, 9, 1.0), 1: (1, 9, 1.0), 2: (1, 9, 1.0)}) for _ in range(5)]
    active = {(t, node) for t in range(5) for node in (3, 4, 6)}
    monkeypatch.setattr(forest, "HELD", 4)
    given = list(forest._counts([(ids[:90], bins[:90], label[:90]), (ids[90:], bins[90:], label[90:])], tops, active, 2, 7))
    assert max(len(held) for held in given) <= 4
    for t, node in active:
        sums = sum(held[t, node] for held in given if (t, node) in held)
        weight, right = drawn(ids, t, 7), bins > 9
        here = {3: ~right[:, 0] & ~right[:, 1], 4: ~right[:, 0] & right[:, 1], 6: right[:, 0] & right[:, 1]}[node]
        assert sums.reshape(2, forest.BINS, 2)[1, 12].tolist() == [(weight * here * (bins[:, 1] == 12) * k).sum() for k in (1, label)]
    assert {k for held in given for k in held} == active


def test_rows_of_a_block_come_in_one_batch(spark, monkeypatch):
    """Batches of 10,000 rows sent the counts of a node once for each."""
    df = spark.createDataFrame(rows_of(3, 60), SCHEMA).coalesce(1)
    sizes, splits = [], forest._splits

    def watched(rows, *rest):
        found = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [len(b)]}) for b in batches), "n long").collect()
        sizes.append(sorted(r.n for r in found))
        return splits(rows, *rest)

    monkeypatch.setattr(forest, "_splits", watched)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        fit(df, COLUMNS, "label", trees=2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sizes[0] == [10, 50]


def test_leaves_are_pure_and_text_form(spark):
    """Fitted, kept as text, read back, and scored without classes of `pyspark.ml` in the tasks."""
    rows = [(i, *[float((i * k) % 41) for k in range(1, len(TRAIN_VARS) + 1)], i % 3 // 2) for i in range(1, 41)]
    df = spark.createDataFrame(rows, ["key", *TRAIN_VARS, "if_loss"])
    model = models.fit_forest(df, trees=20)
    assert isinstance(model, Forest) and all(set(t.chance[t.column < 0]) <= {0.0, 1.0} for t in model.trees)
    path = files.work_folder(spark, "model")
    files.save_model(model, path)
    again = models.load_model(path)
    scored = {r.key: r for r in models.score(again, df).collect()}
    assert sum(r.predicted == r.if_loss for r in scored.values()) > 30
    assert {k: r.prob_1 for k, r in scored.items()} == chances(model, df)
    # missing inputs count 0
    empty = models.score(model, df.selectExpr("key", *[f"cast(null as double) {c}" for c in TRAIN_VARS])).first()
    zero = models.score(model, df.selectExpr("key", *[f"0D {c}" for c in TRAIN_VARS])).first()
    assert empty.prob_1 == zero.prob_1 and models.feature_importance(model).count() == len(TRAIN_VARS)


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert fit(none, COLUMNS, "label", trees=2).trees == []
    one_label = spark.createDataFrame([(i, None, 2.0, float(i), 1) for i in range(20)], SCHEMA)
    assert set(chances(fit(one_label, COLUMNS, "label", trees=3), one_label).values()) == {1.0}
    same = spark.createDataFrame([(i, 1.0, 1.0, 1.0, i % 2) for i in range(40)], SCHEMA)
    model = fit(same, COLUMNS, "label", trees=3)
    assert all(len(t.column) == 1 and 0 < t.chance[0] < 1 for t in model.trees)


def test_a_block_takes_as_many_jobs_for_many_deep_trees_as_for_few(spark):
    df = spark.createDataFrame(rows_of(2, 60), SCHEMA)

    def jobs_of(trees, depth):
        group = f"forest of {trees}"
        spark.sparkContext.setJobGroup(group, group)
        assert len(fit(df, COLUMNS, "label", trees, depth).trees) == trees
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    try:
        assert jobs_of(2, 1) == jobs_of(12, 30) < 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
