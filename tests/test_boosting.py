import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import boosting
from ledgerlens.operators.boosting import Model, Settings, fit
from ledgerlens.sources import files

COLUMNS = ["a", "b", "c"]
SCHEMA = "key long, a double, b double, c double, label int, d string"


def rows_of(seed, n=200):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b = rng.choice([None, 1.0, 2.0, 3.5, 7.0]), round(rng.gauss(0, 2), 2)
        c = None if rng.random() < 0.3 else float(rng.randrange(30))
        risk = (a is None) * 1.5 + (b > 1) - (c or 10) / 10 + rng.gauss(0, 0.7)
        out.append((i, a, b if rng.random() < 0.9 else math.nan, c, int(risk > 0), "x"))
    return out


def missing(v):
    return v is None or v != v


class BruteTree:
    """The same tree, row by row, from thresholds instead of bins; sums in whole numbers of the same unit."""

    def __init__(self, rows, gradients, curvatures, at, depth, settings):
        self.split, self.value = None, 0.0
        unit = boosting.UNIT

        def worth(g, h, n):
            below = h / unit + settings.penalty if settings.second_order else n
            return (g / unit) ** 2 / below if below > 0 else 0.0

        whole = (sum(gradients[i] for i in at), sum(curvatures[i] for i in at), len(at))
        best = (boosting.LEAST_GAIN, None)
        if depth:
            for column in range(len(COLUMNS)):
                known = sorted({rows[i][column] for i in at if not missing(rows[i][column])} | set(ALL[column]))
                for threshold in known:
                    for missing_left in (False, True):
                        left = [i for i in at if (missing_left if missing(rows[i][column]) else rows[i][column] <= threshold)]
                        g, h = sum(gradients[i] for i in left), sum(curvatures[i] for i in left)
                        n, others = len(left), len(at) - len(left)
                        if not n or not others:
                            continue
                        if settings.second_order and min(h, whole[1] - h) < settings.least_weight * unit:
                            continue
                        gain = worth(g, h, n) + worth(whole[0] - g, whole[1] - h, others) - worth(*whole)
                        if gain > best[0]:
                            best = (gain, (column, threshold, missing_left, n, others))
        if best[1] is None:
            below = whole[1] / unit + (settings.penalty if settings.second_order else 0)
            self.value = -whole[0] / unit / below * settings.rate if below > 0 else 0.0
            return
        column, threshold, missing_left, n, others = best[1]
        if not any(missing(rows[i][column]) for i in at):
            missing_left = n > others
        self.split = column, threshold, missing_left
        sides = [[], []]
        for i in at:
            sides[not self.left(rows[i])].append(i)
        self.children = [BruteTree(rows, gradients, curvatures, s, depth - 1, settings) for s in sides]

    def left(self, row):
        column, threshold, missing_left = self.split
        return missing_left if missing(row[column]) else row[column] <= threshold

    def margin(self, row):
        return self.value if self.split is None else self.children[not self.left(row)].margin(row)


def brute(rows, settings):
    global ALL
    values, labels = [r[1:4] for r in rows], [r[4] for r in rows]
    ALL = [sorted({v[c] for v in values if not missing(v[c])}) for c in range(3)]
    share = sum(labels) / len(labels)
    base = 0.0 if settings.second_order else math.log(share / (1 - share))
    margins = [base] * len(rows)
    for _ in range(settings.trees):
        chances = [1 / (1 + math.exp(-m)) for m in margins]
        gradients = [round((p - y) * boosting.UNIT) for p, y in zip(chances, labels)]
        curvatures = [round(p * (1 - p) * boosting.UNIT) for p in chances]
        tree = BruteTree(values, gradients, curvatures, list(range(len(rows))), settings.depth, settings)
        margins = [m + tree.margin(v) for m, v in zip(margins, values)]
    return dict(zip((r[0] for r in rows), margins))


def margins(model, df):
    return {r.key: r.m for r in df.select("key", model.margin().alias("m")).collect()}


@pytest.mark.parametrize("settings", [Settings(trees=6, depth=3, rate=0.3), Settings(trees=8, depth=2, second_order=False), Settings(trees=3, depth=4, least_weight=5.0, penalty=0.0)])
def test_trees_are_those_of_brute_force(spark, settings):
    rows = rows_of(settings.depth)
    df = spark.createDataFrame(rows, SCHEMA)
    got = margins(fit(df, COLUMNS, "label", settings, every=3), df)
    assert got == pytest.approx(brute(rows, settings), abs=1e-9)


def test_missing_values_have_a_branch(spark):
    """Only whether a value is there tells the labels apart; a 0 in its place does not."""
    rows = [(i, None if i % 3 == 0 else 0.0, 1.0, 1.0, int(i % 3 == 0), "x") for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit(df, COLUMNS, "label", Settings(trees=5, depth=1))
    got = margins(model, df)
    assert all((got[i] > 0) == (i % 3 == 0) for i in got)


def test_partitioning_does_not_matter_and_text_form(spark):
    df = spark.createDataFrame(rows_of(9, 120), SCHEMA)
    settings = Settings(trees=4)
    one = fit(df.coalesce(1), COLUMNS, "label", settings)
    assert one.to_json() == fit(df.repartition(7, "b"), COLUMNS, "label", settings).to_json()
    path = files.work_folder(spark, "model")
    files.save_model(one, path)
    again = files.load_model(path, Model)
    assert again == one and margins(again, df) == margins(one, df)
    importance = one.importance()
    assert set(importance) == set(COLUMNS) and sum(importance.values()) == pytest.approx(1)


def test_fits_go_on_from_what_is_kept(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(10, 120), SCHEMA)
    whole = fit(df, COLUMNS, "label", Settings(trees=7, depth=2))
    store = files.work_folder(spark, "boosting")
    grown = []
    grow = boosting.grow

    def failing(sums_of, settings):
        if len(grown) == 5:
            raise RuntimeError("lost")
        grown.append(1)
        return grow(sums_of, settings)

    monkeypatch.setattr(boosting, "grow", failing)
    with pytest.raises(RuntimeError):
        fit(df, COLUMNS, "label", Settings(trees=7, depth=2), store, every=2)
    monkeypatch.setattr(boosting, "grow", lambda *a: (grown.append(1), grow(*a))[1])
    resumed = fit(df, COLUMNS, "label", Settings(trees=7, depth=2), store, every=2)
    assert resumed.to_json() == whole.to_json()
    # four trees were kept of five
    assert len(grown) == 5 + 3
    with pytest.raises(ValueError):
        fit(df, ["a"], "label", Settings(), store)


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert fit(none, COLUMNS, "label", Settings()).trees == []
    unlabelled = spark.createDataFrame([(1, 1.0, 1.0, None, None, "x")], SCHEMA)
    assert fit(unlabelled, COLUMNS, "label", Settings()).trees == []
    # one label, and columns that never vary or are never there
    rows = [(i, None, 2.0, None, 1, "x") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit(df, COLUMNS, "label", Settings(trees=3))
    assert len(model.trees) == 3 and len(set(margins(model, df).values())) == 1 and min(margins(model, df).values()) > 0
    assert set(model.importance().values()) == {0.0}
    assert fit(df, COLUMNS, "label", Settings(trees=2, second_order=False)).base == 0.0
    assert df.select(F.lit(1)).count() == 20


def test_a_block_takes_as_many_jobs_for_many_trees_as_for_few(spark, monkeypatch):
    df = spark.createDataFrame(rows_of(11, 150), SCHEMA)
    settings = Settings(trees=45, depth=2, second_order=False)

    def jobs_of(group, settings):
        spark.sparkContext.setJobGroup(group, group)
        model = fit(df, COLUMNS, "label", settings, every=4)
        return model, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    try:
        few, at_first = jobs_of("few trees", Settings(trees=3, depth=2, second_order=False))
        many, then = jobs_of("many trees", settings)
        assert at_first == then
        # the same trees level by level, in files of a few rows each
        monkeypatch.setattr(boosting, "BLOCK_ROWS", 20)
        by_level, jobs = jobs_of("by level", settings)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs > 90 and by_level.to_json() == many.to_json()
    assert many.trees[:3] == few.trees
