import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile, quantiles, ranking


def column(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(5)


CASES = {
    "even": list(range(1000)),
    "one": [3.5],
    "two": [1, 2],
    "ties": [1] * 700 + [2] * 200 + list(range(3, 103)),
    "hot middle": list(range(300)) + [150.5] * 400 + list(range(300, 600)),
    "skewed": [1.001**i for i in range(2000)],
    "with nulls": [None, 4, None, 1, 2, 3, None],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("accuracy, rows", [(10_000, 5_000_000), (20, 5_000_000), (20, 50)])
def test_exact_quantiles(spark, name, accuracy, rows):
    """Exact also where the sketch is coarse and brackets have to be narrowed."""
    probs = (0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1)
    got = quantiles.exact_quantiles(column(spark, CASES[name]), ["v"], probs, accuracy, rows)["v"]
    present = [v for v in CASES[name] if v is not None]
    assert np.allclose(got, np.quantile(present, probs), rtol=1e-12)


def test_missed_brackets_are_widened(spark, monkeypatch):
    """A sketch that is far off costs a pass, not the result."""
    real = quantiles._brackets

    def wrong(df, columns, probs, accuracy):
        for key, h, _, full in real(df, columns, probs, accuracy):
            yield key, h, (-5.0, -4.0), full

    monkeypatch.setattr(quantiles, "_brackets", wrong)
    assert quantiles.exact_quantiles(column(spark, range(101)), ["v"], (0.25, 0.5))["v"] == [25.0, 50.0]


def test_empty_and_nan(spark):
    assert quantiles.exact_quantiles(column(spark, [None, None]), ["v"], (0.5,)) == {"v": [None]}
    assert quantiles.exact_quantiles(column(spark, [1, float("nan"), 2]), ["v"], (0.5,)) == {"v": [1.5]}


def test_bins_equal_qcut(spark):
    rng = random.Random(1)
    values = [rng.choice([round(rng.gauss(0, 1), 2), rng.random()]) for _ in range(997)]
    df = spark.createDataFrame([(i, v, i % 3) for i, v in enumerate(values)], "i int, v double, t int")
    edges = quantiles.quantile_edges(df, "v", 10)
    codes, bins = pd.qcut(pd.Series(values), 10, labels=False, retbins=True)
    assert np.allclose(edges, bins)
    got = df.select("i", quantiles.quantile_bin(F.col("v"), edges).alias("b")).orderBy("i").collect()
    assert [r.b for r in got] == [c + 1 for c in codes]


def test_equal_edges_raise(spark):
    with pytest.raises(ValueError):
        quantiles.quantile_edges(column(spark, [1] * 50 + [2, 3]), "v", 10)


def test_distribution_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(float(i), 1 if i == 3 else 0) for i in range(8)], "v double, t int")
    rows = quantiles.score_distribution(df, "v", 1, "t").collect()
    assert [(r.bin, r.n, r.total, r["mean"], r.mean_2) for r in rows] == [(1, 8, 1.0, 0.125, 0.12)]


def brute_auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [2, 7, 1024])
def test_auc_and_curve(spark, ranges):
    rng = random.Random(ranges)
    # a third of all rows share one score
    pairs = [(0.5 if rng.random() < 1 / 3 else round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "s double, y int").repartition(6)
    row = ranking.roc_auc(df, "s", "y", ranges).first()
    assert abs(row.auc - brute_auc(pairs)) < 1e-12
    p, n = row.n_pos, row.n_neg
    curve = ranking.roc_curve(df, "s", "y", ranges).collect()
    assert len(curve) == len({s for s, _ in pairs}) + 1
    assert (max(s for s, _ in pairs) + 1, 0.0, 0.0) in [tuple(c) for c in curve]
    for point in curve:
        assert abs(point.tpr - sum(y and s >= point.threshold for s, y in pairs) / p) < 1e-12
        assert abs(point.fpr - sum((not y) and s >= point.threshold for s, y in pairs) / n) < 1e-12


def test_no_skill_and_one_class(spark):
    df = spark.createDataFrame([(0.0, i % 2) for i in range(10)], "s double, y int")
    assert ranking.roc_auc(df, "s", "y").first().auc == 0.5
    assert ranking.roc_auc(df.filter("y = 1"), "s", "y").first().auc is None


def test_metrics(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] * 4 + [(0, 0)] * 5
    df = spark.createDataFrame(rows, "y int, p int")
    m = ranking.classification_metrics(df, "y", "p").first()
    assert (m.tp, m.fp, m.fn, m.tn) == (3, 2, 4, 5)
    assert np.allclose([m.precision, m.recall, m.accuracy, m.f1], [3 / 5, 3 / 7, 8 / 14, 2 / (5 / 3 + 7 / 3)])
    none = ranking.classification_metrics(df.filter("p = 0"), "y", "p").first()
    assert none.precision is None and none.f1 is None
    assert {(r.label, r.prediction): r.n for r in ranking.confusion(df, "y", "p").collect()} == {
        (1, 1): 3, (0, 1): 2, (1, 0): 4, (0, 0): 5}


def test_profiles(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 10.0, 3.0], "b": [2.0, None, 5.0, 1.0, 4.0]})
    df = spark.createDataFrame([(None if x != x else x, None if y != y else y) for x, y in pdf.values.tolist()],
                               "a double, b double")
    assert {r.name: r.null_rate for r in profile.null_rates(df).collect()} == {"a": 0.2, "b": 0.2}
    got = {r.name: r for r in profile.describe_exact(df).collect()}
    for c in "ab":
        want = pdf[c].describe()
        r = got[c]
        assert np.allclose([r["count"], r["mean"], r["std"], r["min"], r.q25, r.q50, r.q75, r["max"]], want)
    corr = {(r.a, r.b): r.r for r in profile.correlation_matrix(df).collect()}
    assert abs(corr[("a", "b")] - pdf.corr().loc["a", "b"]) < 1e-12 and abs(corr[("a", "a")] - 1) < 1e-12
    text = df.withColumn("t", F.lit("x"))
    assert profile.categorical_numerical(text) == (["t"], ["a", "b"])
