import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler

from ledgerlens.operators import logistic
from ledgerlens.operators.logistic import LogisticModel
from ledgerlens.operators.ranking import classification_metrics, metrics_by, roc_auc

COLUMNS = ["a", "b", "c"]


def rows_of(n=400, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b = float(rng.normal()), float(rng.normal(1000, 300))
        c = None if i % 7 == 0 else float(rng.integers(5))
        p = 1 / (1 + math.exp(-(a - 0.002 * b + 0.5 * (c or 0) + 0.7)))
        out.append((a, b, c, int(rng.random() < p)))
    return out


SCHEMA = "a double, b double, c double, label int"


def numpy_fit(rows, penalty, intercept):
    x = np.array([[a, b, c or 0.0] + [1.0] * intercept for a, b, c, _ in rows])
    y = np.array([r[3] for r in rows], float)
    shrink = np.diag([penalty] * 3 + [0.0] * intercept)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x.T * (p * (1 - p))) @ x + shrink
        w = w - np.linalg.solve(h, x.T @ (p - y) + shrink @ w)
    return w, np.sqrt(np.diag(np.linalg.inv((x.T * (p * (1 - p))) @ x)))


@pytest.mark.parametrize(("penalty", "intercept"), [(0.0, False), (1.0, True), (50.0, True)])
def test_weights_and_errors(spark, penalty, intercept):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA)
    model = logistic.fit(df, COLUMNS, "label", penalty, intercept)
    w, errors = numpy_fit(rows, penalty, intercept)
    assert model.converged and model.steps < 15
    assert [*model.weights, model.intercept][: len(w)] == pytest.approx(w, rel=1e-6)
    assert model.errors == pytest.approx(errors[:3], rel=1e-5)
    assert LogisticModel.from_json(model.to_json()) == model
    for r in logistic.score_equations(df, model, "label").collect():
        assert r.labelled == pytest.approx(r.explained, abs=1e-9)


def test_other_weights_do_not_fulfil_the_equations(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    model = logistic.fit(df, COLUMNS, "label")
    model.weights[0] += 0.01
    assert any(abs(r.labelled - r.explained) > 1e-5 for r in logistic.score_equations(df, model, "label").collect())


def test_as_the_library_fits(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA).fillna(0.0)
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df)
    library = LogisticRegression(labelCol="label", regParam=2.0 / df.count(), standardization=False, maxIter=500, tol=1e-12).fit(vectors)
    model = logistic.fit(df, COLUMNS, "label", 2.0)
    assert model.weights == pytest.approx(library.coefficients.toArray(), rel=1e-3)


def test_odd_tables(spark):
    # labels that can be told apart, a column that is always 0, one label, no rows
    apart = spark.createDataFrame([(float(i), 0.0, 1.0, int(i > 10)) for i in range(20)], SCHEMA)
    model = logistic.fit(apart, COLUMNS, "label")
    assert all(math.isfinite(w) for w in model.weights)
    for r in logistic.score_equations(apart, model, "label").collect():
        assert (r.labelled is None) == (r.feature == "b")
        assert r.labelled is None or r.labelled == pytest.approx(r.explained, abs=1e-6)
    one = logistic.fit(spark.createDataFrame([(1.0, 2.0, None, 1)] * 5, SCHEMA), COLUMNS, "label", 1.0)
    assert all(math.isfinite(w) for w in one.weights)
    none = logistic.fit(spark.createDataFrame([], SCHEMA), COLUMNS, "label")
    assert none.weights == [0.0] * 3


@pytest.mark.parametrize("ranges", [2, 7, 4096])
def test_metrics_by_group(spark, ranges):
    rng = np.random.default_rng(3)
    rows = [("ab"[int(rng.random() < 0.9)], "xy"[i % 2], float(rng.integers(30)) / 30, int(rng.random() < 0.4), int(rng.random() < 0.5)) for i in range(600)]
    rows += [("one", "x", 0.5, 1, 1)] * 4 + [("c", "x", None, 1, 0), ("c", "x", 0.5, None, 0), ("c", "x", 0.1, 0, 0), ("c", "x", float("nan"), 1, 1)]
    df = spark.createDataFrame(rows, "model string, part string, s double, y int, p int")
    got = {(r.model, r.part): r for r in metrics_by(df, ["model", "part"], "s", "y", "p", ranges).collect()}
    assert set(got) == {("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("one", "x"), ("c", "x")}
    for key in (("a", "x"), ("b", "y")):
        own = df.filter((df.model == key[0]) & (df.part == key[1]))
        rates, r = classification_metrics(own, "y", "p").first(), got[key]
        assert r.auc == roc_auc(own, "s", "y").first()["auc"] and r.n == own.count()
        assert (r.precision, r.recall, r.accuracy, r.f1) == (rates["precision"], rates["recall"], rates["accuracy"], rates["f1"])
    assert got["one", "x"].auc is None and got["one", "x"].recall == 1 and got["c", "x"].n == 1 and got["c", "x"].f1 is None
