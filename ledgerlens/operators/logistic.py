"""Logistic regression by Newton's method, and the equations that its weights must fulfil.

Each step is one aggregation: the sums of gradient, curvature and loss at the present weights, some hundred numbers for a
dozen inputs, whatever the rows. The driver solves for the next weights. A step that would raise the loss is halved.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: greatest gradient, by row and in units of the inputs' own size, at which the weights count as found
TOLERANCE = 1e-12


@dataclass
class LogisticModel:
    """Weights of named inputs; missing inputs count 0."""

    columns: list[str]
    weights: list[float]
    intercept: float
    errors: list[float]  # standard errors of the weights, without regard to a penalty
    penalty: float
    steps: int
    converged: bool

    def margin(self) -> Column:
        return _margin(self.columns, self.weights, self.intercept)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> LogisticModel:
        return LogisticModel(**json.loads(text))


def _input(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def _margin(columns: list[str], weights: list[float], intercept: float) -> Column:
    return sum((_input(c) * F.lit(float(w)) for c, w in zip(columns, weights)), F.lit(float(intercept)))


def _sums(rows: DataFrame, width: int, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and curvature over rows of `label` and inputs x0, x1, ..."""
    x = [F.col(f"x{i}") for i in range(width)]
    margin = sum((v * F.lit(float(w)) for v, w in zip(x, weights)), F.lit(0.0))
    # softplus without overflow
    loss = F.greatest("m", F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("label") * F.col("m")
    at = rows.withColumn("m", margin).withColumn("p", 1 / (1 + F.exp(-F.col("m"))))
    curved = at.withColumns({"loss": loss, "off": F.col("p") - F.col("label"), "c": F.col("p") * (1 - F.col("p"))})
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = curved.agg(
        F.sum("loss"), *[F.sum(v * F.col("off")) for v in x], *[F.sum(x[i] * x[j] * F.col("c")) for i, j in pairs]
    ).first()
    values = np.array([v or 0.0 for v in row])
    curvature = np.zeros((width, width))
    for (i, j), v in zip(pairs, values[1 + width :]):
        curvature[i, j] = curvature[j, i] = v
    return float(values[0]), values[1 : 1 + width], curvature


def fit(df: DataFrame, columns: list[str], label: str, penalty: float = 0.0, intercept: bool = True, steps: int = 100) -> LogisticModel:
    """Weights that minimise the summed loss plus half the penalty times their squares, the intercept aside.

    Missing inputs count 0; rows without a label are left out. Inputs are scaled to a mean square of 1 for the solution
    alone. Where labels can be told apart without error and nothing is penalised, weights grow until the gradient is nil.
    """
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("label"), *[_input(c).alias(f"x{i}") for i, c in enumerate(columns)]
    )
    sizes = rows.agg(F.count("*").alias("n"), *[F.avg(F.col(f"x{i}") * F.col(f"x{i}")).alias(f"s{i}") for i in range(len(columns))]).first()
    n = max(1, sizes["n"])
    scale = np.array([(sizes[f"s{i}"] or 0.0) ** 0.5 or 1.0 for i in range(len(columns))] + [1.0] * intercept)
    width = len(scale)
    scaled = rows.select("label", *[(F.col(f"x{i}") / F.lit(float(scale[i]))).alias(f"x{i}") for i in range(len(columns))])
    if intercept:
        scaled = scaled.withColumn(f"x{width - 1}", F.lit(1.0))
    shrink = np.array([penalty / s**2 for s in scale[: len(columns)]] + [0.0] * intercept)

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, curvature = _sums(scaled, width, w)
        return loss + float(shrink @ w**2) / 2, gradient + shrink * w, curvature

    w = np.zeros(width)
    loss, gradient, curvature = at(w)
    taken = 0
    while taken < steps and np.abs(gradient).max(initial=0) > TOLERANCE * n:
        step = np.linalg.lstsq(curvature + np.diag(shrink), gradient, rcond=1e-13)[0]
        new, found = w - step, None
        for _ in range(30):
            found = at(new)
            if found[0] <= loss + 1e-9 * abs(loss) + 1e-12:
                break
            step /= 2
            new = w - step
        taken += 1
        still = np.abs(found[1]).max() >= np.abs(gradient).max() and found[0] >= loss
        if still:
            # rounding is all that is left
            break
        w, (loss, gradient, curvature) = new, found
    converged = bool(np.abs(gradient).max(initial=0) <= 1e-8 * n)
    errors = np.sqrt(np.maximum(np.diag(np.linalg.pinv(curvature)), 0)) / scale
    weights = (w / scale).tolist()
    base = weights.pop() if intercept else 0.0
    return LogisticModel(list(columns), weights, base, errors[: len(columns)].tolist(), penalty, taken, converged)


def score_equations(df: DataFrame, model: LogisticModel, label: str) -> DataFrame:
    """(feature, labelled, explained): each input summed up over the rows labelled 1, and over all rows by their chance.

    At the weights of a fit the two are equal, the penalty's pull added to the second. Both are shares of the input's
    summed size, null where that is 0.
    """
    chance = 1 / (1 + F.exp(-model.margin()))
    rows = df.where(F.col(label).isNotNull()).withColumn("__p", chance)
    row = rows.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.try_divide(F.sum(_input(c) * F.col(label).cast("double")), F.sum(F.abs(_input(c)))).alias("labelled"),
                F.try_divide(F.sum(_input(c) * F.col("__p")) + F.lit(float(w * model.penalty)), F.sum(F.abs(_input(c)))).alias("explained"),
            ).alias(f"e{i}")
            for i, (c, w) in enumerate(zip(model.columns, model.weights))
        ]
    )
    return row.select(F.explode(F.array(*[f"e{i}" for i in range(len(model.columns))])).alias("e")).select("e.*")
