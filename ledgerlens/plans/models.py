"""Loss classifiers on the twelve model inputs, and what they score."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import boosting, forest, logistic
from ledgerlens.operators.boosting import Settings
from ledgerlens.operators.forest import Forest
from ledgerlens.operators.logistic import LogisticModel
from ledgerlens.schemas import TRAIN_VARS
from ledgerlens.sources import files

LABEL = "if_loss"
LossModel = PipelineModel | boosting.Model | Forest | LogisticModel


def complete_rows(df: DataFrame) -> DataFrame:
    """Model inputs as double, missing ones 0, for models without a branch for missing values."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in TRAIN_VARS})


def fit_boosted(df: DataFrame, trees: int = 100, depth: int = 3, rate: float = 0.1, store: str | None = None) -> boosting.Model:
    """Boosted trees of second order with the common defaults; the main model. Missing inputs have a branch."""
    return boosting.fit(df, TRAIN_VARS, LABEL, Settings(trees, depth, rate), store)


def fit_gbdt(df: DataFrame, trees: int = 3000, depth: int = 2, rate: float = 0.1, store: str | None = None) -> boosting.Model:
    """Many small trees that follow the gradients, for comparison. Given a folder, the fit goes on where it ended."""
    settings = Settings(trees, depth, rate, penalty=0.0, least_weight=0.0, second_order=False)
    return boosting.fit(df, TRAIN_VARS, LABEL, settings, store)


def fit_forest(df: DataFrame, trees: int = 100, depth: int = 30, seed: int = 0) -> Forest:
    """A forest whose trees grow until leaves are pure, or to depth 30."""
    return forest.fit(complete_rows(df), TRAIN_VARS, LABEL, trees, depth, seed)


def fit_logistic(df: DataFrame, c: float = 1.0) -> LogisticModel:
    """Logistic regression with an L2 penalty of strength 1/c over the sum of losses; inputs are not scaled."""
    return logistic.fit(df, TRAIN_VARS, LABEL, 1.0 / c)


def fit_logit(df: DataFrame) -> LogisticModel:
    """A logit without intercept or penalty."""
    return logistic.fit(df, TRAIN_VARS, LABEL, intercept=False)


def logit_summary(df: DataFrame) -> DataFrame:
    """(feature, coefficient, std_error, z, p_value) of a logit without intercept or penalty. One line per model input."""
    model = fit_logit(df)
    lines = []
    for c, w, error in zip(model.columns, model.weights, model.errors):
        z = w / error if error > 0 else None
        lines.append((c, w, error, z, None if z is None else math.erfc(abs(z) / math.sqrt(2))))
    schema = "feature string, coefficient double, std_error double, z double, p_value double"
    return df.sparkSession.createDataFrame(lines, schema)


def feature_importance(model: LossModel) -> DataFrame:
    """(feature, importance), the most important first. One line per model input; importances sum up to 1."""
    if isinstance(model, boosting.Model | Forest):
        rows = list(model.importance().items())
    else:
        rows = [(c, float(w)) for c, w in zip(TRAIN_VARS, model.stages[-1].featureImportances.toArray())]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def score(model: LossModel, df: DataFrame) -> DataFrame:
    """Input columns with prob_0, prob_1, hard label `predicted` and score = chance of no loss x 1000."""
    if isinstance(model, PipelineModel):
        kept = df.columns
        scored = model.transform(complete_rows(df.withColumn("_row", F.struct(*kept))))
        loss = scored.select("_row.*", vector_to_array("probability")[1].alias("prob_1"))
    elif isinstance(model, Forest):
        inputs = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in model.columns])
        loss = df.withColumn("prob_1", model.chance(inputs))
    else:
        loss = df.withColumn("prob_1", 1 / (1 + F.exp(-model.margin())))
    return loss.select(
        *df.columns,
        (1 - F.col("prob_1")).alias("prob_0"),
        "prob_1",
        (F.col("prob_1") > 0.5).cast("int").alias("predicted"),
        ((1 - F.col("prob_1")) * 1000).alias("score"),
    )


def load_model(path: str) -> LossModel:
    return files.load_model(path, boosting.Model, Forest, LogisticModel)


def linear_loss(weights: dict[str, float], intercept: float) -> Column:
    """Chance of loss by a scorecard of given weights; missing inputs count 0, as for fitted models."""
    margin = F.lit(float(intercept))
    for c, w in weights.items():
        margin = margin + F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
    return 1 / (1 + F.exp(-margin))


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float) -> DataFrame:
    """The same columns as `score`, from a scorecard."""
    loss = linear_loss(weights, intercept)
    return df.withColumns(
        {
            "prob_0": 1 - loss,
            "prob_1": loss,
            "predicted": (loss > 0.5).cast("int"),
            "score": (1 - loss) * 1000,
        }
    )
