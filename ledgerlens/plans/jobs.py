"""The end-to-end jobs: train a model, score and price customers in batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import age
from ledgerlens.functions.pricing import BAND_EDGES, PRICING_APPLIED, PricingRules, offer
from ledgerlens.operators.campaign import amount_diff
from ledgerlens.operators.preparation import (
    add_ratios,
    cast_features,
    clean_text_features,
    encode_pdtype,
    fit_medians,
    impute,
    label_loss,
    scorable,
    split,
    valid_training_rows,
)
from ledgerlens.operators.quantiles import score_distribution
from ledgerlens.operators.ranking import metrics_by
from ledgerlens.plans.features import production_features, training_features
from ledgerlens.plans.models import LABEL, LossModel, fit_boosted, load_model, score
from ledgerlens.sources.files import read_text, save_model, work_folder, write_text
from ledgerlens.sources.tables import Sources

Scorer = Callable[[DataFrame], DataFrame]


def prepare_training(features: DataFrame, medians: dict[str, float] | None = None) -> DataFrame:
    """Training features to labelled model inputs."""
    return label_loss(encode_pdtype(add_ratios(impute(_valid(features), "fit", medians), "training")))


def _valid(features: DataFrame) -> DataFrame:
    return cast_features(valid_training_rows(clean_text_features(features)))


def prepare_scoring(features: DataFrame, mode: str = "constant", values: dict[str, float] | None = None) -> DataFrame:
    """Feature rows to model inputs, all rows kept; takes production rows and training rows (a campaign's customers).

    `constant` fills missing months with fixed values and marks every row `scorable`. `batch` fills with the medians
    of the rows that pass the row check and marks only those. Ages that are not there yet come from the birth date,
    centuries corrected.
    """
    rows = cast_features(clean_text_features(features))
    if "age" not in rows.columns:
        rows = rows.withColumn("age", age("dob", "funded_date_recent", fix_century=True))
    rows = rows.withColumn("scorable", F.lit(True) if mode == "constant" else scorable())
    if mode != "constant" and values is None:
        values = fit_medians(rows.filter("scorable"))
    kind = "training" if "recent_loan_amt" in rows.columns else "production"
    return add_ratios(impute(rows, mode, values), kind)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared work folder and read back: later passes start from files that outlive executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@dataclass
class Trained:
    model: LossModel
    metrics: DataFrame
    medians: dict[str, float | None]


def prepare_sets(src: Sources, test_share: float = 0.3, seed: int = 0) -> tuple[DataFrame, DataFrame, dict[str, float | None]]:
    """Train and test rows, written once, and the medians that they are filled with."""
    features = written(training_features(src), "features")
    medians = fit_medians(_valid(features))
    prepared = written(prepare_training(features, medians), "prepared")
    return *split(prepared, "ssn", test_share, seed), medians


def scores_of(models: dict[str, LossModel], train: DataFrame, test: DataFrame) -> DataFrame:
    """(model, part, label, prob_1, predicted) of all models on both parts, written once."""
    parts = [
        score(model, rows).select(F.lit(name).alias("model"), F.lit(part).alias("part"), F.col(LABEL).alias("label"), "prob_1", "predicted")
        for name, model in models.items()
        for part, rows in (("train", train), ("test", test))
    ]
    return written(reduce(DataFrame.unionByName, parts), "scores")


def evaluate(models: dict[str, LossModel], train: DataFrame, test: DataFrame) -> DataFrame:
    """(model, part, n, auc, precision, recall, accuracy, f1) of all models on both parts, from one pass over the scores."""
    return metrics_by(scores_of(models, train, test), ["model", "part"], "prob_1", "label", "predicted")


def train(
    src: Sources,
    fit: Callable[[DataFrame], LossModel] = fit_boosted,
    name: str = "boosted",
    model_path: str | None = None,
    test_share: float = 0.3,
    seed: int = 0,
) -> Trained:
    """Features, cleaning, label, split, fit, metrics; saves the model, and the medians with it, if a path is given."""
    train_rows, test_rows, medians = prepare_sets(src, test_share, seed)
    model = fit(train_rows)
    if model_path is not None:
        save_model(model, model_path)
        write_text(train_rows.sparkSession, f"{model_path}/medians", json.dumps(medians))
    return Trained(model, evaluate({name: model}, train_rows, test_rows), medians)


def load_trained(spark: SparkSession, path: str) -> tuple[LossModel, dict[str, float | None]]:
    """The model that `train` saved, and the medians that go with it: new rows are filled without a pass over them."""
    return load_model(path), json.loads(read_text(spark, f"{path}/medians"))


def compare(src: Sources, fits: dict[str, Callable[[DataFrame], LossModel]], test_share: float = 0.3, seed: int = 0) -> tuple[dict[str, LossModel], DataFrame]:
    """Several models fitted on one prepared set, and their metrics on both parts."""
    train_rows, test_rows, _ = prepare_sets(src, test_share, seed)
    models = {name: fit(train_rows) for name, fit in fits.items()}
    return models, evaluate(models, train_rows, test_rows)


#: what a score report looks at by score bin
REPORT_TARGETS = ["if_loss", "profit_historical", "static_pool_recent", "pd_type"]


def score_report(scorer: Scorer, rows: DataFrame) -> DataFrame:
    """Labelled rows with prob_0, prob_1, predicted, score, and by how much the loan grew."""
    return amount_diff(scorer(rows))


def report_distributions(report: DataFrame, bins: int = 10, targets: list[str] | None = None) -> DataFrame:
    """(target, bin, lower, upper, n, total, mean, mean_2): each target by quantile bins of the score."""
    parts = [score_distribution(report, "score", bins, t).select(F.lit(t).alias("target"), "*") for t in targets or REPORT_TARGETS]
    return reduce(DataFrame.unionByName, parts)


def score_and_price(
    features: DataFrame,
    scorer: Scorer,
    mode: str = "constant",
    values: dict[str, float] | None = None,
    rules: PricingRules = PRICING_APPLIED,
    edges: tuple[float, ...] = BAND_EDGES,
) -> DataFrame:
    """Feature rows with score, band, loan amount and rate. Rows that cannot be scored stay, without these."""
    scored = scorer(prepare_scoring(features, mode, values))
    results = ["prob_0", "prob_1", "predicted", "score"]
    known = scored.withColumns({c: F.when(F.col("scorable"), F.col(c)) for c in results})
    return offer(known, rules, edges)


def batch_score_offer(src: Sources, as_of: str, scorer: Scorer, **options) -> DataFrame:
    """From the lending tables to priced offers. Features are written once, before medians are taken of them."""
    return score_and_price(written(production_features(src, as_of), "features"), scorer, **options)


def with_model(model: LossModel) -> Scorer:
    return lambda df: score(model, df)
