"""From raw feature rows to model inputs: cleaning, row checks, imputation, ratios, label, split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import age, clean_employment, clean_salary, ratio, to_double
from ledgerlens.functions.events import normal_text
from ledgerlens.operators.quantiles import median_of
from ledgerlens.schemas import EVALUATION_VARS, TRAIN_VARS

# Text columns that become numbers, and those among them that get a median or constant where missing.
NUMERIC_TEXT = ["salary", "previous_loan_amt", "bank_account_length_months", "months_at_residence"]
IMPUTED = ["salary", "bank_account_length_months", "months_at_residence"]
# What request scoring puts in place of missing months.
CONSTANTS = {"bank_account_length_months": 30.0, "months_at_residence": 36.0}


def clean_text_features(df: DataFrame, quirk: bool = True) -> DataFrame:
    """Salary and employment length as numbers."""
    return df.withColumns(
        {"salary": clean_salary("salary", quirk), "employment_length": clean_employment("employment_length")}
    )


def _present_and_nonzero(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != 0)


def valid_training_rows(df: DataFrame) -> DataFrame:
    """Rows with a previous loan and its payments, a recent loan that is not zero, and a history not below zero days."""
    recent = F.coalesce(F.col("recent_loan_amt").cast("double"), F.lit(1.0)) != 0
    return valid_scoring_rows(df).filter(recent)


def scorable() -> Column:
    """A previous loan that is not zero, its payments, and a history not below zero days."""
    valid = _present_and_nonzero("previous_loan_amt") & F.col("pay_previous").isNotNull() & (F.col("years_with_us") >= 0)
    return F.coalesce(valid, F.lit(False))


def valid_scoring_rows(df: DataFrame) -> DataFrame:
    return df.filter(scorable())


def eligible(df: DataFrame) -> DataFrame:
    """The stricter offer rule: adults with salary 1000 and up whose past and previous loans made a profit.

    Rows without `age`, as scoring gets them, are judged by date of birth.
    """
    years = F.col("age") if "age" in df.columns else age("dob", "funded_date_recent", fix_century=True)
    return valid_scoring_rows(df).filter(
        F.col("last_payment_date").isNotNull()
        & (clean_salary("salary") >= 1000)
        & (years >= 18)
        & (F.col("profit_historical") > 0)
        & (F.col("profit_previous") > 0)
    )


def cast_features(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns as double; text that is no number becomes null (`cast_failures` counts it)."""
    columns = columns or [c for c in NUMERIC_TEXT if c in df.columns]
    return df.withColumns({c: to_double(c) for c in columns})


def cast_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, failures): values that are there but no numbers."""
    row = df.agg(
        *[F.count_if(F.col(c).isNotNull() & to_double(c).isNull()).alias(f"f{i}") for i, c in enumerate(columns)]
    )
    entries = [
        F.struct(F.lit(c).alias("name"), F.col(f"f{i}").alias("failures")) for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def impute(df: DataFrame, mode: str = "fit", values: dict[str, float] | None = None, approx: bool = False) -> DataFrame:
    """Fill missing numbers. `fit` and `batch` take medians of `df` itself, `constant` the given or fixed values."""
    if values is None:
        values = CONSTANTS if mode == "constant" else fit_medians(df, approx)
    return df.fillna({c: v for c, v in values.items() if v is not None and c in df.columns})


def fit_medians(df: DataFrame, approx: bool = False) -> dict[str, float | None]:
    """Medians to keep with a model. Three numbers come to the driver."""
    return median_of(df, IMPUTED, approx)


def add_ratios(df: DataFrame, mode: str = "training") -> DataFrame:
    """Payment ratios. `pti` is salary over loan. In production the latest loan is the previous one."""
    previous = {"static_pool_previous": ratio("pay_previous", "previous_loan_amt")}
    if mode == "production":
        return df.withColumns(previous | {"static_pool_historical": ratio("pay_historical", "historical_loan_amt")})
    earlier = F.col("total_loan_amt") - F.col("recent_loan_amt")
    return df.withColumns(
        previous
        | {
            "pti": ratio("salary", "recent_loan_amt"),
            "historical_loan_amt": earlier.cast("double"),
            "static_pool_recent": ratio("pay_recent", "recent_loan_amt"),
            "static_pool_historical": ratio(F.col("pay_historical"), earlier),
            "static_pool_overall": ratio("total_pay", "total_loan_amt"),
        }
    )


def encode_pdtype(df: DataFrame) -> DataFrame:
    """Written off 1, stored 0, anything else null."""
    kind = normal_text("pd_type")
    return df.withColumn("pd_type", F.when(kind == "written off", 1).when(kind == "stored", 0))


def label_loss(df: DataFrame) -> DataFrame:
    """1 if the recent loan paid back less than was lent; an unknown ratio counts as no loss."""
    return df.withColumn("if_loss", F.when(F.col("static_pool_recent") < 1, 1).otherwise(0))


def split(df: DataFrame, key: str, test_share: float = 0.3, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, told apart by a hash of the key: the same however the data is partitioned."""
    test = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10)
    is_test = test.cast("bigint") < int(test_share * 2**32)
    return df.filter(~is_test), df.filter(is_test)


def select_features(df: DataFrame, evaluation: bool = False) -> DataFrame:
    return df.select(EVALUATION_VARS if evaluation else TRAIN_VARS)
