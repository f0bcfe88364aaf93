import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import age, clean_employment, clean_salary, employment_default, parse_years_on_job
from ledgerlens.operators import preparation as prep


def values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_years_on_job(spark):
    texts = ["3 Year(s) 2 Month(s)", "12 year(s)", "N/A", "", None, "3 1/2 Year(s)", "Year(s) 4"]
    assert values(spark, parse_years_on_job("t"), texts) == ["3", "12", "", "", None, "3 1/2", ""]


def test_employment_default(spark):
    texts = ["4", "", None, "N/", "n/ ", "o", "0.5", "3 1/2", "3.5"]
    assert values(spark, employment_default("t"), texts) == ["4", "3", "3", "3", "3", "3", "3", "3", "3.5"]


def test_clean_employment(spark):
    texts = ["4", "N/A", "", "o", "NULL", "5/6", None, "7.5", "x"]
    assert values(spark, clean_employment("t"), texts) == [4.0, 0.0, 0.0, 0.0, 0.0, 0.0, 3.0, 7.5, None]


def salary_rule(text):
    """The rule in words: drop $, then the second character if it and the third from the end are dots."""
    if text is None:
        return None
    if text.startswith("$"):
        text = text[1:]
    if len(text) < 2 or (text[1] == "." and len(text) < 3):
        return None
    if text[1] == "." and text[-3] == ".":
        text = text[0] + text[2:]
    return float(text) if re.fullmatch(r"\d+\.?\d*|\.\d+", text) else None


def test_clean_salary(spark):
    texts = ["$1500", "1.234.56", "2.50", "5", "$", "", None, "1.5", "1234.56", "$1.200.00", "abc"]
    assert values(spark, clean_salary("t"), texts) == [1500.0, 1234.56, 250.0, None, None, None, None, 1.5, 1234.56,
                                                       1200.0, None]
    assert values(spark, clean_salary("t", quirk=False), ["2.50", "1.234.56"]) == [2.5, 1234.56]


def test_clean_salary_random(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("$.0123456789") for _ in range(rng.randrange(0, 8))) for _ in range(2000)]
    assert values(spark, clean_salary("t"), texts) == [salary_rule(t) for t in texts]


def test_age_truncates_and_fixes_centuries(spark):
    df = spark.sql("select date '2000-01-01' b, date '2002-03-11' a union all select date '0975-06-01', date '2024-01-01'")
    got = sorted(tuple(r) for r in df.select(age("b", "a"), age("b", "a", True)).collect())
    assert got == [(2, 2), (1049, 49)]


FEATURES = "k int, previous_loan_amt decimal(15,4), recent_loan_amt decimal(15,4), pay_previous double, years_with_us int"


@pytest.mark.parametrize("rule, kept", [(prep.valid_training_rows, [1, 6]), (prep.valid_scoring_rows, [1, 5, 6])])
def test_valid_rows(spark, rule, kept):
    from decimal import Decimal as D

    rows = [(1, D(5), D(5), 1.0, 0), (2, None, D(5), 1.0, 3), (3, D(0), D(5), 1.0, 3), (4, D(5), D(5), None, 3),
            (5, D(5), D(0), 1.0, 3), (6, D(5), None, 1.0, 3), (7, D(5), D(5), 1.0, -1), (8, D(5), D(5), 1.0, None)]
    df = spark.createDataFrame(rows, FEATURES)
    assert sorted(r.k for r in rule(df).collect()) == kept


def test_impute_modes(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, 4.0, None), (10.0, 6.0, 7.0), (3.0, None, None)],
                               "salary double, bank_account_length_months double, months_at_residence double")
    medians = prep.fit_medians(df)
    assert medians == {"salary": 2.5, "bank_account_length_months": 5.0, "months_at_residence": 6.0}
    fixed = prep.impute(df, "constant").orderBy("salary").collect()
    assert [r.bank_account_length_months for r in fixed] == [30.0, 4.0, 30.0, 6.0]
    assert [r.months_at_residence for r in fixed] == [5.0, 36.0, 36.0, 7.0]
    given = prep.impute(df, "fit", {"months_at_residence": 1.0}).orderBy("salary").collect()
    assert [r.months_at_residence for r in given] == [5.0, 1.0, 1.0, 7.0]


def test_ratios_and_label_without_history(spark):
    df = spark.createDataFrame(
        [(10.0, 100.0, 100.0, 50.0, 0.0, 20.0, 40.0, 50.0)],
        "salary double, total_loan_amt double, recent_loan_amt double, pay_recent double, pay_historical double,"
        "pay_previous double, previous_loan_amt double, total_pay double",
    )
    row = prep.label_loss(prep.add_ratios(df)).first()
    assert row.static_pool_historical is None and row.static_pool_recent == 0.5 and row.if_loss == 1
    assert math.isclose(row.pti, 0.1) and row.static_pool_previous == 0.5 and row.historical_loan_amt == 0.0
    unknown = df.withColumn("recent_loan_amt", F.lit(None).cast("double"))
    assert prep.label_loss(prep.add_ratios(unknown)).first().if_loss == 0


def test_encode_pdtype(spark):
    df = spark.createDataFrame([("Stored",), ("Written Off ",), ("Active",), (None,)], "pd_type string")
    assert [r.pd_type for r in prep.encode_pdtype(df).collect()] == [0, 1, None, None]


def test_cast_failures(spark):
    df = spark.createDataFrame([("1", "x"), (None, "2"), ("y", None)], "a string, b string")
    assert {r.name: r.failures for r in prep.cast_failures(df, ["a", "b"]).collect()} == {"a": 1, "b": 1}


def test_split_is_the_same_however_partitioned(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = prep.split(df, "k")
    again = prep.split(df.repartition(7), "k")[1]
    assert train.count() + test.count() == 5000 and abs(test.count() / 5000 - 0.3) < 0.03
    assert {r.k for r in test.collect()} == {r.k for r in again.collect()}
    assert {r.k for r in prep.split(df, "k", seed=1)[1].collect()} != {r.k for r in test.collect()}
