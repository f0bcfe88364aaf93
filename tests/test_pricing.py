import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import pricing
from ledgerlens.operators.campaign import Scenario, band_volume, campaign_impact, campaign_response, tier_counts


def offers(spark, scores):
    df = spark.createDataFrame([(s, 100.0) for s in scores], "score double, previous_loan_amt double")
    return {r.score: (r.score_cat, r.renewal_loan_amt, r.interest_rate) for r in pricing.offer(df).collect()}


def test_band_edges_belong_to_the_lower_band(spark):
    scores = [e for e in pricing.BAND_EDGES] + [e + 0.001 for e in pricing.BAND_EDGES]
    got = offers(spark, scores)
    assert [got[e][0] for e in pricing.BAND_EDGES] == [10, 9, 8, 7, 6, 5, 4, 3, 2, 1]
    assert [got[e + 0.001][0] for e in pricing.BAND_EDGES] == [9, 8, 7, 6, 5, 4, 3, 2, 1, None]


@pytest.mark.parametrize("score, amount, rate", [
    (0.0, 100, 0.3), (692.0, 100, 0.3), (692.5, 300, 0.3), (851.0, 300, 0.3), (851.01, 400, 0.27), (969.0, 400, 0.27),
    (969.5, 500, 0.25), (1000.0, 500, 0.25)])
def test_amount_and_rate(spark, score, amount, rate):
    assert offers(spark, [score])[score][1:] == (amount, rate)


def test_no_score_no_offer(spark):
    assert offers(spark, [None])[None] == (None, None, None)


def test_proposed_and_updated_rules(spark):
    df = spark.createDataFrame([(s,) for s in (849.9, 851.0, 852.0, 950.0, 970.0)], "score double")
    got = df.orderBy("score").select(
        pricing.interest_rate(rules=pricing.PRICING_V1), pricing.interest_rate(rules=pricing.PRICING_V2)).collect()
    assert [tuple(r) for r in got] == [(0.3, 0.3), (0.27, 0.3), (0.27, 0.27), (0.25, 0.27), (0.25, 0.25)]


def test_campaign_list_and_response(spark):
    df = spark.createDataFrame([(851.9, 5.0), (852.0, None), (980.0, 0.0)], "score double, funded_amount double")
    assert pricing.campaign_list(df).count() == 2
    assert pricing.campaign_list(df, pricing.TOP_SCORE).count() == 1
    assert [r.if_funded for r in campaign_response(df).orderBy("score").collect()] == [1, 0, 1]


def test_campaign_impact_equals_published_figures(spark):
    """6,390 + 20,014 + 27,148 targets; totals and lifts as published."""
    sizes = {1: 6390, 4: 20014, 6: 27148, 9: 35277}
    df = spark.range(sum(sizes.values())).select(
        F.when(F.col("id") < 6390, 1).when(F.col("id") < 26404, 4).when(F.col("id") < 53552, 6).otherwise(9)
        .alias("score_cat"), F.lit(1.0).alias("score"))
    assert {r.tier: r.customers for r in tier_counts(df).collect()} == {1: 6390, 2: 20014, 3: 27148}
    assert {r.score_cat: r.volume for r in band_volume(df).collect()} == sizes
    base = Scenario("status quo", 0.313, 698.7)
    rows = campaign_impact(df, base, [Scenario(str(p), p / 100, 915.5) for p in (35, 40, 45)]).collect()
    totals = [11_711_452.9, 17_159_399.6, 19_610_742.4, 22_062_085.2]
    lifts = [0, 46.5, 67.4, 88.4]
    for row, total, lift in zip(rows, totals, lifts):
        assert row.targets == 53552
        assert math.isclose(row.total_profit, total, abs_tol=0.05) and abs(row.lift_pct - lift) < 0.06
