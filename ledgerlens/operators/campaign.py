"""Campaign response, band and tier sizes, what-if profit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.pricing import tier_of
from ledgerlens.operators.quantiles import score_distribution


@dataclass(frozen=True)
class Scenario:
    name: str
    application_rate: float
    avg_profit: float


def campaign_response(df: DataFrame) -> DataFrame:
    """Flag the customers of a campaign that took a loan."""
    return df.withColumn("if_funded", F.when(F.col("funded_amount").isNotNull(), 1).otherwise(0))


def campaign_response_by_bin(df: DataFrame, bins: int = 10) -> DataFrame:
    """Share of funded customers per score bin."""
    return score_distribution(campaign_response(df), "score", bins, "if_funded")


def amount_diff(df: DataFrame) -> DataFrame:
    """How much larger the recent loan is than the previous one."""
    return df.withColumn("amount_diff", F.col("recent_loan_amt") - F.col("previous_loan_amt"))


def band_volume(df: DataFrame, column: str = "score_cat") -> DataFrame:
    """Scored customers per band."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("score").alias("volume"))


def tier_counts(df: DataFrame, band: str = "score_cat") -> DataFrame:
    """Customers per marketing tier; bands beyond the last tier are no target."""
    return (
        df.withColumn("tier", tier_of(band)).filter(F.col("tier").isNotNull()).groupBy("tier").agg(
            F.count(F.lit(1)).alias("customers")
        )
    )


def campaign_impact(
    scored: DataFrame, baseline: Scenario, scenarios: list[Scenario], band: str = "score_cat"
) -> DataFrame:
    """Profit per scenario = targeted customers x application rate x average profit, and its lift in % to the baseline."""
    targets = scored.agg(F.count_if(tier_of(band).isNotNull()).alias("targets"))
    rows = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("scenario"),
                F.lit(s.application_rate).alias("application_rate"),
                F.lit(s.avg_profit).alias("avg_profit"),
            )
            for s in (baseline, *scenarios)
        ]
    )
    total = F.col("targets") * F.col("application_rate") * F.col("avg_profit")
    before = F.col("targets") * F.lit(baseline.application_rate) * F.lit(baseline.avg_profit)
    return (
        targets.select("targets", F.explode(rows).alias("s"))
        .select("targets", "s.*")
        .withColumns({"total_profit": total, "lift_pct": (F.try_divide(total, before) - 1) * 100})
    )
