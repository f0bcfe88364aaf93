"""Score bands, loan amounts and interest rates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper edges of score bands 10 (worst) to 1 (best); a score above the last edge has no band.
BAND_EDGES = (558.206, 628.795, 692.559, 765.789, 851.454, 915.296, 948.336, 969.701, 983.392, 997.463)


@dataclass(frozen=True)
class PricingRules:
    """Score tiers from low to high. `cuts` part them; a score on a cut is in the lower tier if `cut_is_lower`."""

    cuts: tuple[float, ...]
    increases: tuple[float, ...]
    rates: tuple[float, ...]
    cut_is_lower: bool = True

    def tier(self, score: Column, values: tuple[float, ...]) -> Column:
        chosen = None
        for cut, value in zip(self.cuts, values):
            inside = score <= cut if self.cut_is_lower else score < cut
            chosen = F.when(inside, F.lit(value)) if chosen is None else chosen.when(inside, F.lit(value))
        return chosen.when(score.isNotNull(), F.lit(values[-1]))


# The proposed, the updated and the applied tiers.
PRICING_V1 = PricingRules((562, 690, 851, 950), (0.0, 0.0, 200.0, 300.0, 400.0), (0.3, 0.3, 0.3, 0.27, 0.25), False)
PRICING_V2 = PricingRules((559, 693, 852, 970), (0.0, 0.0, 200.0, 300.0, 400.0), (0.3, 0.3, 0.3, 0.27, 0.25), False)
PRICING_APPLIED = PricingRules((692, 851, 969), (0.0, 200.0, 300.0, 400.0), (0.3, 0.3, 0.27, 0.25))

RULE_ROWS = "version string, valid_from date, kind string, nth int, cut double, cut_is_lower boolean, value double"


def rule_rows(spark: SparkSession, versions: dict[str, tuple[str, PricingRules]]) -> DataFrame:
    """Rules as a table, a row a tier: of which version, from which day on, rate or increase, up to which score (null: all
    above). A version holds until the next one starts."""
    rows = [
        (name, date.fromisoformat(day), kind, i, float(cut) if cut is not None else None, rules.cut_is_lower, float(value))
        for name, (day, rules) in versions.items()
        for kind, values in (("rate", rules.rates), ("increase", rules.increases))
        for i, (cut, value) in enumerate(zip((*rules.cuts, None), values))
    ]
    return spark.createDataFrame(rows, RULE_ROWS)


def price_as_of(df: DataFrame, rules: DataFrame, day: str, score: str = "score", previous: str = "previous_loan_amt") -> DataFrame:
    """Rows with `version`, `interest_rate` and `renewal_loan_amt` by the rules that hold on the row's day.

    The rules' versions and tiers are sorted arrays in one row, which is as large as the rules are, and a row's version
    and tiers are places in them: no range is joined. Before the first version, or without day or score, all are null.
    """
    tiers = rules.groupBy("version", "valid_from", "kind").agg(
        F.sort_array(F.collect_list(F.struct("nth", "cut", "value"))).alias("tiers"), F.first("cut_is_lower").alias("cut_is_lower")
    )
    kinds = [F.max(F.when(F.col("kind") == k, F.struct("tiers", "cut_is_lower"))).alias(k) for k in ("rate", "increase")]
    versions = tiers.groupBy("version", "valid_from").agg(*kinds)
    table = versions.agg(F.sort_array(F.collect_list(F.struct("valid_from", "version", "rate", "increase"))).alias("__rules"))
    placed = df.join(F.broadcast(table.withColumn("__one", F.lit(True))), F.col("__one"), "left")
    started = F.filter("__rules", lambda v: v["valid_from"] <= F.col(day).cast("date"))
    placed = placed.withColumn("__rule", F.get(started, F.size(started) - 1))

    def value(kind: str) -> Column:
        of = F.col("__rule")[kind]
        inside = F.filter(
            of["tiers"],
            lambda t: t["cut"].isNull() | F.when(of["cut_is_lower"], F.col(score) <= t["cut"]).otherwise(F.col(score) < t["cut"]),
        )
        return F.when(F.col(score).isNotNull(), F.get(inside, F.lit(0))["value"])

    added = {
        "version": F.when(F.col(score).isNotNull(), F.col("__rule")["version"]),
        "interest_rate": value("rate"),
        "renewal_loan_amt": F.col(previous).cast("double") + value("increase"),
    }
    return placed.withColumns(added).drop("__rules", "__rule", "__one")


# Marketing tiers by score band, and the scores a campaign and a top list start at.
TIER_BANDS = {1: (1, 3), 2: (4, 5), 3: (6, 7)}
CAMPAIGN_SCORE = 852
TOP_SCORE = 970


def score_band(score: Column | str, edges: tuple[float, ...] = BAND_EDGES) -> Column:
    """Band n for scores up to the first edge, down to 1 for the last edge; null above it."""
    score = F.col(score) if isinstance(score, str) else score
    band = None
    for n, edge in zip(range(len(edges), 0, -1), edges):
        band = F.when(score <= edge, F.lit(n)) if band is None else band.when(score <= edge, F.lit(n))
    return band


def tier_of(band: Column | str) -> Column:
    band = F.col(band) if isinstance(band, str) else band
    tier = None
    for n, (low, high) in TIER_BANDS.items():
        inside = band.between(low, high)
        tier = F.when(inside, F.lit(n)) if tier is None else tier.when(inside, F.lit(n))
    return tier


def renewal_amount(
    score: Column | str = "score", previous: Column | str = "previous_loan_amt", rules: PricingRules = PRICING_APPLIED
) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    previous = F.col(previous) if isinstance(previous, str) else previous
    return previous.cast("double") + rules.tier(score, rules.increases)


def interest_rate(score: Column | str = "score", rules: PricingRules = PRICING_APPLIED) -> Column:
    return rules.tier(F.col(score) if isinstance(score, str) else score, rules.rates)


def offer(df: DataFrame, rules: PricingRules = PRICING_APPLIED, edges: tuple[float, ...] = BAND_EDGES) -> DataFrame:
    """Add score band, renewal loan amount and interest rate to scored rows."""
    return df.withColumns(
        {
            "score_cat": score_band("score", edges),
            "renewal_loan_amt": renewal_amount(rules=rules),
            "interest_rate": interest_rate(rules=rules),
        }
    )


def campaign_list(df: DataFrame, min_score: float = CAMPAIGN_SCORE) -> DataFrame:
    return df.filter(F.col("score") >= min_score)
