from datetime import date

from ledgerlens.functions.pricing import PRICING_APPLIED, PRICING_V1, PRICING_V2, interest_rate, price_as_of, renewal_amount, rule_rows

VERSIONS = {"v1": ("2024-01-10", PRICING_V1), "v2": ("2024-02-01", PRICING_V2), "applied": ("2024-03-01", PRICING_APPLIED)}


def test_rules_as_rows_give_what_the_rules_give(spark):
    scores = [0.0, 558.0, 559.0, 562.0, 690.0, 692.0, 692.5, 693.0, 851.0, 851.5, 852.0, 950.0, 969.0, 970.0, 1000.0, None]
    days = ["2024-01-09", "2024-01-10", "2024-01-31", "2024-02-01", "2024-03-01", "2025-01-01", None]
    rows = [(i * 100 + j, s, 500.0 + i, date.fromisoformat(d) if d else None) for i, s in enumerate(scores) for j, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id long, score double, previous_loan_amt double, day date")
    got = {r.id: (r.version, r.interest_rate, r.renewal_loan_amt) for r in price_as_of(df, rule_rows(spark, VERSIONS), "day").collect()}
    plain = {}
    for name, (_, rules) in VERSIONS.items():
        for r in df.select("id", interest_rate(rules=rules).alias("rate"), renewal_amount(rules=rules).alias("amount")).collect():
            plain[name, r.id] = (r.rate, r.amount)
    assert len(got) == len(rows)
    for i, score, _, day in rows:
        started = [n for n, (start, _) in VERSIONS.items() if day and date.fromisoformat(start) <= day]
        want = (started[-1], *plain[started[-1], i]) if started and score is not None else (None, None, None)
        assert got[i] == want


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, 700.0, 1.0, date(2024, 1, 1))], "id long, score double, previous_loan_amt double, day date")
    assert price_as_of(df, rule_rows(spark, {}), "day").first()["version"] is None
    assert price_as_of(df.limit(0), rule_rows(spark, VERSIONS), "day").count() == 0
