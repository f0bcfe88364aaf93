"""Feature rows against the full joins they stand for, on small tables with many repeated keys."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import joins, lookups
from ledgerlens.operators.ledger import ledger_loan_totals
from ledgerlens.plans.features import joined_row_counts, production_features, training_features
from ledgerlens.schemas import SOURCE_SCHEMAS
from ledgerlens.sources.tables import Sources
from tests.test_ledger import random_ledger

DAY = date(2024, 1, 1)


def some_sources(spark, seed):
    """Keys repeat on purpose: two customers per ss, several mappings, leads, log rows and affiliates per key."""
    rng = random.Random(seed)
    names = [None, "mpd", "A ", "a", "b", "c", "nobody"]
    pick = rng.choice
    ledger = random_ledger(seed, customers=8, rows=160)
    tables = {
        "ledger": [tuple(r[f.name] for f in SOURCE_SCHEMAS["ledger"]) for r in ledger],
        "payday": [
            (100 + i, i % 9, "weekly", pick(["Stored", "Written Off ", "Active"]), pick(["2 Year(s)", None, "N/A"]),
             f"c{i}", "12", None, "$1500", DAY, DAY, "1", pick(["Ohio", "Texas"])) for i in range(14)],
        "applicant_mapping": [(200 + i, 100 + rng.randrange(14), 300 + rng.randrange(12)) for i in range(25)],
        "applicant": [(300 + i, f"a{i}") for i in (0, 1, 2, 3, 4, 5, 6, 7, 7)],
        "renewal_log": [
            (400 + i, 100 + rng.randrange(14), DAY + timedelta(days=rng.randrange(60)), pick([1, 1, 2]), rng.randrange(4),
             DAY, DAY) for i in range(60)],
        "renewal_lead": [(400 + rng.randrange(60), 500 + rng.randrange(12), Decimal(5), "web", 1) for _ in range(80)],
        "application_type": [(0, "x", 1), (1, "y", 2), (1, "z", 3)],
        "sub_codes": [(1, 5), (1, 6), (2, 5)],
        "buy_apps_log": [(500 + i, 300 + rng.randrange(12), pick(names), "F", DAY) for i in range(30)],
        "affiliate": [("a", Decimal(1)), ("A", Decimal(2)), ("b", Decimal(3)), ("mpd", Decimal(4))],
        "bureau_response": [
            (i, 300 + rng.randrange(12), pick(["0010", "0020", "0030", "0040", None]), pick([None, 1, 2, 3]))
            for i in range(40)],
        "customer_restriction": [(i, 100 + rng.randrange(14), i % 2, 0, 1) for i in range(20)],
        "sms_preference": [(i, 200 + rng.randrange(25), i % 2, 1) for i in range(30)],
    }
    return Sources.of(lambda name: spark.createDataFrame(tables[name], SOURCE_SCHEMAS[name]))


def full_join(src, mode):
    loans = joins.base_loans(ledger_loan_totals(src.ledger), mode)
    customers = joins.base_customers(src.payday, mode)
    joined = joins.join_customer(loans, customers, src.applicant_mapping)
    return joins.join_affiliate(joins.join_dimensions(joined, src), src.affiliate)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", ["training", "production"])
def test_counts_equal_the_full_join(spark, seed, mode):
    src = some_sources(spark, seed)
    want = {r.ss: r["count"] for r in full_join(src, mode).groupBy("ss").count().collect()}
    days = joins.base_loan_days(src.ledger, mode)
    got = joined_row_counts(days, src, joins.base_customers(src.payday, mode))
    assert {r.ss: r.n_rows for r in got.collect()} == want


def test_affiliate_join_equals_the_or_condition(spark):
    src = some_sources(spark, 1)
    loans = joins.base_loans(ledger_loan_totals(src.ledger), "production")
    joined = joins.join_dimensions(joins.join_customer(loans, src.payday, src.applicant_mapping), src)
    af = src.affiliate.select(F.lower(F.rtrim("username")).alias("u"), "leadprice")
    lead, own = F.lower(F.rtrim("lead_username")), F.lower(F.rtrim("own_username"))
    keys = ["loan_id", "mapping_id", "lead_buy_apps_log_id", "own_buy_apps_log_id", "lead_username", "own_username"]
    want = joined.join(af, (lead == F.col("u")) | (own == F.col("u")), "left").select(*keys, "leadprice")
    got = joins.join_affiliate(joined, src.affiliate).select(*keys, "lead_price")
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("leadprice", "lead_price") for r in want.collect())


@pytest.mark.parametrize("mode", ["training", "production"])
def test_feature_row_is_the_first_joined_row(spark, mode):
    src = some_sources(spark, 2)
    order = Window.partitionBy("ss").orderBy(
        F.desc("loan_id"), "payday_id", F.col("applicant_id").asc_nulls_first(), "mapping_id"
    )
    first = full_join(src, mode).withColumn("rn", F.row_number().over(order)).filter("rn = 1")
    want = {r.ss: r for r in first.collect()}
    if mode == "training":
        rows = training_features(src, show_ssn=True).collect()
        for r in rows:
            w = want[int(r.ssn)]
            assert (r.applicant_id, r.recent_loan_amt, r.pay_recent) == (w.applicant_id, w.net, w.current_amount_paid)
            assert (r.previous_loan_amt, r.pay_previous) == (w.previous_loan_amt, w.previous_amount_paid)
    else:
        rows = production_features(src, "2024-03-01", show_ssn=True).collect()
        for r in rows:
            w = want[int(r.ssn)]
            assert (r.payday_id, r.email) == (w.payday_id, w.applicant_email)
            assert (r.previous_loan_amt, r.pay_previous) == (w.net, w.current_amount_paid)
            assert r.wo_entries_historical == w.total_wo_entries
    assert len(rows) == len(want) > 0


def test_options(spark):
    src = some_sources(spark, 0)
    plain = {r.ssn: r for r in training_features(src).collect()}
    assert all(len(k) == 64 for k in plain)
    split = {r.ssn: r for r in training_features(src, block_rows=4).collect()}
    assert split == plain
    counted = {r.ssn: r.number_of_loans_before for r in training_features(src, count_distinct_loans=True).collect()}
    assert counted.keys() == plain.keys() and all(counted[k] <= plain[k].number_of_loans_before for k in plain)
    everything = {r.ssn: r.wo_entries_historical for r in training_features(src, wo_scope="all").collect()}
    assert all(everything[k] >= (plain[k].wo_entries_historical or 0) for k in plain)
    texas = src.payday.filter("state = 'Texas' and type = 'Stored'")
    rows = production_features(src, "2024-03-01", exclude_states=("ohio",)).collect()
    assert {r.payday_id for r in rows} <= {r.id for r in texas.collect()}
    one = rows[0].payday_id
    assert [r.payday_id for r in production_features(src, "2024-03-01", only_payday_id=one).collect()] == [one]


def test_lookups_break_ties(spark):
    rows = [(1, 7, "0040", 5), (2, 7, "0010", None), (3, 7, "0010", 2), (4, 7, "0020", 1), (5, 7, "0030", 9),
            (6, 7, "0030", 4), (7, 8, None, 3)]
    got = lookups.bureau_scores(spark.createDataFrame(rows, SOURCE_SCHEMAS["bureau_response"])).collect()
    assert {r.applicantid: (r.risk_score, r.new_ft_score) for r in got} == {7: (None, 4), 8: (None, None)}


def test_signed_application_window(spark):
    log = spark.createDataFrame(
        [(1, 9, DAY, 1, 0, DAY, DAY), (2, 9, DAY + timedelta(days=3), 1, 0, DAY, DAY),
         (3, 9, DAY + timedelta(days=4), 2, 0, DAY, DAY)], SOURCE_SCHEMAS["renewal_log"])
    loans = spark.createDataFrame(
        [(9, DAY + timedelta(days=d)) for d in (-1, 0, 2, 3, 5, 6, 8, 9)], "payday_id bigint, loan_date date")
    got = lookups.latest_signed_application(loans, log).orderBy("loan_date").collect()
    assert [r.log_id for r in got] == [None, 1, 1, 2, 2, 2, 2, None]


def test_feature_plans_have_no_nested_loop(spark):
    src = some_sources(spark, 0)
    for df in (training_features(src), production_features(src, "2024-03-01"), full_join(src, "training")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
