import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.events import classify_events
from ledgerlens.operators import blocks
from ledgerlens.operators.ledger import customer_totals, ledger_loan_totals, segment_ids
from ledgerlens.schemas import SOURCE_SCHEMAS
from tests.brute import loan_totals

SCHEMA = SOURCE_SCHEMAS["ledger"]
DAY = date(2024, 1, 1)


def event(i, ss, kind, net="0", payment="0", day=None):
    paid = Decimal(payment)
    return {
        "id": i,
        "ss": ss,
        "dte": DAY + timedelta(days=i if day is None else day),
        "type": kind,
        "net": Decimal(net),
        "payment": paid,
        "paidprin": (paid * Decimal("0.8")).quantize(Decimal("0.0001")),
        "paidint": (paid * Decimal("0.2")).quantize(Decimal("0.0001")),
    }


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in SCHEMA) for r in rows], SCHEMA)


def found(df):
    return {
        (r.ss, r.loan_id): {k: v for k, v in r.asDict().items() if k not in ("ss", "loan_id", "loan_date", "loan_type", "net")}
        for r in df.collect()
    }


def check(spark, rows, block_rows):
    assert found(ledger_loan_totals(frame(spark, rows), block_rows)) == loan_totals(rows)


HAND_MADE = {
    "one loan": [event(1, 1, "New Loan", "100"), event(2, 1, "Payment", payment="40.5")],
    "loans back to back": [event(1, 1, "New Loan", "100"), event(2, 1, "Renewal", "50"), event(3, 1, "Renewal", "70")],
    "new loan between renewals": [
        event(1, 1, "Renewal", "100"), event(2, 1, "Payment", payment="10"), event(3, 1, "New Loan", "30"),
        event(4, 1, "Payment", payment="20"), event(5, 1, "Renewal", "60"), event(6, 1, "Payment", payment="5"),
    ],
    "reverts and returns only": [
        event(1, 1, "New Loan", "100"), event(2, 1, "Payment Revert", payment="-10"),
        event(3, 1, "Return", payment="-5"), event(4, 1, "Renewal", "10"),
    ],
    "case and blanks": [
        event(1, 1, "new loan  ", "100"), event(2, 1, "ACH PAYMENT", payment="3"), event(3, 1, "RENEWAL ", "9.5"),
        event(4, 1, "return", payment="-1"), event(5, 1, "LOAN INCREASE", "2.5"),
        event(6, 1, "active -> written off ", "4"),
    ],
    "events before the first loan": [
        event(1, 1, "Payment", payment="7"), event(2, 1, "Renewal", "10"), event(3, 1, "Payment", payment="1"),
        event(4, 1, "Renewal", "20"),
    ],
    "dates out of order": [
        event(1, 1, "New Loan", "10", day=9), event(2, 1, "Payment", payment="1", day=8),
        event(3, 1, "Payment", payment="2", day=2), event(4, 1, "Renewal", "20", day=5),
    ],
}


@pytest.mark.parametrize("name", HAND_MADE)
@pytest.mark.parametrize("block_rows", [1_000_000, 1, 2])
def test_hand_made(spark, name, block_rows):
    check(spark, HAND_MADE[name], block_rows)


def random_ledger(seed, customers=12, rows=400, hot=1 / 3, apart=10):
    rng = random.Random(seed)
    kinds = ["New Loan", "Renewal", "Payment", "ACH Payment", "Payment Revert", "Return", "Loan Increase",
             "Active -> Written Off", "Note"]
    weights = rng.choice([[1, 2, 8, 4, 1, 1, 1, 1, 1], [5, 5, 1, 1, 1, 1, 1, 1, 1], [1, 1, 30, 0, 0, 0, 0, 0, 5],
                          [6, 1, 6, 1, 1, 1, 1, 1, 1]])
    out = []
    for i in sorted(rng.sample(range(apart * rows), rows)):
        ss = 0 if rng.random() < hot else rng.randrange(1, customers)
        cents = Decimal(rng.randrange(1, 99999)) / 100
        out.append(event(i, ss, rng.choices(kinds, weights)[0], str(cents), str(cents), day=rng.randrange(60)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_ledgers_whole_and_split(spark, seed):
    rows = random_ledger(seed)
    for block_rows in (1_000_000, 10, 30):
        check(spark, rows, block_rows)


def test_partitioning_does_not_matter(spark):
    df = frame(spark, random_ledger(7))
    one = found(ledger_loan_totals(df.repartition(1), 50))
    assert one == found(ledger_loan_totals(df.repartition(8, "id"), 50))


def test_customer_totals(spark):
    rows = random_ledger(3)
    expected = {ss: {k[6:]: v for k, v in t.items() if k.startswith("total_")} for (ss, _), t in loan_totals(rows).items()}
    got = {r.ss: {k: v for k, v in r.asDict().items() if k != "ss"} for r in customer_totals(frame(spark, rows)).collect()}
    assert {ss: got[ss] for ss in expected} == expected


def test_payment_flags_are_three_different_things(spark):
    kinds = ["Payment", "Paid off by pay plan", "Payment Revert", "Return"]
    rows = [event(i, 1, k, payment="1") for i, k in enumerate(kinds)]
    got = classify_events(frame(spark, rows)).orderBy("id").select("is_payment", "is_pay_like", "is_collected", "is_revert")
    assert [tuple(r) for r in got.collect()] == [(1, 1, 1, 0), (0, 1, 1, 0), (1, 1, 1, 1), (1, 0, 1, 0)]


def test_sparse_ids_and_one_customer_with_half_the_rows(spark):
    rows = random_ledger(11, rows=500, hot=1 / 2, apart=10**12)
    for event_ in rows:
        event_["dte"] = DAY
    check(spark, rows, 20)
    df = frame(spark, rows)
    large = blocks.split(df, 20)[1].groupBy("ss", "blk").count().filter("ss = 0")
    assert large.count() > 5 and large.agg(F.max("count")).first()[0] <= 40


def test_segment_ids(spark):
    rows = random_ledger(4)
    expected = {}
    for r in rows:
        before = [x["type"] for x in rows if x["ss"] == r["ss"] and x["id"] <= r["id"]]
        expected[r["ss"], r["id"]] = (sum(k in ("New Loan", "Renewal") for k in before), before.count("Renewal"))
    for block_rows in (1_000_000, 10):
        assert {(r.ss, r.id): (r.loan_seq, r.renewal_seq) for r in segment_ids(frame(spark, rows), block_rows).collect()} == expected


def test_block_bounds(spark):
    """Large customers alone are cut, into blocks of about the same size whether their ids are dense or far apart."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") * F.col("id") * 1000).alias("id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 2).otherwise(F.col("id") % 997 + 2).cast("bigint").alias("ss"),
    )
    ordinary, large = blocks.split(df, 500)
    sizes = large.groupBy("ss", "blk").count().collect()
    assert {r.ss for r in sizes} == {0, 1} and sum(r["count"] for r in sizes) == 20_000
    assert all(250 <= r["count"] <= 1100 for r in sizes)
    assert ordinary.count() == 40_000 and ordinary.filter("ss < 2").count() == 0


def test_blocks_of_very_many_cuts(spark):
    df = spark.range(3000).select(F.col("id") * 7, F.lit(1).cast("bigint").alias("ss")).toDF("id", "ss")
    got = {r.id: r.blk for r in blocks.split(df, 1)[1].collect()}
    assert got == {i * 7: i for i in range(3000)}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_plan_for_any_ledger(spark):
    """Building the plan reads nothing, and it is the same for a single small customer and for large ones."""
    small = plan_text(ledger_loan_totals(frame(spark, random_ledger(1, customers=2, rows=20, hot=0))))
    large = plan_text(ledger_loan_totals(frame(spark, random_ledger(2, rows=900)), 30))

    def nodes(plan):
        return [line.strip(" +-:*()0123456789").split("(")[0].split(" ")[0] for line in plan.splitlines()]

    assert nodes(small) == nodes(large)
    assert "NestedLoop" not in large and "Cartesian" not in large
    assert "hashpartitioning(ss" in large and "blk" in large


def test_ordinary_customers_are_shuffled_once(spark):
    """Without large customers the blocks are dropped at run time; one shuffle of the ledger is left."""
    rows = ledger_loan_totals(frame(spark, random_ledger(1, hot=0)))
    rows.collect()
    final = plan_text(rows)
    final = final[: final.index("== Initial Plan ==")] if "== Initial Plan ==" in final else final
    assert "blk" not in final
    assert sum("Exchange hashpartitioning(ss" in line and "dte" not in line for line in final.splitlines()) <= 2
