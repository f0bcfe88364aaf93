"""What a ledger event is, read off its type text, and what it adds to each running total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ledger and customer type texts, compared without case and trailing blanks.
NEW_LOAN = "new loan"
RENEWAL = "renewal"
LOAN_INCREASE = "loan increase"
RETURN = "return"
WRITTEN_OFF = "active -> written off"

# Measures of an event, by the way they combine.
SUM_MEASURES = [
    "payments_made",
    "wo_entries",
    "wo_amount",
    "pay_events",
    "reverts_made",
    "li_times",
    "li_amount",
    "principal_paid",
    "interest_paid",
    "amount_paid",
]
MIN_MEASURES = ["first_payment_date"]
MAX_MEASURES = ["last_payment_date"]
MEASURES = SUM_MEASURES + MIN_MEASURES + MAX_MEASURES

# Two more that are only taken over a customer's whole history.
LIFETIME_SUMS = SUM_MEASURES + ["total_loan_amt"]
LIFETIME_MINS = MIN_MEASURES + ["first_loan_date"]
LIFETIME_MEASURES = LIFETIME_SUMS + LIFETIME_MINS + MAX_MEASURES


def how(measure: str) -> str:
    """sum, min or max: how a measure combines over rows."""
    if measure in LIFETIME_MINS:
        return "min"
    return "max" if measure in MAX_MEASURES else "sum"


def over_rows(measure: str, value: Column | str | None = None) -> Column:
    """Aggregate of a measure over rows."""
    value = F.col(measure) if value is None else value
    return {"sum": F.sum, "min": F.min, "max": F.max}[how(measure)](value)


def combine(measure: str, a: Column, b: Column) -> Column:
    """Two partial results of a measure into one; a null part counts as no rows."""
    if how(measure) == "min":
        return F.least(a, b)
    if how(measure) == "max":
        return F.greatest(a, b)
    return F.coalesce(a + b, a, b)


def normal_text(c: Column | str) -> Column:
    """Text as the source server compares it: no case, no trailing blanks."""
    return F.lower(F.rtrim(F.col(c) if isinstance(c, str) else c))


def classify_events(ledger: DataFrame) -> DataFrame:
    """Ledger rows with 0/1 flags and the amount each row adds to every measure.

    A payment in the narrow sense (`is_payment`) is text with "payment" or a return; money counts as collected
    (`is_collected`) for any text with "pay", reverts among them, or a return.
    """
    flags = {
        "is_new_loan": f"_kind = '{NEW_LOAN}'",
        "is_renewal": f"_kind = '{RENEWAL}'",
        "is_loan": f"_kind in ('{NEW_LOAN}', '{RENEWAL}')",
        "is_payment": f"contains(_kind, 'payment') or _kind = '{RETURN}'",
        "is_pay_like": "contains(_kind, 'pay')",
        "is_return": f"_kind = '{RETURN}'",
        "is_collected": f"contains(_kind, 'pay') or _kind = '{RETURN}'",
        "is_revert": "contains(_kind, 'revert')",
        "is_increase": f"contains(_kind, '{LOAN_INCREASE}')",
        "is_written_off": f"_kind = '{WRITTEN_OFF}'",
    }
    paid_day = "case when is_collected = 1 then to_date(dte) end"
    lent = f"is_loan = 1 or _kind = '{LOAN_INCREASE}'"
    measures = {
        "payments_made": "is_payment",
        "wo_entries": "is_written_off",
        "wo_amount": _amount("is_written_off = 1", "net", "decimal(18,4)"),
        "pay_events": "is_pay_like",
        "reverts_made": "is_revert",
        "li_times": "is_increase",
        "li_amount": _amount("is_increase = 1", "net"),
        "principal_paid": _amount("is_collected = 1", "paidprin"),
        "interest_paid": _amount("is_collected = 1", "paidint"),
        "amount_paid": _amount("is_collected = 1", "payment"),
        "first_payment_date": paid_day,
        "last_payment_date": paid_day,
        # whole money units, each loan rounded before it is added
        "total_loan_amt": _amount(lent, "net", "decimal(18,0)"),
        "first_loan_date": "case when is_new_loan = 1 then to_date(dte) end",
    }
    kinds = ledger.withColumn("_kind", normal_text("type"))
    flagged = kinds.withColumns({k: F.expr(f"cast(coalesce({v}, false) as int)") for k, v in flags.items()})
    return flagged.withColumns({k: F.expr(v) for k, v in measures.items()}).drop("_kind")


def _amount(condition: str, column: str, decimal: str = "decimal(15,4)") -> str:
    return f"case when {condition} then cast({column} as {decimal}) else cast(0 as {decimal}) end"
