"""Loan totals row by row in plain Python, to hold the Spark operators against."""

from decimal import Decimal

LOANS = ("new loan", "renewal")


def _kind(row):
    return row["type"].rstrip().lower()


def _totals(rows, lifetime=False):
    if not rows:
        return None
    collected = [r for r in rows if "pay" in _kind(r) or _kind(r) == "return"]
    days = [r["dte"] for r in collected]
    increases = [r for r in rows if "loan increase" in _kind(r)]
    written_off = [r for r in rows if _kind(r) == "active -> written off"]
    out = {
        "payments_made": sum("payment" in _kind(r) or _kind(r) == "return" for r in rows),
        "wo_entries": len(written_off),
        "wo_amount": sum((r["net"] for r in written_off), Decimal(0)),
        "pay_events": sum("pay" in _kind(r) for r in rows),
        "reverts_made": sum("revert" in _kind(r) for r in rows),
        "li_times": len(increases),
        "li_amount": sum((r["net"] for r in increases), Decimal(0)),
        "principal_paid": sum((r["paidprin"] for r in collected), Decimal(0)),
        "interest_paid": sum((r["paidint"] for r in collected), Decimal(0)),
        "amount_paid": sum((r["payment"] for r in collected), Decimal(0)),
        "first_payment_date": min(days, default=None),
        "last_payment_date": max(days, default=None),
    }
    if lifetime:
        lent = [r["net"] for r in rows if _kind(r) in LOANS + ("loan increase",)]
        out["total_loan_amt"] = sum((n.quantize(Decimal(1), "ROUND_HALF_UP") for n in lent), Decimal(0))
        out["first_loan_date"] = min((r["dte"] for r in rows if _kind(r) == "new loan"), default=None)
    return out


def loan_totals(ledger):
    """(ss, loan id) -> flat dict of the columns of `ledger_loan_totals`."""
    result = {}
    for loan in ledger:
        if _kind(loan) not in LOANS:
            continue
        own = [r for r in ledger if r["ss"] == loan["ss"]]
        nexts = [r for r in own if _kind(r) == "renewal" and r["id"] > loan["id"]]
        nxt = min(nexts, key=lambda r: r["id"], default=None)
        befores = [r for r in own if _kind(r) in LOANS and r["id"] < loan["id"]]
        prev = max(befores, key=lambda r: r["id"], default=None)
        current = [r for r in own if r["id"] >= loan["id"] and (nxt is None or r["id"] < nxt["id"])]
        between = [r for r in own if prev is not None and prev["id"] < r["id"] < loan["id"]]
        row = {
            "next_renewal_id": nxt and nxt["id"],
            "next_renewal_date": nxt and nxt["dte"],
            "previous_loan_id": prev and prev["id"],
            "previous_loan_date": prev and prev["dte"],
            "previous_loan_amt": prev and prev["net"],
        }
        parts = (("current_", _totals(current), False), ("previous_", _totals(between), False),
                 ("total_", _totals(own, True), True))
        for prefix, totals, lifetime in parts:
            names = _totals(own, lifetime).keys()
            row.update({prefix + n: None if totals is None else totals[n] for n in names})
        result[(loan["ss"], loan["id"])] = row
    return result
