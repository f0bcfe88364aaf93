"""Loan-by-loan totals over the ledger: this loan, the previous loan, the customer's whole history.

Every loan row (`New Loan` or `Renewal`) opens a segment that holds the events up to the next loan row.

* current  = segments from this loan up to the next *Renewal* (a New Loan in between does not end it)
* previous = events strictly between the previous loan row and this one; null if there are none
* total    = all rows of the customer

One shuffle by customer serves all of it: number the segments, aggregate them in place, and window over the much
smaller segment table. Customers too large for one task are worked on in blocks (`operators.blocks`): segments are
windowed inside the block, and a block summary, one row a block, carries totals across block edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.events import (
    LIFETIME_MEASURES,
    MEASURES,
    NEW_LOAN,
    RENEWAL,
    classify_events,
    combine,
    normal_text,
    over_rows,
)
from ledgerlens.operators.blocks import BLOCK_ROWS, split

# frame bounds: all rows before the current one, in window order
START, CURRENT, BEFORE = Window.unboundedPreceding, Window.currentRow, -1


def _segments(ledger: DataFrame, keys: list[str]) -> DataFrame:
    """One row per loan with the totals of its segment; events ahead of the first loan have loan_seq 0.

    The shuffle below the window carries the ledger's own columns; flags and measures are added above it.
    """
    upto = Window.partitionBy(*keys).orderBy("id").rowsBetween(START, CURRENT)
    kind = normal_text("type")
    loans, renewals = F.count_if(kind.isin(NEW_LOAN, RENEWAL)), F.count_if(kind == RENEWAL)
    numbered = ledger.withColumns({"loan_seq": loans.over(upto), "renewal_seq": renewals.over(upto)})
    is_loan = F.col("is_loan") == 1
    return classify_events(numbered).groupBy(*keys, "loan_seq", "renewal_seq").agg(
        F.max(F.when(is_loan, F.col("id"))).alias("loan_id"),
        F.max(F.when(is_loan, F.to_date("dte"))).alias("loan_date"),
        F.max(F.when(is_loan, F.col("net"))).alias("net"),
        F.max("is_renewal").alias("is_renewal"),
        F.sum(1 - F.col("is_loan")).alias("n_events"),
        *[over_rows(m).alias(m) for m in LIFETIME_MEASURES],
    )


def _in_block(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Per segment: neighbours and totals as seen inside its customer's block."""
    # `run` falls as renewal_seq rises: newest loan first is also the order of (run, loan_seq), so one sort serves all
    back = Window.partitionBy(*keys).orderBy("run", F.desc("loan_seq"))
    later = back.rowsBetween(START, BEFORE)
    to_renewal = Window.partitionBy(*keys, "run").orderBy(F.desc("loan_seq")).rowsBetween(START, CURRENT)
    whole = Window.partitionBy(*keys)
    renewal = F.when(F.col("is_renewal") == 1, F.struct(F.col("loan_id").alias("id"), F.col("loan_date").alias("date")))
    return segments.withColumn("run", -F.col("renewal_seq")).withColumns(
        {
            "next": F.last(renewal, ignorenulls=True).over(later),
            # column by column, so that only the ones in use are computed
            **{f"prev_{c}": F.lead(c).over(back) for c in ("loan_id", "loan_date", "net", "n_events", *MEASURES)},
            **{f"current_{m}": over_rows(m).over(to_renewal) for m in MEASURES},
            **{f"total_{m}": over_rows(m).over(whole) for m in LIFETIME_MEASURES},
        }
    )


def _block_edges(segments: DataFrame) -> DataFrame:
    """(ss, blk) -> what the blocks before and after it contribute.

    A block is summed up as: its last loan and the totals after it (`tail_*`), its first renewal and the totals ahead
    of it (`ahead_*`). Windows over a customer's blocks put these together.
    """
    loan = F.when(F.col("loan_seq") > 0, F.struct("loan_id", "loan_date", "net"))
    first = F.when(
        F.col("is_renewal") == 1, F.struct(F.col("loan_id").alias("id"), F.col("loan_date").alias("date"))
    )
    ahead = F.col("renewal_seq") == 0
    tail = F.struct("n_events", *MEASURES)
    blocks = (
        segments.groupBy("ss", "blk")
        .agg(
            F.max("loan_seq").alias("loans"),
            F.max("renewal_seq").alias("renewals"),
            F.max_by(loan, "loan_seq").alias("last_loan"),
            F.min(first).alias("first_renewal"),
            F.max_by(tail, "loan_seq").alias("tail"),
            *[over_rows(m, F.when(ahead, F.col(m))).alias(f"ahead_{m}") for m in MEASURES],
            *[over_rows(m).alias(f"block_{m}") for m in LIFETIME_MEASURES],
        )
        .select(
            "*",
            (F.col("loans") > 0).cast("int").alias("has_loan"),
            (F.col("renewals") > 0).cast("int").alias("has_renewal"),
            F.col("tail.n_events").alias("tail_n_events"),
            *[F.col(f"tail.{m}").alias(f"tail_{m}") for m in MEASURES],
        )
        .drop("tail")
    )
    up = Window.partitionBy("ss").orderBy("blk")
    down = Window.partitionBy("ss").orderBy(F.desc("blk"))
    # runs of blocks: from one with a loan up to the next such, and from one with a renewal down to the one before
    runs = blocks.withColumns(
        {
            "up_run": F.sum("has_loan").over(up.rowsBetween(START, CURRENT)),
            "down_run": F.sum("has_renewal").over(down.rowsBetween(START, CURRENT)),
        }
    )
    in_up = Window.partitionBy("ss", "up_run").orderBy("blk").rowsBetween(START, CURRENT)
    in_down = Window.partitionBy("ss", "down_run").orderBy(F.desc("blk")).rowsBetween(START, CURRENT)
    summed = runs.withColumns(
        {
            "tail_n_events": F.sum("tail_n_events").over(in_up),
            **{f"tail_{m}": over_rows(m, F.col(f"tail_{m}")).over(in_up) for m in MEASURES},
            **{f"ahead_{m}": over_rows(m, F.col(f"ahead_{m}")).over(in_down) for m in MEASURES},
        }
    )
    return summed.select(
        "ss",
        "blk",
        F.last("last_loan", ignorenulls=True).over(up.rowsBetween(START, BEFORE)).alias("edge_loan"),
        F.last("first_renewal", ignorenulls=True).over(down.rowsBetween(START, BEFORE)).alias("edge_next"),
        F.lag("tail_n_events").over(up).alias("edge_tail_n_events"),
        *[F.lag(f"tail_{m}").over(up).alias(f"edge_tail_{m}") for m in MEASURES],
        *[F.lag(f"ahead_{m}").over(down).alias(f"edge_ahead_{m}") for m in MEASURES],
        *[
            over_rows(m, F.col(f"block_{m}")).over(Window.partitionBy("ss")).alias(f"edge_total_{m}")
            for m in LIFETIME_MEASURES
        ],
    )


def _loan_rows(df: DataFrame, cut: bool) -> DataFrame:
    """Final columns per loan: what its customer has, or what its block has merged with what the block edges bring."""
    local_prev = F.col("prev_loan_id").isNotNull()

    def previous(field: str) -> Column:
        if not cut:
            return F.col(f"prev_{field}")
        return F.when(local_prev, F.col(f"prev_{field}")).otherwise(F.col(f"edge_loan.{field}"))

    def between(m: str) -> Column:
        here, edge = F.col(f"prev_{m}"), F.col(f"edge_tail_{m}")
        if not cut:
            return here
        both = F.coalesce(here + edge, here, edge) if m == "n_events" else combine(m, here, edge)
        return F.when(local_prev, here).otherwise(both)

    def current(m: str) -> Column:
        here = F.col(f"current_{m}")
        if not cut:
            return here
        return F.when(F.col("next").isNotNull(), here).otherwise(combine(m, here, F.col(f"edge_ahead_{m}")))

    def total(m: str) -> Column:
        return F.col(f"edge_total_{m}" if cut else f"total_{m}")

    upcoming = F.coalesce(F.col("next"), F.col("edge_next")) if cut else F.col("next")
    has_events = previous("loan_id").isNotNull() & (between("n_events") > 0)
    return df.filter(F.col("loan_id").isNotNull()).select(
        "ss",
        "loan_id",
        "loan_date",
        F.when(F.col("is_renewal") == 1, F.lit("Renewal")).otherwise(F.lit("New Loan")).alias("loan_type"),
        "net",
        upcoming["id"].alias("next_renewal_id"),
        upcoming["date"].alias("next_renewal_date"),
        previous("loan_id").alias("previous_loan_id"),
        previous("loan_date").alias("previous_loan_date"),
        previous("net").alias("previous_loan_amt"),
        *[current(m).alias(f"current_{m}") for m in MEASURES],
        *[F.when(has_events, between(m)).alias(f"previous_{m}") for m in MEASURES],
        *[total(m).alias(f"total_{m}") for m in LIFETIME_MEASURES],
    )


def ledger_loan_totals(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per loan: neighbours and the totals over this loan, the previous loan and the customer.

    `id` orders the rows of a customer and is unique.
    """
    ordinary, large = split(ledger, block_rows)
    whole = _loan_rows(_in_block(_segments(ordinary, ["ss"]), ["ss"]), False)
    keys = ["ss", "blk"]
    segments = _segments(large, keys)
    return whole.unionByName(_loan_rows(_in_block(segments, keys).join(_block_edges(segments), keys), True))


def segment_ids(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ss, id, loan_seq, renewal_seq): per event, how many loans and renewals the customer has had up to it."""
    kind = normal_text("type")
    is_loan, is_renewal = kind.isin(NEW_LOAN, RENEWAL), kind == RENEWAL

    def numbered(rows: DataFrame, *keys: str) -> DataFrame:
        upto = Window.partitionBy(*keys).orderBy("id").rowsBetween(START, CURRENT)
        return rows.withColumns({"loan_seq": F.count_if(is_loan).over(upto), "renewal_seq": F.count_if(is_renewal).over(upto)})

    ordinary, large = split(ledger, block_rows)
    # a block adds the counts of the customer's earlier blocks
    earlier = Window.partitionBy("ss").orderBy("blk").rowsBetween(START, BEFORE)
    before = (
        large.groupBy("ss", "blk")
        .agg(F.count_if(is_loan).alias("loans"), F.count_if(is_renewal).alias("renewals"))
        .select("ss", "blk", F.sum("loans").over(earlier).alias("loans"), F.sum("renewals").over(earlier).alias("renewals"))
    )
    cut = numbered(large, "ss", "blk").join(before, ["ss", "blk"]).select(
        "ss",
        "id",
        (F.col("loan_seq") + F.coalesce("loans", F.lit(0))).alias("loan_seq"),
        (F.col("renewal_seq") + F.coalesce("renewals", F.lit(0))).alias("renewal_seq"),
    )
    return numbered(ordinary, "ss").select("ss", "id", "loan_seq", "renewal_seq").union(cut)


def next_renewal(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The customer's first renewal after each loan."""
    return ledger_loan_totals(ledger, block_rows).select("ss", "loan_id", "next_renewal_id", "next_renewal_date")


def previous_loan(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The customer's last loan before each loan."""
    return ledger_loan_totals(ledger, block_rows).select(
        "ss", "loan_id", "previous_loan_id", "previous_loan_date", "previous_loan_amt"
    )


def current_loan_totals(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Totals from each loan up to the customer's next renewal."""
    loans = ledger_loan_totals(ledger, block_rows)
    return loans.select("ss", "loan_id", *[F.col(f"current_{m}").alias(m) for m in MEASURES])


def previous_loan_totals(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Totals strictly between the previous loan and each loan; all null if nothing lies between."""
    loans = ledger_loan_totals(ledger, block_rows)
    return loans.select("ss", "loan_id", *[F.col(f"previous_{m}").alias(m) for m in MEASURES])


def customer_totals(ledger: DataFrame) -> DataFrame:
    """Totals over all rows of a customer. A plain group-by: partial sums leave nothing to split."""
    return classify_events(ledger).groupBy("ss").agg(*[over_rows(m).alias(m) for m in LIFETIME_MEASURES])


def first_date_ever(totals: DataFrame, prefix: str = "") -> Column:
    """First loan date, else first payment date."""
    return F.coalesce(F.col(f"{prefix}first_loan_date"), F.col(f"{prefix}first_payment_date"))
