"""One feature row per customer: the training set and the production set.

The row describes the customer's latest base loan, so nothing needs the full product of loans, mappings, leads and
affiliates. Two parts are brought together per customer:

* loans, reduced by `ss` to the latest loan, the last dates and the number of loans per day;
* customer x mapping x applicant, reduced by `ss` to the first by (payday id, applicant id, mapping id).

The number of joined rows (`number_of_loans_before`) is computed from counts per key, see `joined_row_counts`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import age, employment_default, parse_years_on_job
from ledgerlens.functions.events import normal_text
from ledgerlens.operators.blocks import BLOCK_ROWS
from ledgerlens.operators.joins import SALTS, accepted_statuses, base_customers, base_loan_days, base_loans
from ledgerlens.operators.ledger import first_date_ever, ledger_loan_totals
from ledgerlens.operators.lookups import bureau_scores, latest_restriction, latest_sms_preference, signed_by_day
from ledgerlens.operators.skew import spread_join
from ledgerlens.sources.tables import Sources

# Columns of the latest loan both sets use.
LOAN_COLUMNS = [
    "net",
    "current_amount_paid",
    "total_amount_paid",
    "total_total_loan_amt",
    "total_first_loan_date",
    "total_first_payment_date",
]


def _row_counts(df: DataFrame, key: str, alias: str, name: str) -> DataFrame:
    return df.groupBy(F.col(key).alias(alias)).agg(F.count(F.lit(1)).alias(name))


def _borrowers(src: Sources, customers: DataFrame) -> DataFrame:
    """Customer x mapping, with the applicant where there is one; `n_applicants` rows of it in the joined set."""
    applicants = src.applicant.groupBy(F.col("id").alias("applicant_id")).agg(
        F.count(F.lit(1)).alias("n_applicants"), F.min("email").alias("applicant_email")
    )
    mapped = src.applicant_mapping.select(
        F.col("applicantmappingid").alias("mapping_id"),
        F.col("paydayid").alias("payday_id"),
        F.col("applicantid").alias("mapped_applicant_id"),
    )
    known = customers.withColumnsRenamed({"id": "payday_id", "social": "ss"}).join(mapped, "payday_id")
    found = spread_join(known, applicants, "mapped_applicant_id", "applicant_id", ["payday_id", "mapping_id"])
    return found.withColumn("n_applicants", F.coalesce("n_applicants", F.lit(1)))


def joined_row_counts(days: DataFrame, src: Sources, customers: DataFrame) -> DataFrame:
    """(ss, n_rows): rows the full join of base loans would have, without forming them.

    `days` are the loans counted by customer and day, as `base_loan_days` gives them.

    For a loan day and a customer, the leads of the signed application (user name u, n(u) rows) meet the rows of the
    applicant's own log (user name v). Each pair yields as many rows as affiliates are named u or v, at least one.
    With a(u) affiliates named u, summed over v:

    * a(u) = 0: sum of max(1, a(v))
    * a(u) > 0: rows(v) * a(u) + sum of a(v) - [rows with v = u] * a(u)

    so sums per applicant, and per applicant and name, suffice. All inputs are counted per key first.
    """
    affiliates = src.affiliate.groupBy(normal_text("username").alias("affiliate_name")).agg(F.count(F.lit(1)).alias("n_named"))
    app_log = src.buy_apps_log.withColumn("name", normal_text("username"))

    # the applicant's own log, per applicant and name
    own = (
        app_log.groupBy(F.col("applicantid").alias("applicant_id"), "name")
        .agg(F.count(F.lit(1)).alias("n_own"))
    )
    own = spread_join(own, affiliates, "name", "affiliate_name", ["applicant_id"], SALTS).drop("affiliate_name")
    own = own.withColumn("n_named", F.coalesce("n_named", F.lit(0)))
    own_sums = own.groupBy("applicant_id").agg(
        F.sum("n_own").alias("own_rows"),
        F.sum(F.col("n_own") * F.greatest("n_named", F.lit(1))).alias("own_at_least_one"),
        F.sum(F.col("n_own") * F.col("n_named")).alias("own_named"),
    )
    borrowers = _borrowers(src, customers).select("ss", "payday_id", "mapping_id", "applicant_id", "n_applicants")
    # an applicant without log rows counts as one row without a name
    summed = own_sums.withColumnRenamed("applicant_id", "summed_id")
    weighed = spread_join(borrowers, summed, "applicant_id", "summed_id", ["payday_id", "mapping_id"]).select(
        "ss",
        "payday_id",
        *[
            (F.col("n_applicants") * F.coalesce(F.col(c), F.lit(missing))).alias(c)
            for c, missing in (("own_rows", 1), ("own_at_least_one", 1), ("own_named", 0))
        ],
    )
    per_payday = weighed.groupBy("ss", "payday_id").agg(
        F.sum("own_rows").alias("own_rows"),
        F.sum("own_at_least_one").alias("own_at_least_one"),
        F.sum("own_named").alias("own_named"),
    )
    same_name = (
        borrowers.join(own.filter(F.col("n_named") > 0), "applicant_id")
        .groupBy("payday_id", "name")
        .agg(F.sum(F.col("n_applicants") * F.col("n_own")).alias("n_same"))
    )

    # leads of an application, per application and name
    lead_log = app_log.select(F.col("buyappslogid"), "name")
    lead_rows = src.renewal_lead.select(F.col("lirenewallogid").alias("log_id"), F.col("buyappslogid").alias("lead_of"))
    leads = (
        spread_join(lead_rows, lead_log, "lead_of", "buyappslogid", ["log_id"])
        .groupBy("log_id", "name")
        .agg(F.count(F.lit(1)).alias("n_leads"))
    )
    leads = spread_join(leads, affiliates, "name", "affiliate_name", ["log_id"], SALTS).drop("affiliate_name")
    types = _row_counts(src.application_type, "apptypeid", "type_id", "n_types")
    # everything about an application before it meets the loan days, so that no join key is ever missing
    signed = signed_by_day(src.renewal_log).select(
        F.col("custid").alias("payday_id"), "day", F.col("log.id").alias("log_id"), F.col("log.apptypeid").alias("app_type_id")
    )
    applications = (
        spread_join(signed, types, "app_type_id", "type_id", ["log_id"], SALTS)
        .join(leads, "log_id", "left")
        .join(same_name, ["payday_id", "name"], "left")
    )
    a = F.coalesce("n_named", F.lit(0))
    per_lead = F.when(a == 0, F.col("own_at_least_one")).otherwise(
        F.col("own_rows") * a + F.col("own_named") - F.coalesce("n_same", F.lit(0)) * a
    )
    one = F.lit(1)
    factors = F.coalesce("n_types", one) * F.greatest(accepted_statuses(src.sub_codes), one) * F.coalesce("n_leads", one)
    signed_days = (
        applications.join(per_payday, "payday_id")
        .groupBy("ss", "payday_id", "day")
        .agg(F.sum(factors * per_lead).alias("rows"), F.max("own_at_least_one").alias("rows_unsigned"))
    )

    # every loan as if without an application, then what applications add on their days
    plain = (
        days.groupBy("ss")
        .agg(F.sum("n_loans").alias("n_loans"))
        .join(per_payday.groupBy("ss").agg(F.sum("own_at_least_one").alias("n_each")), "ss")
    )
    added = (
        signed_days.join(days, ["ss", "day"])
        .groupBy("ss")
        .agg(F.sum(F.col("n_loans") * (F.col("rows") - F.col("rows_unsigned"))).alias("n_added"))
    )
    total = F.col("n_loans") * F.col("n_each") + F.coalesce("n_added", F.lit(0))
    return plain.join(added, "ss", "left").select("ss", total.cast("bigint").alias("n_rows"))


def _latest(loans: DataFrame, columns: list[str], last_payment: str) -> DataFrame:
    """Per customer: `columns` of the loan with the highest id, and last funding and payment dates of all."""
    return (
        loans.groupBy("ss")
        .agg(
            F.max_by(F.struct(*columns), "loan_id").alias("loan"),
            F.max("loan_date").alias("funded_date_recent"),
            F.max(last_payment).alias("last_payment_date"),
            F.count(F.lit(1)).alias("n_loans"),
        )
        .select("ss", "funded_date_recent", "last_payment_date", "n_loans", "loan.*")
    )


def _first_borrower(src: Sources, customers: DataFrame, columns: list[str]) -> DataFrame:
    """Per customer: the first customer/mapping row by payday id, applicant id (none first) and mapping id."""
    order = F.struct("payday_id", "applicant_id", "mapping_id")
    return (
        _borrowers(src, customers)
        .groupBy("ss")
        .agg(F.min_by(F.struct("payday_id", "applicant_id", "mapping_id", *columns), order).alias("b"))
        .select("ss", "b.*")
    )


def latest_loan(loans: DataFrame, last_payment: str = "total_last_payment_date") -> DataFrame:
    """The customer's loan with the highest id, and the latest funding and payment dates over all loans."""
    columns = ["loan_id", "loan_date", "loan_type", "net"]
    return _latest(loans, columns, last_payment).drop("n_loans")


def first_last_values(loans: DataFrame) -> DataFrame:
    """Per customer: first funding date, and payments, amounts and write-offs of the last loan and the one before.

    First and last over a whole customer are a minimum and a maximum by id, so no window is needed.
    """
    last = {
        "last_pay": "current_amount_paid",
        "last_loan_amt": "net",
        "last_pay_previous": "previous_amount_paid",
        "last_previous_loan_amt": "previous_loan_amt",
        "last_wo_entries": "previous_wo_entries",
        "last_wo_amount": "previous_wo_amount",
    }
    return (
        loans.groupBy("ss")
        .agg(
            F.min("loan_date").alias("first_funded_date"),
            F.max_by(F.struct(*[F.col(c).alias(n) for n, c in last.items()]), "loan_id").alias("last"),
        )
        .select("ss", "first_funded_date", "last.*")
    )


def loan_counts(src: Sources, mode: str) -> DataFrame:
    """Per customer with a mapping: joined rows, and plain loans."""
    days = base_loan_days(src.ledger, mode)
    joined = joined_row_counts(days, src, base_customers(src.payday, mode))
    return joined.join(days.groupBy("ss").agg(F.sum("n_loans").alias("n_loans")), "ss")


def _ssn(show: bool) -> Column:
    """The key itself only on request; otherwise its hash."""
    ss = F.col("ss").cast("string")
    return ss if show else F.sha2(ss, 256)


def _assemble(
    src: Sources,
    mode: str,
    last_payment: str,
    loan_columns: list[str],
    columns: list[str],
    only_payday_id: int | None,
    date_range: tuple[str, str] | None,
    exclude_states: tuple[str, ...],
    count_distinct_loans: bool,
    block_rows: int,
) -> DataFrame:
    loans = base_loans(ledger_loan_totals(src.ledger, block_rows), mode, date_range)
    customers = base_customers(src.payday, mode, only_payday_id, exclude_states)
    rows = _latest(loans, LOAN_COLUMNS + loan_columns, last_payment).join(_first_borrower(src, customers, columns), "ss")
    if count_distinct_loans:
        return rows.withColumn("n_rows", F.col("n_loans"))
    days = base_loan_days(src.ledger, mode, date_range)
    return rows.join(joined_row_counts(days, src, customers), "ss")


def training_features(
    src: Sources,
    only_payday_id: int | None = None,
    date_range: tuple[str, str] | None = None,
    exclude_states: tuple[str, ...] = (),
    count_distinct_loans: bool = False,
    wo_scope: str = "previous",
    fix_century: bool = False,
    show_ssn: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Customers with a renewal: what was known before the latest one, and how that loan went.

    `years_with_us` and `non_active_duration` are days. `wo_scope` "previous" takes write-offs of the previous loan,
    as the training data always did; "all" takes the whole history, as production does.
    """
    columns = ["email", "extra4", "type", "yearsonjob", "bankaccountlengthmonths", "monthsatresidence", "salary", "dob"]
    wo = {"previous": "previous", "all": "total"}[wo_scope]
    loan_columns = ["previous_loan_amt", "previous_amount_paid", "previous_wo_entries", f"{wo}_wo_amount"]
    loan_columns += ["total_wo_entries"] if wo == "total" else []
    rows = _assemble(
        src, "training", "previous_last_payment_date", loan_columns, columns, only_payday_id, date_range,
        exclude_states, count_distinct_loans, block_rows,
    )
    rows = spread_join(rows, bureau_scores(src.bureau_response), "applicant_id", "applicantid", ["ss"])
    first = first_date_ever(rows, "total_")
    total, lent = F.col("total_amount_paid"), F.col("total_total_loan_amt")
    paid, net = F.col("current_amount_paid"), F.col("net")
    return rows.select(
        _ssn(show_ssn).alias("ssn"),
        "email",
        "applicant_id",
        first.alias("first_date_ever"),
        "funded_date_recent",
        "last_payment_date",
        F.col("extra4").alias("payroll_freq"),
        F.col("type").alias("pd_type"),
        parse_years_on_job("yearsonjob").alias("employment_length"),
        F.col("bankaccountlengthmonths").alias("bank_account_length_months"),
        F.col("monthsatresidence").alias("months_at_residence"),
        "salary",
        age("dob", "funded_date_recent", fix_century).alias("age"),
        "risk_score",
        "new_ft_score",
        lent.alias("total_loan_amt"),
        net.alias("recent_loan_amt"),
        F.col("previous_loan_amt"),
        F.col("n_rows").alias("number_of_loans_before"),
        total.alias("total_pay"),
        paid.alias("pay_recent"),
        (paid - net).alias("profit_recent"),
        (total - paid).alias("pay_historical"),
        (total - paid - (lent - net)).alias("profit_historical"),
        F.col("previous_amount_paid").alias("pay_previous"),
        (F.col("previous_amount_paid") - F.col("previous_loan_amt")).alias("profit_previous"),
        F.col(f"{wo}_wo_entries").alias("wo_entries_historical"),
        F.col(f"{wo}_wo_amount").alias("wo_amount_historical"),
        F.datediff("last_payment_date", first).alias("years_with_us"),
        F.datediff("funded_date_recent", "last_payment_date").alias("non_active_duration"),
        F.col("previous_wo_entries").alias("wo_entries_previous"),
    )


def production_features(
    src: Sources,
    as_of: str,
    only_payday_id: int | None = None,
    date_range: tuple[str, str] | None = None,
    exclude_states: tuple[str, ...] = (),
    count_distinct_loans: bool = False,
    show_ssn: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Stored customers as of a day: the latest loan is the *previous* one of the loan to be offered."""
    columns = [
        "extra4", "type", "yearsonjob", "bankaccountlengthmonths", "monthsatresidence", "salary", "dob", "routingnum",
        "applicant_email",
    ]
    rows = (
        _assemble(
            src, "production", "total_last_payment_date", ["total_wo_entries"], columns, only_payday_id, date_range,
            exclude_states, count_distinct_loans, block_rows,
        )
        .join(latest_restriction(src.customer_restriction), "payday_id", "left")
        .join(latest_sms_preference(src.sms_preference), "mapping_id", "left")
    )
    day = F.lit(as_of).cast("date")
    first = first_date_ever(rows, "total_")
    total, lent = F.col("total_amount_paid"), F.col("total_total_loan_amt")
    paid, net = F.col("current_amount_paid"), F.col("net")
    return rows.select(
        "payday_id",
        _ssn(show_ssn).alias("ssn"),
        F.col("applicant_email").alias("email"),
        first.alias("first_date_ever"),
        day.alias("funded_date_recent"),
        "last_payment_date",
        F.col("extra4").alias("payroll_freq"),
        F.col("type").alias("pd_type"),
        "block_renew",
        "block_setup",
        "email_list_exclude",
        "marketing_preference",
        "service_preference",
        "routingnum",
        employment_default(parse_years_on_job("yearsonjob")).alias("employment_length"),
        F.col("bankaccountlengthmonths").alias("bank_account_length_months"),
        F.col("monthsatresidence").alias("months_at_residence"),
        "salary",
        "dob",
        lent.alias("historical_loan_amt"),
        net.alias("previous_loan_amt"),
        F.col("n_rows").alias("number_of_loans_before"),
        total.alias("pay_historical"),
        paid.alias("pay_previous"),
        (paid - net).alias("profit_previous"),
        (total - lent).alias("profit_historical"),
        F.col("total_wo_entries").alias("wo_entries_historical"),
        F.datediff("last_payment_date", first).alias("years_with_us"),
        F.datediff(day, F.col("last_payment_date")).alias("non_active_duration"),
    )
