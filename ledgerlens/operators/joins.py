"""Loans joined to customers, applications, leads and affiliates, row by row.

Table sizes are left to the optimizer: it broadcasts what it measures as small and otherwise shuffles, and adaptive
execution splits skewed partitions of the loan side. Nothing here carries a broadcast hint. Keys that are mostly missing
or have few values, as user names, application types and the one status of a signed application, are dealt out
(`operators.skew`) or looked up without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.events import normal_text
from ledgerlens.operators.lookups import ACCEPTED, application_entries
from ledgerlens.operators.skew import spread_join
from ledgerlens.sources.tables import Sources

# Customer types and the ledger types a feature row starts from.
STORED, WRITTEN_OFF = "stored", "written off"
BASE_LOANS = {"training": ["renewal"], "production": ["new loan", "renewal"]}
CUSTOMER_TYPES = {"training": [STORED, WRITTEN_OFF], "production": [STORED]}
# User names under which the lender's own sites send applications.
HOUSE_USERNAMES = ("mpd", "npd")
RENEWAL_STATUS_CODE = 5
# places that rows of one user name or application type are dealt over
SALTS = 8


def accepted_statuses(sub_codes: DataFrame) -> Column:
    """How many renewal codes the status of accepted applications has: one number, as they all share that status."""
    found = sub_codes.filter((F.col("code") == RENEWAL_STATUS_CODE) & (F.col("subcode") == ACCEPTED))
    return found.agg(F.count(F.lit(1)).alias("n")).scalar()


def base_loans(loans: DataFrame, mode: str, date_range: tuple[str, str] | None = None) -> DataFrame:
    """Loans a feature row may start from. Filters loan totals, never the ledger the totals are taken over."""
    return _of_mode(loans, "loan_type", "loan_date", mode, date_range)


def base_loan_days(ledger: DataFrame, mode: str, date_range: tuple[str, str] | None = None) -> DataFrame:
    """(ss, day, n_loans): how many base loans a customer took on a day. Needs no totals, so it reads the ledger."""
    loans = _of_mode(ledger, "type", "dte", mode, date_range)
    return loans.groupBy("ss", F.to_date("dte").alias("day")).agg(F.count(F.lit(1)).alias("n_loans"))


def _of_mode(
    rows: DataFrame, kind: str, day: str, mode: str, date_range: tuple[str, str] | None
) -> DataFrame:
    chosen = rows.filter(normal_text(kind).isin(BASE_LOANS[mode]))
    if date_range is not None:
        chosen = chosen.filter(F.to_date(day).between(*[F.lit(d).cast("date") for d in date_range]))
    return chosen


def base_customers(
    payday: DataFrame, mode: str, only_payday_id: int | None = None, exclude_states: tuple[str, ...] = ()
) -> DataFrame:
    chosen = payday.filter(normal_text("type").isin(CUSTOMER_TYPES[mode]))
    if only_payday_id is not None:
        chosen = chosen.filter(F.col("id") == only_payday_id)
    if exclude_states:
        chosen = chosen.filter(~normal_text("state").isin([s.lower() for s in exclude_states]))
    return chosen


def join_customer(loans: DataFrame, payday: DataFrame, mapping: DataFrame) -> DataFrame:
    """Inner joins loan - customer - mapping. The key `ss` of the loans appears once in the result."""
    customers = payday.select(
        F.col("id").alias("payday_id"),
        F.col("social").alias("ss"),
        F.col("type").alias("pd_type"),
        "datedue",
    )
    mapped = mapping.select(
        F.col("applicantmappingid").alias("mapping_id"),
        F.col("paydayid").alias("payday_id"),
        F.col("applicantid").alias("mapped_applicant_id"),
    )
    return loans.join(customers, "ss").join(mapped, "payday_id")


def join_dimensions(df: DataFrame, src: Sources) -> DataFrame:
    """Left joins of joined loans to application, lead, application type, status, applicant and both lead logs.

    A key that occurs several times in a table multiplies rows, and that is meant: the loan count of the feature row
    counts them (`plans.features` gets that count without forming these rows).

    Most loans have no application, and some no applicant. What hangs on an application is joined to the
    applications, and what hangs on an applicant to the applicants, before either meets the loans: so no large side
    is ever shuffled on a key that is mostly missing.
    """
    leads = src.renewal_lead.select(
        F.col("lirenewallogid").alias("log_id"),
        F.col("buyappslogid").alias("lead_buy_apps_log_id"),
        F.col("loanamount").alias("lead_loan_amount"),
        F.col("leadtype").alias("lead_type"),
        F.col("affiliatesubid").alias("affiliate_sub_id"),
    )
    by_lead = src.buy_apps_log.select(
        F.col("buyappslogid").alias("lead_buy_apps_log_id"),
        F.col("username").alias("lead_username"),
        F.col("status").alias("lead_status"),
    )
    types = src.application_type.select(
        F.col("apptypeid").alias("log_app_type_id"),
        F.col("apptypedescription").alias("app_type_description"),
        F.col("apptypeamount").alias("app_type_amount"),
    )
    entries = application_entries(src.renewal_log)
    led = spread_join(leads, by_lead.withColumnRenamed("lead_buy_apps_log_id", "log_of_lead"), "lead_buy_apps_log_id", "log_of_lead", ["log_id"])
    typed = spread_join(
        entries, types.withColumnRenamed("log_app_type_id", "type_id"), "log_app_type_id", "type_id", ["log_id"], SALTS
    )
    statuses = accepted_statuses(src.sub_codes)
    applications = (
        typed.join(led.drop("log_of_lead"), "log_id", "left")
        .withColumn("status_code", F.when(statuses > 0, F.lit(RENEWAL_STATUS_CODE)))
        .withColumn("nth_status", F.explode(F.array_repeat(F.lit(0), F.greatest(statuses, F.lit(1)).cast("int"))))
        .drop("type_id", "nth_status")
    )
    own_log = src.buy_apps_log.select(
        F.col("applicantid").alias("applicant_id"),
        F.col("buyappslogid").alias("own_buy_apps_log_id"),
        F.col("username").alias("own_username"),
        F.col("status").alias("own_status"),
    )
    applicants = src.applicant.select(
        F.col("id").alias("applicant_id"), F.col("email").alias("applicant_email")
    ).join(own_log, "applicant_id", "left")
    signed = df.join(applications, ["payday_id", "loan_date"], "left")
    return spread_join(signed, applicants, "mapped_applicant_id", "applicant_id", ["loan_id", "mapping_id"])


def join_affiliate(df: DataFrame, affiliate: DataFrame) -> DataFrame:
    """Left join to affiliates whose user name is the lead's **or** the applicant's own.

    Written as an equality: first mark which of the two names any affiliate has, then join once per distinct name
    that has one. Rows without any keep one null name.
    """
    named = affiliate.withColumn("username", normal_text("username"))
    known = named.groupBy("username").agg(F.lit(True).alias("known"))

    by = ["loan_id", "mapping_id", "lead_buy_apps_log_id", "own_buy_apps_log_id"]

    def mark(rows: DataFrame, name: str) -> DataFrame:
        names = known.select(F.col("username").alias(f"{name}_of"), F.col("known").alias(f"{name}_known"))
        return spread_join(rows.withColumn(f"{name}_key", normal_text(name)), names, f"{name}_key", f"{name}_of", by, SALTS)

    marked = mark(mark(df, "lead_username"), "own_username")
    names = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(F.col("lead_username_known"), F.col("lead_username_key")),
                F.when(F.col("own_username_known"), F.col("own_username_key")),
            )
        )
    )
    helpers = [f"{n}_{x}" for n in ("lead_username", "own_username") for x in ("key", "known", "of")]
    prices = named.select(F.col("username").alias("affiliate_of"), F.col("leadprice").alias("lead_price"))
    exploded = marked.withColumn("affiliate_key", F.explode_outer(names))
    return spread_join(exploded, prices, "affiliate_key", "affiliate_of", by, SALTS).drop("affiliate_of", *helpers)


def affiliate_fields(df: DataFrame) -> DataFrame:
    """Source category, user name and status of a joined loan; the lead's values go before the applicant's own."""
    lead, own = normal_text("lead_username"), normal_text("own_username")
    house = F.coalesce(lead, own)
    organic = house.isNull() | house.isin(*HOUSE_USERNAMES)
    return df.withColumns(
        {
            "affiliate_cat": F.when(organic, F.lit("Organic")).otherwise(F.lit("Leads")),
            "affiliate": F.coalesce("lead_username", "own_username"),
            "bal_status": F.coalesce("lead_status", "own_status"),
        }
    )


def attach_campaign(gift: DataFrame, features: DataFrame) -> DataFrame:
    """Campaign rows with the features of their applicant. Features have one row per applicant."""
    return gift.join(features, "applicant_id", "left")


def loan_state(df: DataFrame, as_of: str, grace_days: int = 7) -> DataFrame:
    """Paid-off and cycled flags of joined loans (columns of `ledger_loan_totals` and `datedue`)."""
    open_amount = F.col("current_principal_paid") - F.col("net") - F.col("current_li_amount")
    paid_off = open_amount >= 0
    late = F.datediff(F.lit(as_of).cast("date"), F.col("datedue")) > grace_days
    nothing_paid = (F.col("current_amount_paid") == 0) & late
    zero = F.lit(0).cast("decimal(38,4)")
    return df.withColumns(
        {
            "paid_off": F.when(paid_off, 1).otherwise(0),
            "paid_off_principal": F.when(paid_off, F.col("current_principal_paid")).otherwise(zero),
            "cycled_zp": F.when(nothing_paid, 1).otherwise(0),
            "cycled": F.when(nothing_paid | (F.col("current_amount_paid") > 0), 1).otherwise(0),
        }
    )


def ptl(df: DataFrame) -> DataFrame:
    """Previous loan's payments over this loan, both in whole units; 0 if this loan rounds to 0."""
    loan = F.col("net").cast("decimal(18,0)")
    paid = F.col("previous_amount_paid").cast("decimal(18,0)")
    return df.withColumn("ptl", F.when(loan == 0, F.lit(0)).otherwise(F.try_divide(paid, loan)))
