"""Column contracts of the source tables, the request records and the feature sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(15, 4),
    "string": T.StringType(),
    "date": T.DateType(),
}


def _schema(columns: str) -> T.StructType:
    """'name type, name type' as a schema; needs no session, unlike a DDL text."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SOURCE_SCHEMAS = {
    "ledger": _schema(
        "id bigint, ss bigint, dte date, type string, net money, payment money,"
        "paidprin money, paidint money"
    ),
    "payday": _schema(
        "id bigint, social bigint, extra4 string, type string, yearsonjob string, email string,"
        "bankaccountlengthmonths string, monthsatresidence string, salary string, dob date,"
        "datedue date, routingnum string, state string"
    ),
    "applicant_mapping": _schema("applicantmappingid bigint, paydayid bigint, applicantid bigint"),
    "applicant": _schema("id bigint, email string"),
    "renewal_log": _schema(
        "id bigint, custid bigint, signaturedate date, statusid int, apptypeid int, date date, viewcontractdate date"
    ),
    "renewal_lead": _schema(
        "lirenewallogid bigint, buyappslogid bigint, loanamount money, leadtype string, affiliatesubid bigint"
    ),
    "application_type": _schema("apptypeid int, apptypedescription string, apptypeamount int"),
    "sub_codes": _schema("subcode int, code int"),
    "buy_apps_log": _schema("buyappslogid bigint, applicantid bigint, username string, status string, date date"),
    "affiliate": _schema("username string, leadprice money"),
    "bureau_response": _schema("id bigint, applicantid bigint, storeid string, riskscore int"),
    "customer_restriction": _schema(
        "customerrestrictionid bigint, id bigint, blockrenew int, blocksetup int, emaillistexclude int"
    ),
    "sms_preference": _schema(
        "smspreferenceid bigint, applicantmappingid bigint, marketingpreference int, servicepreference int"
    ),
}

# The twelve model inputs, in the order the model expects them.
TRAIN_VARS = [
    "static_pool_historical",
    "static_pool_previous",
    "age",
    "years_with_us",
    "number_of_loans_before",
    "non_active_duration",
    "previous_loan_amt",
    "historical_loan_amt",
    "bank_account_length_months",
    "months_at_residence",
    "employment_length",
    "wo_entries_historical",
]

# Columns kept beside the model inputs to judge a model on its test rows.
EVALUATION_VARS = TRAIN_VARS + [
    "static_pool_recent",
    "profit_recent",
    "profit_previous",
    "profit_historical",
    "pd_type",
    "salary",
    "recent_loan_amt",
    "wo_entries_previous",
    "if_loss",
]

REQUEST_SCHEMA = _schema(
    "request_id bigint, salary string, employment_length string, bank_account_length_months string,"
    "months_at_residence string, static_pool_historical double, static_pool_previous double, age double,"
    "years_with_us double, number_of_loans_before double, non_active_duration double,"
    "previous_loan_amt double, historical_loan_amt double, wo_entries_historical double"
)

# Training features as text files carry them: numbers that need cleaning stay text until then.
FEATURE_CSV_SCHEMA = _schema(
    "ssn string, email string, applicant_id bigint, first_date_ever date, funded_date_recent date,"
    "last_payment_date date, payroll_freq string, pd_type string, employment_length string,"
    "bank_account_length_months string, months_at_residence string, salary string, age int, risk_score int,"
    "new_ft_score int, total_loan_amt double, recent_loan_amt double, previous_loan_amt double,"
    "number_of_loans_before bigint, total_pay double, pay_recent double, profit_recent double,"
    "pay_historical double, profit_historical double, pay_previous double, profit_previous double,"
    "wo_entries_historical bigint, wo_amount_historical double, years_with_us int, non_active_duration int, wo_entries_previous bigint"
)


def conform(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Select the declared columns in their declared types; a missing column is an error, not a null."""
    present = {c.lower() for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in present]
    if missing:
        raise ValueError(f"{name} lacks column(s): {', '.join(missing)}")
    types = {f.name.lower(): f.dataType for f in df.schema}
    return df.select(
        *[
            f.name if types[f.name.lower()] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
