"""The lending tables derived from a retail star schema (events, customer, orders, supplier, region).

Used for tests and measurements. Each entry is (table, filter, {column: SQL expression}); the expressions are plain
SQL, so the same text defines the views an SQL engine checks the results on.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.schemas import SOURCE_SCHEMAS, conform
from ledgerlens.sources.tables import Sources

_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
_AMT = "cast(value as decimal(15,4))"
_TYPE = f"""case event_type when 'signup' then 'New Loan' when 'purchase' then 'Renewal' when 'view' then 'Payment'
 when 'click' then case when {_K} < 80 then 'Payment' when {_K} < 90 then 'Payment Revert' else 'Loan Increase' end
 else case when {_K} < 20 then 'Active -> Written Off' when {_K} < 40 then 'Return' else 'ACH Payment' end end"""
_NET = f"""case when ({_TYPE}) in ('New Loan', 'Renewal', 'Loan Increase', 'Active -> Written Off')
 then {_AMT} else cast(0 as decimal(15,4)) end"""
_PAYMENT = f"""case when ({_TYPE}) in ('Payment', 'ACH Payment') then {_AMT}
 when ({_TYPE}) in ('Return', 'Payment Revert') then cast(-{_AMT} as decimal(15,4)) else cast(0 as decimal(15,4)) end"""

SAMPLES: dict[str, tuple[str, str, dict[str, str]]] = {
    "ledger": (
        "events",
        "true",
        {
            "id": "event_id",
            "ss": "user_id",
            "dte": "cast(ts as date)",
            "type": _TYPE,
            "net": _NET,
            "payment": _PAYMENT,
            "paidprin": f"cast(({_PAYMENT}) * 0.8 as decimal(15,4))",
            "paidint": f"cast(({_PAYMENT}) * 0.2 as decimal(15,4))",
        },
    ),
    "payday": (
        "customer",
        "true",
        {
            "id": "c_custkey + 100000",
            "social": "c_custkey",
            "extra4": "c_mktsegment",
            "type": """case when c_custkey % 10 < 7 then 'Stored' when c_custkey % 10 < 9 then 'Written Off'
 else 'Active' end""",
            "yearsonjob": """case c_custkey % 6 when 0 then null when 1 then 'N/A' when 2 then ''
 when 3 then '3 1/2 Year(s) 0 Month(s)'
 else concat(cast(c_custkey % 15 as string), ' Year(s) ', cast(c_custkey % 12 as string), ' Month(s)') end""",
            "email": "concat('c', cast(c_custkey as string), '@example.com')",
            "bankaccountlengthmonths": "case when c_custkey % 11 = 0 then null else cast(c_custkey % 120 as string) end",
            "monthsatresidence": "case when c_custkey % 13 = 0 then null else cast((c_custkey * 7) % 240 as string) end",
            "salary": """case c_custkey % 7 when 0 then null when 1 then concat('$', cast(1500 + c_custkey % 3000 as string))
 when 2 then concat('1.', cast(100 + c_custkey % 900 as string), '.50') when 3 then '2.50'
 else cast(1000 + c_custkey % 4000 as string) end""",
            "dob": """case when c_custkey % 50 = 0 then cast('0975-06-01' as date)
 else cast('1950-01-01' as date) + cast((c_custkey * 37) % 18000 as int) end""",
            "datedue": "cast('2024-01-01' as date) + cast(c_custkey % 45 as int)",
            "routingnum": "lpad(cast(c_custkey % 997 as string), 9, '0')",
            "state": "case when c_nationkey % 5 = 0 then 'Ohio' else 'Texas' end",
        },
    ),
    "applicant": (
        "customer",
        "true",
        # one in seventeen is nobody's applicant, and so some customers have none
        {"id": "c_custkey + case when c_custkey % 17 = 0 then 900000 else 500000 end", "email": "concat('a', cast(c_custkey as string), '@example.com')"},
    ),
    "renewal_log": (
        "events",
        "event_type = 'purchase'",
        {
            "id": "event_id",
            "custid": "user_id + 100000",
            "signaturedate": "cast(ts as date) - cast(event_id % 8 as int)",
            "statusid": "case when event_id % 4 = 0 then 2 else 1 end",
            "apptypeid": "cast(event_id % 7 as int)",
            "date": "cast(ts as date)",
            "viewcontractdate": "cast(ts as date) - 1",
        },
    ),
    "renewal_lead": (
        "events",
        "event_type = 'purchase'",
        {
            # one in three belongs to no application
            "lirenewallogid": "case when event_id % 3 = 0 then -event_id else event_id end",
            "buyappslogid": "(event_id % 1500) * 10",
            "loanamount": _AMT,
            "leadtype": "case when event_id % 2 = 0 then 'web' else 'sms' end",
            "affiliatesubid": "event_id % 9",
        },
    ),
    "application_type": (
        "region",
        "true",
        {
            "apptypeid": "r_regionkey",
            "apptypedescription": "r_name",
            "apptypeamount": "100 * (r_regionkey + 1)",
        },
    ),
    "sub_codes": (
        "region",
        "true",
        {"subcode": "r_regionkey", "code": "case when r_regionkey < 3 then 5 else 6 end"},
    ),
    # urgent orders are applications, other orders none
    "buy_apps_log": (
        "orders",
        "o_orderpriority = '1-URGENT'",
        {
            "buyappslogid": "o_orderkey",
            "applicantid": "o_custkey + 500000",
            "username": """case o_orderkey % 60 when 0 then null when 10 then 'mpd' when 20 then 'npd'
 else concat('Supplier#', lpad(cast(o_orderkey % 100 as string), 9, '0')) end""",
            "status": "o_orderstatus",
            "date": "cast(o_orderdate as date)",
        },
    ),
    "affiliate": ("supplier", "true", {"username": "s_name", "leadprice": "cast(s_acctbal as decimal(15,4))"}),
    "bureau_response": (
        "orders",
        "true",
        {
            "id": "o_orderkey",
            "applicantid": "o_custkey + 500000",
            "storeid": """case o_orderpriority when '1-URGENT' then '0010' when '2-HIGH' then '0020'
 when '3-MEDIUM' then '0030' else '0040' end""",
            "riskscore": "cast((o_orderkey * 13) % 900 as int)",
        },
    ),
    "customer_restriction": (
        "orders",
        "true",
        {
            "customerrestrictionid": "o_orderkey",
            "id": "o_custkey + 100000",
            "blockrenew": "case when o_orderstatus = 'F' then 1 else 0 end",
            "blocksetup": "case when o_orderstatus = 'P' then 1 else 0 end",
            "emaillistexclude": "case when o_orderkey % 5 = 0 then 1 else 0 end",
        },
    ),
    "sms_preference": (
        "orders",
        "true",
        {
            "smspreferenceid": "o_orderkey",
            "applicantmappingid": "o_custkey",
            "marketingpreference": "case when o_orderkey % 4 = 1 then 1 else 0 end",
            "servicepreference": "case when o_orderkey % 5 = 1 then 1 else 0 end",
        },
    ),
    # scored customers: no lending table, but what a scoring run leaves behind
    "scored": (
        "customer",
        "true",
        {
            "applicant_id": "c_custkey",
            "score": "cast(cast((c_acctbal + 1000) / 11 as decimal(9,3)) as double)",
            "if_loss": "case when (c_custkey * 7919) % 1000 > (c_acctbal + 1000) / 11 then 1 else 0 end",
            "previous_loan_amt": "cast(200 + c_custkey % 800 as double)",
            "funded_amount": "case when c_custkey % 3 = 0 then cast(100 + c_custkey % 500 as double) else null end",
        },
    ),
}

# A customer with c_custkey divisible by 20 has two mappings, to force joined rows per customer above one.
_MAPPINGS = ("customer", "true", {"applicantmappingid": "c_custkey", "paydayid": "c_custkey + 100000",
                                  "applicantid": "c_custkey + 500000"})
_MAPPINGS_TWICE = ("customer", "c_custkey % 20 = 0", {"applicantmappingid": "c_custkey + 1000000",
                                                      "paydayid": "c_custkey + 100000",
                                                      "applicantid": "c_custkey + 700000"})


def _select(source: DataFrame, sample: tuple[str, str, dict[str, str]]) -> DataFrame:
    _, where, columns = sample
    return source.filter(where).selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def _sample(read, name: str) -> DataFrame:
    if name == "applicant_mapping":
        customers = read("customer")
        return _select(customers, _MAPPINGS).unionByName(_select(customers, _MAPPINGS_TWICE))
    return _select(read(SAMPLES[name][0]), SAMPLES[name])


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; a lending table comes in its declared columns."""
    df = _sample(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), name)
    return conform(df, SOURCE_SCHEMAS[name], name) if name in SOURCE_SCHEMAS else df


def sample_sources(spark: SparkSession, sf_dir: str) -> Sources:
    # each file's schema is read once, not once per derived table
    read = cache(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return Sources.of(lambda name: _sample(read, name))


def sample_views() -> dict[str, str]:
    """Name -> SQL text of each table over the star schema, for checks in SQL."""

    def text(sample: tuple[str, str, dict[str, str]]) -> str:
        table, where, columns = sample
        return f"select {', '.join(f'{e} as {c}' for c, e in columns.items())} from {table} where {where}"

    views = {name: text(sample) for name, sample in SAMPLES.items()}
    views["applicant_mapping"] = f"{text(_MAPPINGS)} union all {text(_MAPPINGS_TWICE)}"
    return views


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A longer ledger: orders are loans, their line items payments.

    Ids are far apart; they sort by day, loans first, then order and line.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")

    def entry_id(day: str, late: int, line: str) -> str:
        days = f"cast(datediff(cast({day} as date), date '1990-01-01') as bigint)"
        return f"({days} * 2 + {late}) * 1000000000000 + o_orderkey * 10 + {line} as id"

    zero = "cast(0 as decimal(15,4))"
    loans = orders.selectExpr(
        entry_id("o_orderdate", 0, "0"),
        "o_custkey as ss",
        "cast(o_orderdate as date) as dte",
        "case when o_orderkey % 5 = 0 then 'New Loan' else 'Renewal' end as type",
        "cast(o_totalprice as decimal(15,4)) as net",
        f"{zero} as payment",
        f"{zero} as paidprin",
        f"{zero} as paidint",
    )
    payments = items.join(orders, items.l_orderkey == orders.o_orderkey).selectExpr(
        entry_id("l_shipdate", 1, "l_linenumber"),
        "o_custkey as ss",
        "cast(l_shipdate as date) as dte",
        "case when l_returnflag = 'R' then 'Payment Revert' else 'Payment' end as type",
        f"{zero} as net",
        "cast(l_extendedprice as decimal(15,4)) as payment",
        "cast(l_extendedprice as decimal(15,4)) as paidprin",
        f"{zero} as paidint",
    )
    return loans.unionByName(payments)
