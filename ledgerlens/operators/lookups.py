"""One row per key out of log and history tables.

All of them are group-bys with a maximum or minimum of a struct: partial results are formed before the shuffle, so a
key with very many rows is no burden to any one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The bureau store with the newer score, and the one to leave out of the general score.
NEW_SCORE_STORE = "0030"
OTHER_STORE = "0020"
ACCEPTED = 1
SIGNED_WITHIN_DAYS = 5


def signed_by_day(log: DataFrame, days: int = SIGNED_WITHIN_DAYS) -> DataFrame:
    """(custid, day) -> the newest accepted entry signed on that day or in the `days` days before it.

    Every entry is put under each day it counts for, which turns the date-range lookup into an equality. Otherwise a
    customer's loans would have to be paired with all of the customer's entries.
    """
    signed = F.to_date("signaturedate")
    fields = ["id", "statusid", "apptypeid", "date", "viewcontractdate", "signaturedate"]
    return (
        log.filter(F.col("statusid") == ACCEPTED)
        .withColumn("day", F.explode(F.sequence(signed, F.date_add(signed, days))))
        .groupBy("custid", "day")
        .agg(F.max_by(F.struct(*fields), "id").alias("log"))
    )


def application_entries(log: DataFrame, days: int = SIGNED_WITHIN_DAYS) -> DataFrame:
    """`signed_by_day` under the names it has beside loans: key (payday_id, loan_date), fields `log_*`."""
    return signed_by_day(log, days).select(
        F.col("custid").alias("payday_id"),
        F.col("day").alias("loan_date"),
        F.col("log.id").alias("log_id"),
        F.col("log.statusid").alias("log_status_id"),
        F.col("log.apptypeid").alias("log_app_type_id"),
        F.col("log.date").alias("log_date"),
        F.col("log.viewcontractdate").alias("log_view_contract_date"),
        F.col("log.signaturedate").alias("log_signature_date"),
    )


def latest_signed_application(loans: DataFrame, log: DataFrame, days: int = SIGNED_WITHIN_DAYS) -> DataFrame:
    """Loans (with `payday_id` and `loan_date`) and their newest signed application; null if none."""
    return loans.join(application_entries(log, days), ["payday_id", "loan_date"], "left")


def bureau_scores(responses: DataFrame) -> DataFrame:
    """applicantid -> one score of the general stores and one of the newer store.

    Of several responses the one with the lowest store id, then the lowest score, is taken.
    """
    store = F.rtrim("storeid")
    entry = F.struct("storeid", "riskscore")
    general = F.when(~store.isin(NEW_SCORE_STORE, OTHER_STORE), entry)
    newer = F.when(store == NEW_SCORE_STORE, entry)
    return (
        responses.groupBy("applicantid")
        .agg(F.min(general).alias("general"), F.min(newer).alias("newer"))
        .select(
            "applicantid",
            F.col("general.riskscore").alias("risk_score"),
            F.col("newer.riskscore").alias("new_ft_score"),
        )
    )


def latest_restriction(restrictions: DataFrame) -> DataFrame:
    """payday_id -> the restriction flags set last."""
    flags = F.struct("blockrenew", "blocksetup", "emaillistexclude")
    return (
        restrictions.groupBy(F.col("id").alias("payday_id"))
        .agg(F.max_by(flags, "customerrestrictionid").alias("r"))
        .select(
            "payday_id",
            F.col("r.blockrenew").alias("block_renew"),
            F.col("r.blocksetup").alias("block_setup"),
            F.col("r.emaillistexclude").alias("email_list_exclude"),
        )
    )


def latest_sms_preference(preferences: DataFrame) -> DataFrame:
    """mapping_id -> the message preferences set last."""
    flags = F.struct("marketingpreference", "servicepreference")
    return (
        preferences.groupBy(F.col("applicantmappingid").alias("mapping_id"))
        .agg(F.max_by(flags, "smspreferenceid").alias("p"))
        .select(
            "mapping_id",
            F.col("p.marketingpreference").alias("marketing_preference"),
            F.col("p.servicepreference").alias("service_preference"),
        )
    )
