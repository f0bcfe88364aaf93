"""The registered queries: each operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.oracle import INTERCEPT, PROFILE_COLUMNS, SCENARIOS, SCORECARDS, WEIGHTS, parse_spec, specs_and_sql
from ledgerlens.functions import cleaning
from ledgerlens.functions.events import classify_events
from ledgerlens.functions.pricing import (
    PRICING_APPLIED,
    PRICING_V1,
    PRICING_V2,
    TOP_SCORE,
    campaign_list,
    interest_rate,
    offer,
    price_as_of,
    renewal_amount,
    rule_rows,
    score_band,
)
from ledgerlens.operators import campaign, joins, ledger, logistic, lookups, preparation, profile, quantiles, ranking
from ledgerlens.plans import features, jobs, models
from ledgerlens.schemas import REQUEST_SCHEMA, conform
from ledgerlens.sources import files
from ledgerlens.sources.sample_tables import order_ledger, sample_sources, sample_table
from ledgerlens.sources.tables import contents, load_sources, write_sources
from ledgerlens.streaming.requests import read_scored, run_idempotent_stream, run_request_stream, score_requests

AS_OF = "2024-02-01"
# small enough to cut the customers of the sample ledger into blocks
SMALL_BLOCKS = 10

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _compared(df: DataFrame, spec: str) -> DataFrame:
    """The columns to compare, in types every engine has: bigint, rounded double, text."""

    def form(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind == "num":
            return F.round(c.cast("double"), 6).alias(name)
        return c.cast("bigint" if kind == "long" else "string").alias(name)

    return df.select(*[form(n, k) for n, k in parse_spec(spec)])


def _query(f: Query) -> Query:
    _QUERIES[f.__name__.removeprefix("q_")] = f
    return f


def queries() -> dict[str, Query]:
    specs = specs_and_sql()

    def bind(name: str, f: Query) -> Query:
        if name not in specs:
            return f
        return lambda spark, sf_dir: _compared(f(spark, sf_dir), specs[name][0])

    return {name: bind(name, f) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in specs_and_sql().items()}


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    return sample_table(spark, d, "ledger")


def _joined(spark: SparkSession, d: str) -> DataFrame:
    src = sample_sources(spark, d)
    return joins.join_customer(ledger.ledger_loan_totals(src.ledger), src.payday, src.applicant_mapping)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return sample_table(spark, d, "scored")


def _training(spark: SparkSession, d: str) -> DataFrame:
    return features.training_features(sample_sources(spark, d))


def _production(spark: SparkSession, d: str) -> DataFrame:
    return features.production_features(sample_sources(spark, d), AS_OF)


def _valid(spark: SparkSession, d: str) -> DataFrame:
    cleaned = preparation.clean_text_features(_training(spark, d))
    return preparation.cast_features(preparation.valid_training_rows(cleaned))


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    # medians take passes of their own: build the features once
    return jobs.prepare_training(jobs.written(_training(spark, d), "features"))


def _scorecard(df: DataFrame) -> DataFrame:
    # the check's weights are those of the margin of no loss
    return models.score_linear(df, WEIGHTS, INTERCEPT)


# --- sources and sinks ---------------------------------------------------------------------------------------------


@_query
def q_load_sources(spark, d):
    """Write the lending tables, read them back against their schemas, and sum up what is in them."""
    path = files.work_folder(spark, "tables")
    write_sources(sample_sources(spark, d), path)
    return contents(load_sources(spark, path))


@_query
def q_csv_rejects(spark, d):
    """Customer texts through a file, read as numbers: what could not be read, by column."""
    path = files.work_folder(spark, "texts")
    columns = ["salary", "yearsonjob", "monthsatresidence", "bankaccountlengthmonths"]
    files.write_csv(sample_table(spark, d, "payday").select("id", *columns), path)
    schema = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in columns]])
    rows, rejects, counts = files.read_features_checked(spark, path, schema)
    kept = rows.agg(*[F.count(c).alias(c) for c in columns]).first()
    seen = spark.createDataFrame([(c, counts.get[c], kept[c]) for c in columns], "name string, observed long, kept long")
    listed = rejects.groupBy("name").agg(F.count("*").alias("listed"), F.countDistinct("row").alias("rejected_rows"))
    return seen.join(listed, "name", "left").fillna(0, ["listed", "rejected_rows"])


@_query
def q_features_csv(spark, d):
    """Training features through text files, then cleaned."""
    path = files.work_folder(spark, "features-csv")
    files.write_sorted_csv(_training(spark, d), path, "first_date_ever", "ssn")
    return preparation.clean_text_features(files.read_features_csv(spark, path))


# --- ledger --------------------------------------------------------------------------------------------------------


@_query
def q_classify_events(spark, d):
    return classify_events(_ledger(spark, d))


@_query
def q_ledger_loan_totals(spark, d):
    return ledger.ledger_loan_totals(_ledger(spark, d))


@_query
def q_ledger_loan_totals_split(spark, d):
    """The same with every larger customer cut into blocks."""
    return ledger.ledger_loan_totals(_ledger(spark, d), block_rows=SMALL_BLOCKS)


@_query
def q_segment_ids(spark, d):
    return ledger.segment_ids(_ledger(spark, d))


@_query
def q_segment_ids_split(spark, d):
    return ledger.segment_ids(_ledger(spark, d), block_rows=SMALL_BLOCKS)


@_query
def q_next_renewal(spark, d):
    return ledger.next_renewal(_ledger(spark, d))


@_query
def q_previous_loan(spark, d):
    return ledger.previous_loan(_ledger(spark, d))


@_query
def q_current_loan_totals(spark, d):
    return ledger.current_loan_totals(_ledger(spark, d))


@_query
def q_previous_loan_totals(spark, d):
    return ledger.previous_loan_totals(_ledger(spark, d))


@_query
def q_customer_totals(spark, d):
    return ledger.customer_totals(_ledger(spark, d))


@_query
def q_first_date_ever(spark, d):
    totals = ledger.customer_totals(_ledger(spark, d))
    return totals.select("ss", ledger.first_date_ever(totals).alias("first_date_ever"))


@_query
def q_order_ledger_totals(spark, d):
    """Loan totals over the longer ledger of orders and line items."""
    return (
        ledger.ledger_loan_totals(order_ledger(spark, d))
        .groupBy("ss", "loan_date", "net")
        .agg(
            F.count(F.lit(1)).alias("n_loans"),
            F.count("next_renewal_id").alias("next_renewals"),
            F.sum("previous_loan_amt").alias("previous_amt"),
            F.sum("current_amount_paid").alias("current_paid"),
            F.sum("previous_amount_paid").alias("previous_paid"),
            F.sum("total_amount_paid").alias("total_paid"),
            F.sum("total_total_loan_amt").alias("total_lent"),
        )
    )


# --- joins and lookups ---------------------------------------------------------------------------------------------


@_query
def q_base_loans(spark, d):
    loans = ledger.ledger_loan_totals(_ledger(spark, d))
    return joins.base_loans(loans, "training", ("2024-01-05", "2024-01-20"))


@_query
def q_base_customers(spark, d):
    return joins.base_customers(sample_table(spark, d, "payday"), "production", exclude_states=("Ohio",))


@_query
def q_join_customer(spark, d):
    return _joined(spark, d)


@_query
def q_latest_signed_application(spark, d):
    return lookups.latest_signed_application(_joined(spark, d), sample_table(spark, d, "renewal_log"))


@_query
def q_join_dimensions(spark, d):
    return joins.join_dimensions(_joined(spark, d), sample_sources(spark, d))


@_query
def q_join_affiliate(spark, d):
    src = sample_sources(spark, d)
    return joins.join_affiliate(joins.join_dimensions(_joined(spark, d), src), src.affiliate)


@_query
def q_affiliate_fields(spark, d):
    return joins.affiliate_fields(q_join_affiliate(spark, d))


@_query
def q_bureau_scores(spark, d):
    return lookups.bureau_scores(sample_table(spark, d, "bureau_response"))


@_query
def q_latest_restriction(spark, d):
    return lookups.latest_restriction(sample_table(spark, d, "customer_restriction"))


@_query
def q_latest_sms_preference(spark, d):
    return lookups.latest_sms_preference(sample_table(spark, d, "sms_preference"))


@_query
def q_attach_campaign(spark, d):
    gift = _scored(spark, d).select((F.col("applicant_id") + 500000).alias("applicant_id"), "funded_amount")
    return joins.attach_campaign(gift, _training(spark, d).filter(F.col("applicant_id").isNotNull()))


# --- feature rows --------------------------------------------------------------------------------------------------


@_query
def q_latest_loan(spark, d):
    loans = joins.base_loans(ledger.ledger_loan_totals(_ledger(spark, d)), "training")
    return features.latest_loan(loans, "previous_last_payment_date")


@_query
def q_first_last_values(spark, d):
    return features.first_last_values(joins.base_loans(ledger.ledger_loan_totals(_ledger(spark, d)), "training"))


@_query
def q_loan_counts(spark, d):
    return features.loan_counts(sample_sources(spark, d), "training")


@_query
def q_loan_state(spark, d):
    return joins.loan_state(_joined(spark, d), AS_OF)


@_query
def q_ptl(spark, d):
    return joins.ptl(ledger.ledger_loan_totals(_ledger(spark, d)))


@_query
def q_age(spark, d):
    day = F.lit(AS_OF).cast("date")
    return sample_table(spark, d, "payday").select(
        "id", cleaning.age("dob", day).alias("age"), cleaning.age("dob", day, fix_century=True).alias("age_fixed")
    )


@_query
def q_training_features(spark, d):
    return _training(spark, d)


@_query
def q_production_features(spark, d):
    return _production(spark, d)


@_query
def q_production_features_split(spark, d):
    return features.production_features(sample_sources(spark, d), AS_OF, block_rows=SMALL_BLOCKS)


# --- cleaning ------------------------------------------------------------------------------------------------------


@_query
def q_parse_years_on_job(spark, d):
    return sample_table(spark, d, "payday").select("id", cleaning.parse_years_on_job("yearsonjob").alias("years_text"))


@_query
def q_employment_default(spark, d):
    years = cleaning.employment_default(cleaning.parse_years_on_job("yearsonjob"))
    return sample_table(spark, d, "payday").select("id", years.alias("years_text"))


@_query
def q_clean_employment(spark, d):
    return sample_table(spark, d, "payday").select(
        "id",
        cleaning.clean_employment(cleaning.parse_years_on_job("yearsonjob")).alias("years_text"),
        cleaning.clean_employment("yearsonjob").alias("raw"),
    )


@_query
def q_clean_salary(spark, d):
    return sample_table(spark, d, "payday").select("id", cleaning.clean_salary("salary").alias("salary"))


@_query
def q_cast_failures(spark, d):
    return preparation.cast_failures(sample_table(spark, d, "payday"), ["salary", "yearsonjob", "monthsatresidence"])


@_query
def q_valid_training_rows(spark, d):
    return preparation.valid_training_rows(_training(spark, d))


@_query
def q_valid_scoring_rows(spark, d):
    return preparation.valid_scoring_rows(_production(spark, d))


@_query
def q_eligible(spark, d):
    return preparation.clean_text_features(preparation.eligible(_training(spark, d)))


@_query
def q_eligible_production(spark, d):
    return preparation.clean_text_features(preparation.eligible(_production(spark, d)))


@_query
def q_impute_fit(spark, d):
    return preparation.impute(jobs.written(_valid(spark, d), "valid"), "fit")


@_query
def q_impute_constant(spark, d):
    return preparation.impute(_valid(spark, d), "constant")


@_query
def q_add_ratios(spark, d):
    return preparation.add_ratios(q_impute_fit(spark, d), "training")


@_query
def q_label_loss(spark, d):
    return _prepared(spark, d)


@_query
def q_encode_pdtype(spark, d):
    return preparation.encode_pdtype(_valid(spark, d))


@_query
def q_select_features(spark, d):
    return preparation.select_features(_prepared(spark, d), evaluation=True)


# --- profiles ------------------------------------------------------------------------------------------------------


@_query
def q_null_rates(spark, d):
    return profile.null_rates(_training(spark, d))


@_query
def q_describe_exact(spark, d):
    return profile.describe_exact(_prepared(spark, d), PROFILE_COLUMNS)


@_query
def q_correlation_matrix(spark, d):
    return profile.correlation_matrix(_prepared(spark, d), PROFILE_COLUMNS)


# --- evaluation ----------------------------------------------------------------------------------------------------


@_query
def q_split(spark, d):
    train, test = preparation.split(_prepared(spark, d), "ssn")
    return train.select("ssn", F.lit("train").alias("part")).unionByName(
        test.select("ssn", F.lit("test").alias("part"))
    )


def _loss_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).withColumns({"loss_score": 1000 - F.col("score"), "constant": F.lit(0)})


@_query
def q_roc_auc(spark, d):
    return ranking.roc_auc(_loss_scores(spark, d), "loss_score", "if_loss")


@_query
def q_roc_auc_noskill(spark, d):
    return ranking.roc_auc(_loss_scores(spark, d), "constant", "if_loss")


@_query
def q_roc_curve(spark, d):
    return ranking.roc_curve(_loss_scores(spark, d), "loss_score", "if_loss")


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).withColumn("predicted", (F.col("score") < 500).cast("int"))


@_query
def q_confusion(spark, d):
    return ranking.confusion(_predicted(spark, d), "if_loss", "predicted")


@_query
def q_classification_metrics(spark, d):
    return ranking.classification_metrics(_predicted(spark, d), "if_loss", "predicted")


def _fitted(spark: SparkSession, d: str, fit, name: str) -> DataFrame:
    return jobs.train(sample_sources(spark, d), fit, name).metrics


@_query
def q_fit_boosted(spark, d):
    return _fitted(spark, d, models.fit_boosted, "boosted")


@_query
def q_fit_gbdt(spark, d):
    return _fitted(spark, d, models.fit_gbdt, "gbdt")


@_query
def q_fit_forest(spark, d):
    return _fitted(spark, d, models.fit_forest, "forest")


@_query
def q_fit_logistic(spark, d):
    return _fitted(spark, d, models.fit_logistic, "logistic")


@_query
def q_logit_summary(spark, d):
    return models.logit_summary(_prepared(spark, d))


def _equations(spark: SparkSession, d: str, fit) -> DataFrame:
    """What labels and fitted chances sum up to per input, by a model that was saved and loaded."""
    train, _, _ = jobs.prepare_sets(sample_sources(spark, d))
    path = files.work_folder(spark, "model")
    files.save_model(fit(train), path)
    return logistic.score_equations(train, models.load_model(path), models.LABEL)


@_query
def q_logistic_equations(spark, d):
    return _equations(spark, d, models.fit_logistic)


@_query
def q_logit_equations(spark, d):
    return _equations(spark, d, models.fit_logit)


@_query
def q_model_comparison(spark, d):
    """Models fitted on one prepared set; the comparison model of 3000 trees is `fit_gbdt`."""
    fits = {"boosted": models.fit_boosted, "forest": models.fit_forest, "logistic": models.fit_logistic, "logit": models.fit_logit}
    return jobs.compare(sample_sources(spark, d), fits)[1]


@_query
def q_scorecard_comparison(spark, d):
    """Several scorecards of given weights on one prepared set, judged in one pass."""
    train, test, _ = jobs.prepare_sets(sample_sources(spark, d))
    scored = None
    for name, (weights, intercept) in SCORECARDS.items():
        for part, rows in (("train", train), ("test", test)):
            one = models.score_linear(rows, weights, intercept).select(
                F.lit(name).alias("model"), F.lit(part).alias("part"), "if_loss", "prob_1", "predicted"
            )
            scored = one if scored is None else scored.unionByName(one)
    return ranking.metrics_by(jobs.written(scored, "scores"), ["model", "part"], "prob_1", "if_loss", "predicted")


@_query
def q_score_report(spark, d):
    """The test rows with what a scorecard says of them."""
    return jobs.score_report(_scorecard, jobs.prepare_sets(sample_sources(spark, d))[1])


@_query
def q_report_distributions(spark, d):
    """Loss, profit, static pool and customer type by score bin."""
    return jobs.report_distributions(jobs.written(jobs.score_report(_scorecard, _prepared(spark, d)), "report"), 4)


@_query
def q_feature_importance(spark, d):
    path = files.work_folder(spark, "model")
    jobs.train(sample_sources(spark, d), models.fit_boosted, "boosted", model_path=path)
    return models.feature_importance(jobs.load_trained(spark, path)[0])


# --- pricing and campaigns -----------------------------------------------------------------------------------------


@_query
def q_score_band(spark, d):
    return _scored(spark, d).withColumn("score_cat", score_band("score"))


@_query
def q_renewal_amount(spark, d):
    return _scored(spark, d).withColumn("renewal_loan_amt", renewal_amount())


@_query
def q_interest_rate(spark, d):
    return _scored(spark, d).withColumn("interest_rate", interest_rate())


@_query
def q_pricing_versions(spark, d):
    score = F.col("score")
    tiers = {
        f"{what}_v{n}": rules.tier(score, getattr(rules, field))
        for n, rules in ((1, PRICING_V1), (2, PRICING_V2))
        for what, field in (("rate", "rates"), ("increase", "increases"))
    }
    return _scored(spark, d).withColumns(tiers).groupBy(*tiers).agg(F.count(F.lit(1)).alias("customers"))


@_query
def q_priced_as_of(spark, d):
    """Scored customers priced by the rules that hold on a day of their own, out of a table of all versions."""
    rules = rule_rows(spark, {"v1": ("2024-01-05", PRICING_V1), "v2": ("2024-01-15", PRICING_V2), "applied": ("2024-02-01", PRICING_APPLIED)})
    days = _scored(spark, d).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("applicant_id") % 40).cast("int")))
    return price_as_of(days, rules, "day")


@_query
def q_campaign_list(spark, d):
    return campaign_list(_scored(spark, d))


@_query
def q_top_list(spark, d):
    top = campaign_list(_scored(spark, d), TOP_SCORE)
    return profile.describe_exact(top, ["score", "previous_loan_amt", "funded_amount"])


@_query
def q_campaign_response(spark, d):
    return campaign.campaign_response_by_bin(_scored(spark, d))


@_query
def q_amount_diff(spark, d):
    return campaign.amount_diff(_training(spark, d))


@_query
def q_score_distribution(spark, d):
    return quantiles.score_distribution(_scored(spark, d), "score", 10, "if_loss")


@_query
def q_band_volume(spark, d):
    return campaign.band_volume(offer(_scored(spark, d)))


@_query
def q_tier_counts(spark, d):
    return campaign.tier_counts(offer(_scored(spark, d)))


@_query
def q_campaign_impact(spark, d):
    baseline, *others = [campaign.Scenario(*s) for s in SCENARIOS]
    return campaign.campaign_impact(offer(_scored(spark, d)), baseline, others)


# --- jobs ----------------------------------------------------------------------------------------------------------


@_query
def q_score_linear(spark, d):
    return _scorecard(jobs.prepare_scoring(_production(spark, d)))


@_query
def q_batch_score_offer(spark, d):
    return jobs.batch_score_offer(sample_sources(spark, d), AS_OF, _scorecard)


@_query
def q_campaign_scores(spark, d):
    """A campaign's customers with their history: medians of the batch, rows without a history stay unscored."""
    return jobs.score_and_price(jobs.written(_training(spark, d), "features"), _scorecard, mode="batch")


def _requests(spark: SparkSession, d: str) -> str:
    """Production features as request records in JSON files; returns their folder."""
    raw = _production(spark, d)
    prepared = jobs.prepare_scoring(raw).drop("salary", "employment_length", "bank_account_length_months",
                                              "months_at_residence")
    text = raw.select("payday_id", "salary", "employment_length", "bank_account_length_months", "months_at_residence")
    records = prepared.join(text, "payday_id").withColumnRenamed("payday_id", "request_id")
    path = files.work_folder(spark, "requests")
    files.write_requests(conform(records, REQUEST_SCHEMA, "requests").repartition(3, "request_id"), path)
    return path


@_query
def q_request_scores(spark, d):
    """Requests scored as one batch."""
    return score_requests(files.read_requests(spark, _requests(spark, d)), _scorecard)


@_query
def q_stream_score(spark, d):
    """The same requests scored as a stream, one file at a time."""
    out, checkpoint = files.work_folder(spark, "scored"), files.work_folder(spark, "stream")
    run_request_stream(spark, _requests(spark, d), out, checkpoint, _scorecard, 1).awaitTermination()
    return spark.read.parquet(out)


@_query
def q_stream_replayed(spark, d):
    """The requests as a stream that sends every file again under another name: each is scored once."""
    folder, again = _requests(spark, d), files.work_folder(spark, "again")
    out, checkpoint = files.work_folder(spark, "scored"), files.work_folder(spark, "stream")
    run_idempotent_stream(spark, folder, out, checkpoint, _scorecard, 1).awaitTermination()
    files.write_requests(files.read_requests(spark, folder).repartition(2, "salary"), again)
    run_idempotent_stream(spark, again, out, files.work_folder(spark, "stream"), _scorecard, 1).awaitTermination()
    return read_scored(spark, out)
