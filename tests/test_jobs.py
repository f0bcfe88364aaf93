import json

import pytest

from checks.oracle import INTERCEPT, WEIGHTS
from ledgerlens.plans import jobs, models
from ledgerlens.schemas import REQUEST_SCHEMA, SOURCE_SCHEMAS, TRAIN_VARS, conform
from ledgerlens.sources import files
from ledgerlens.sources.sample_tables import sample_sources
from ledgerlens.streaming.requests import run_request_stream, score_requests

SMALL = "/root/testdata/sf0.01"


def scorecard(df):
    return models.score_linear(df, WEIGHTS, INTERCEPT)


@pytest.fixture(scope="module")
def prepared(spark):
    return jobs.written(jobs.prepare_training(jobs.training_features(sample_sources(spark, SMALL))), "prepared")


def test_train_saves_and_loads(spark, prepared):
    model = models.fit_boosted(prepared, trees=5)
    path = files.work_folder(spark, "model")
    files.save_model(model, path)
    before = models.score(model, prepared).orderBy("ssn").select("ssn", "score").collect()
    again = models.score(models.load_model(path), prepared).orderBy("ssn").select("ssn", "score").collect()
    assert before == again and all(0 <= r.score <= 1000 for r in before)
    importance = models.feature_importance(model).collect()
    assert {r.feature for r in importance} == set(TRAIN_VARS)
    assert [r.importance for r in importance] == sorted((r.importance for r in importance), reverse=True)
    assert abs(sum(r.importance for r in importance) - 1) < 1e-9
    metrics = jobs.evaluate({"boosted": model}, prepared, prepared).collect()
    assert {r.part for r in metrics} == {"train", "test"} and all(r.auc > 0.7 for r in metrics)


def test_score_keeps_input_columns(spark, prepared):
    model = models.fit_logistic(prepared)
    scored = models.score(model, prepared)
    assert scored.columns == prepared.columns + ["prob_0", "prob_1", "predicted", "score"]
    row = scored.first()
    assert abs(row.prob_0 + row.prob_1 - 1) < 1e-9 and abs(row.score - 1000 * row.prob_0) < 1e-9
    assert row.predicted == int(row.prob_1 > 0.5)


def test_logit_summary_lists_every_input(prepared):
    rows = models.logit_summary(prepared).collect()
    assert [r.feature for r in rows] == TRAIN_VARS and all(r.p_value is None or 0 <= r.p_value <= 1 for r in rows)


def test_medians_are_kept_with_the_model(spark):
    path = files.work_folder(spark, "model")
    src = sample_sources(spark, SMALL)
    trained = jobs.train(src, models.fit_logistic, "logistic", path)
    model, medians = jobs.load_trained(spark, path)
    assert medians == trained.medians and model == trained.model and set(medians) == {"salary", "bank_account_length_months", "months_at_residence"}
    batch = jobs.batch_score_offer(src, "2024-02-01", jobs.with_model(model), mode="batch", values=medians)
    assert batch.count() == batch.filter("salary is not null").count() > 0


def test_models_are_compared_on_one_set(spark):
    fits = {"forest": lambda df: models.fit_forest(df, trees=5), "logistic": models.fit_logistic, "boosted": lambda df: models.fit_boosted(df, trees=5)}
    fitted, metrics = jobs.compare(sample_sources(spark, SMALL), fits)
    rows = metrics.collect()
    assert {(r.model, r.part) for r in rows} == {(m, p) for m in fits for p in ("train", "test")} and set(fitted) == set(fits)
    assert len({(r.part, r.n) for r in rows}) == 2


def test_all_fits_of_the_comparison_take_few_jobs(spark):
    """300 levels of boosted trees and 30 of a forest were jobs of their own."""
    rows = [(*[float((i * k) % 37) for k in range(1, len(TRAIN_VARS) + 1)], int(i * 5 % 37 > 18)) for i in range(1, 61)]
    df = spark.createDataFrame(rows, [*TRAIN_VARS, "if_loss"])
    try:
        for fit in (models.fit_boosted, models.fit_forest):
            spark.sparkContext.setJobGroup(fit.__name__, fit.__name__)
            assert len(fit(df).trees) == 100
            assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(fit.__name__)) < 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


REQUESTS = [
    {"request_id": i, "salary": "$1500", "employment_length": ["2", "N/A", None, "o"][i % 4],
     "bank_account_length_months": None if i % 5 == 0 else str(i), "months_at_residence": None if i % 3 == 0 else "24",
     **{c: float(i % 7) for c in TRAIN_VARS if c not in ("employment_length", "bank_account_length_months",
                                                          "months_at_residence")}}
    for i in range(150)
]


def request_frame(spark):
    return spark.createDataFrame([tuple(r[f.name] for f in REQUEST_SCHEMA) for r in REQUESTS], REQUEST_SCHEMA)


def test_stream_equals_batch(spark):
    folder, out, checkpoint = (files.work_folder(spark, n) for n in ("requests", "scored", "stream"))
    files.write_requests(request_frame(spark).repartition(3, "request_id"), folder)
    batch = score_requests(files.read_requests(spark, folder), scorecard).orderBy("request_id").collect()
    run_request_stream(spark, folder, out, checkpoint, scorecard, files_per_trigger=1).awaitTermination()
    assert spark.read.parquet(out).orderBy("request_id").collect() == batch and len(batch) == 150
    # nothing new has come: a second run adds nothing
    run_request_stream(spark, folder, out, checkpoint, scorecard).awaitTermination()
    assert spark.read.parquet(out).count() == 150


def test_message_body_of_many_records(spark):
    body = spark.createDataFrame([(json.dumps(REQUESTS[:10]),), (json.dumps(REQUESTS[10:]),)], "value string")
    got = score_requests(files.parse_requests(body), scorecard).orderBy("request_id").collect()
    assert got == score_requests(request_frame(spark), scorecard).orderBy("request_id").collect()


def test_missing_months_are_constants(spark):
    one = request_frame(spark).filter("request_id = 0")
    given = one.fillna({"bank_account_length_months": "30", "months_at_residence": "36"})
    assert score_requests(one, scorecard).first() == score_requests(given, scorecard).first()


def test_csv_round_trip(spark, prepared):
    df = spark.createDataFrame([("x", 1, None), (None, 2, 2.5), ("", 3, 0.0)], "a string, b int, c double")
    path = files.work_folder(spark, "csv")
    files.write_sorted_csv(df, path, "b")
    got = files.read_features_csv(spark, path, df.schema).orderBy("b").collect()
    assert [tuple(r) for r in got] == [("x", 1, None), (None, 2, 2.5), (None, 3, 0.0)]


def test_missing_columns_fail(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="email"):
        conform(df, SOURCE_SCHEMAS["applicant"], "applicant")
    path = files.work_folder(spark, "csv")
    files.write_csv(df, path)
    with pytest.raises(ValueError, match="ssn"):
        files.read_features_csv(spark, path)


def test_work_folder_is_the_shared_one(spark):
    assert files.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_batch_mode_keeps_rows_it_cannot_score(spark):
    features = jobs.written(jobs.training_features(sample_sources(spark, SMALL)), "features")
    rows = jobs.score_and_price(features, scorecard, mode="batch").collect()
    assert len(rows) == features.count()
    unscored = [r for r in rows if r.score is None]
    assert 0 < len(unscored) < len(rows)
    assert all(r.score_cat is None and r.renewal_loan_amt is None and r.interest_rate is None for r in unscored)
    assert all((r.pay_previous is None or not r.previous_loan_amt or r.years_with_us < 0) for r in unscored)
    assert all(r.salary is not None and r.months_at_residence is not None for r in rows)
    constant = jobs.score_and_price(features, scorecard).collect()
    assert all(r.score is not None for r in constant)
