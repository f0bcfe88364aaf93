from pyspark.sql import functions as F

from ledgerlens.operators import blocks, ledger
from ledgerlens.operators.ledger import ledger_loan_totals
from ledgerlens.operators.profile import correlation_matrix
from ledgerlens.schemas import SOURCE_SCHEMAS
from ledgerlens.sources import files
from ledgerlens.sources.sample_tables import sample_sources
from ledgerlens.sources.tables import BUCKETS, contents, load_catalog, write_catalog
from ledgerlens.streaming.requests import read_scored, run_idempotent_stream, write_scored
from tests.test_jobs import request_frame, scorecard
from tests.test_ledger import found, frame, plan_text, random_ledger

SMALL = "/root/testdata/sf0.001"


def test_bucketed_tables_hold_the_same_and_spare_the_shuffle(spark, tmp_path):
    spark.sql(f"create database if not exists lending location '{tmp_path}'")
    src = sample_sources(spark, SMALL)
    write_catalog(src, "lending", 3)
    again = load_catalog(spark, "lending")
    assert sorted(map(str, contents(again).collect())) == sorted(map(str, contents(src).collect()))
    assert {c for _, order in BUCKETS.values() for c in order} <= {f.name for s in SOURCE_SCHEMAS.values() for f in s}
    rows = ledger_loan_totals(again.ledger)
    assert found(rows) == found(ledger_loan_totals(src.ledger))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # ordinary customers are windowed and summed up bucket by bucket
        ordinary = blocks.split(again.ledger)[0]
        plan = plan_text(ledger._in_block(ledger._segments(ordinary, ["ss"]), ["ss"]))
        assert "Bucketed: true" in plan and "Window" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("drop database lending cascade")


def test_rejects_are_counted_and_listed(spark):
    rows = [("x", "1", "2.5"), ("y", "one", "3"), ("", "2", "3,5"), ("NULL", None, ""), ("z", "3", "x")]
    path = files.work_folder(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), path)
    schema = spark.createDataFrame([], "a string, b int, c double").schema
    kept, rejects, counts = files.read_features_checked(spark, path, schema)
    assert counts.get == {"a": 0, "b": 1, "c": 2}
    assert {(r.name, r.value) for r in rejects.collect()} == {("b", "one"), ("c", "3,5"), ("c", "x")}
    assert kept.columns == ["a", "b", "c"]
    plain = files.read_features_csv(spark, path, schema)
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))
    nothing = files.work_folder(spark, "csv")
    files.write_csv(spark.createDataFrame([("x", "1", "2.5")], "a string, b string, c string"), nothing)
    assert files.read_features_checked(spark, nothing, schema)[1].count() == 0


def test_requests_that_come_again_are_scored_once(spark):
    folder, out, checkpoint = (files.work_folder(spark, n) for n in ("requests", "scored", "stream"))
    assert read_scored(spark, out).count() == 0
    requests = request_frame(spark)
    files.write_requests(requests.repartition(3, "request_id").unionByName(requests.where("request_id < 5")), folder)
    run_idempotent_stream(spark, folder, out, checkpoint, scorecard, 2).awaitTermination()
    first = read_scored(spark, out).orderBy("request_id").collect()
    assert [r.request_id for r in first] == list(range(150))
    # the same files once more, as another stream; then a batch that fails after it has written and runs again
    run_idempotent_stream(spark, folder, out, files.work_folder(spark, "stream"), scorecard, 2).awaitTermination()
    assert read_scored(spark, out).orderBy("request_id").collect() == first
    more = requests.withColumn("request_id", F.col("request_id") + 100)
    for _ in range(2):
        write_scored(more, "late-0", out, scorecard)
        assert [r.request_id for r in read_scored(spark, out).orderBy("request_id").collect()] == list(range(250))


def test_correlations_of_large_and_missing_values(spark):
    rows = [(1e9 + i, float(i % 7) if i % 3 else None, 5.0, -2.0 * i) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.a, r.b): r.r for r in correlation_matrix(df).collect()}
    assert len(got) == 10 and abs(got["a", "d"] + 1) < 1e-12 and got["a", "c"] is None and abs(got["b", "b"] - 1) < 1e-12
    there = [(r[0], r[1]) for r in rows if r[1] is not None]
    mean = [sum(x) / len(there) for x in zip(*there)]
    dot = [sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in there) for i, j in ((0, 1), (0, 0), (1, 1))]
    assert abs(got["a", "b"] - dot[0] / (dot[1] * dot[2]) ** 0.5) < 1e-9
    plan = plan_text(correlation_matrix(df))
    assert plan.count("MapInArrow") == 1 and "corr(" not in plan
    assert frame(spark, random_ledger(1)).count() == 400
