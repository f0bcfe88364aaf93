"""Scoring requests as they arrive: the batch transforms on a stream of JSON files."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.preparation import cast_features, clean_text_features, impute
from ledgerlens.plans.jobs import Scorer
from ledgerlens.schemas import REQUEST_SCHEMA
from ledgerlens.sources.files import folder_names


def read_request_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def score_requests(requests: DataFrame, scorer: Scorer) -> DataFrame:
    """request_id, prob_0, prob_1, score. Row by row, without state, so it works alike on a batch and a stream.

    Missing months become fixed values: a median over a stream has no meaning.
    """
    inputs = impute(cast_features(clean_text_features(requests)), "constant")
    return scorer(inputs).select("request_id", "prob_0", "prob_1", "score")


def run_request_stream(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    scorer: Scorer,
    files_per_trigger: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Score what arrives in `path` into parquet files under `out`, each request exactly once.

    `once` works off what is there and stops; otherwise the query keeps running.
    """
    scored = score_requests(read_request_stream(spark, path, files_per_trigger), scorer)
    writer = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


SCORED = "request_id long, prob_0 double, prob_1 double, score double"


def read_scored(spark: SparkSession, out: str) -> DataFrame:
    """What `run_idempotent_stream` has written; nothing yet: no rows."""
    batches = [f"{out}/{name}" for name in folder_names(spark, out) if name.startswith("batch-")]
    return spark.read.schema(SCORED).parquet(*batches) if batches else spark.createDataFrame([], SCORED)


def write_scored(batch: DataFrame, name: str, out: str, scorer: Scorer) -> None:
    """Score a batch into the folder `batch-<name>`: requests that other batches hold are left out, of equal ids one stays.

    A batch that runs again, after a failure, writes its folder anew, so no request is there twice.
    """
    spark = batch.sparkSession
    folder = f"{out}/batch-{name}"
    others = [f"{out}/{n}" for n in folder_names(spark, out) if n.startswith("batch-") and n != f"batch-{name}"]
    # of requests that share an id, the first in the order of all their values
    first = batch.where(F.col("request_id").isNotNull()).groupBy("request_id").agg(F.min(F.struct(*[c for c in batch.columns if c != "request_id"])).alias("r"))
    new = first.select("request_id", "r.*")
    if others:
        new = new.join(spark.read.schema(SCORED).parquet(*others).select("request_id"), "request_id", "left_anti")
    score_requests(new, scorer).write.mode("overwrite").parquet(folder)


def run_idempotent_stream(
    spark: SparkSession, path: str, out: str, checkpoint: str, scorer: Scorer, files_per_trigger: int | None = None, once: bool = True
) -> StreamingQuery:
    """Like `run_request_stream`, for sources that may send a request again, in whatever file: it is scored once.

    Batches are named by the checkpoint and their number in it; streams with checkpoints of their own may share `out`, one
    after the other.
    """
    requests = read_request_stream(spark, path, files_per_trigger)
    stream = f"{crc32(checkpoint.encode()):08x}"
    writer = requests.writeStream.foreachBatch(lambda batch, n: write_scored(batch, f"{stream}-{n}", out, scorer))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
