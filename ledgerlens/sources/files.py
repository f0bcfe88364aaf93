"""Feature files, request files, result files, fitted models, and the folder for work in progress."""

from __future__ import annotations

from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import FEATURE_CSV_SCHEMA, REQUEST_SCHEMA, conform

NULL_TEXT = "NULL"


def work_folder(spark: SparkSession, name: str) -> str:
    """A folder name, not used yet, under `spark.checkpoint.dir`, which every executor can reach; what is written there
    is removed when the application ends.

    Where that is unset, the warehouse, shared as well, holds it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    folder = f"{root.rstrip('/')}/{name}-{uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{folder}/out"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a work folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the complete outputs in a folder; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    found = [status.getPath() for status in system.listStatus(path)]
    done = [p for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return [p.getName() for p in done]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A text in a folder, whole or not at all."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").parquet(path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(path).first()["value"]


def read_features_csv(spark: SparkSession, path: str, schema: T.StructType = FEATURE_CSV_SCHEMA) -> DataFrame:
    """A feature file with header; empty fields and NULL are null. Fails if the header lacks a column."""
    header = spark.read.option("header", True).csv(path)
    conform(header, T.StructType([T.StructField(f.name, T.StringType()) for f in schema]), path)
    text = spark.read.option("header", True).option("nullValue", NULL_TEXT).csv(path)
    return text.select(
        *[
            F.when(F.col(f.name) != "", F.col(f.name)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def read_features_checked(
    spark: SparkSession, path: str, schema: T.StructType = FEATURE_CSV_SCHEMA
) -> tuple[DataFrame, DataFrame, Observation]:
    """Rows of a feature file, the values that could not be read, and how many there are by column.

    The file is read and cast once, when the rows are written under the work folder: the counts are observed on the way,
    and the rejects, (row, name, value), are kept beside their rows.
    """
    header = spark.read.option("header", True).csv(path)
    conform(header, T.StructType([T.StructField(f.name, T.StringType()) for f in schema]), path)
    text = spark.read.option("header", True).option("nullValue", NULL_TEXT).csv(path)
    given = {f.name: F.when(F.col(f.name) != "", F.col(f.name)) for f in schema}
    bad = {f.name: given[f.name].isNotNull() & given[f.name].try_cast(f.dataType).isNull() for f in schema}
    marked = text.select(
        F.monotonically_increasing_id().alias("__row"),
        *[given[f.name].try_cast(f.dataType).alias(f.name) for f in schema],
        F.array_compact(F.array(*[F.when(b, F.struct(F.lit(n).alias("name"), given[n].alias("value"))) for n, b in bad.items()])).alias("__bad"),
    )
    counts = Observation()
    observed = marked.observe(counts, *[F.count_if(F.array_contains(F.transform("__bad", lambda b: b["name"]), n)).alias(n) for n in bad])
    folder = work_folder(spark, "checked")
    observed.write.parquet(folder)
    kept = spark.read.parquet(folder)
    rejects = kept.where(F.size("__bad") > 0).select(F.col("__row").alias("row"), F.explode("__bad").alias("b")).select("row", "b.*")
    return kept.drop("__row", "__bad"), rejects, counts


def write_csv(df: DataFrame, path: str) -> None:
    """Text files with header, one per partition; nulls as NULL."""
    df.write.mode("overwrite").option("header", True).option("nullValue", NULL_TEXT).option("emptyValue", "").csv(path)


def write_sorted_csv(df: DataFrame, path: str, *order: str) -> None:
    """The same in a total order over all files, in file name order."""
    write_csv(df.orderBy(*order), path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests, one JSON record per line."""
    return spark.read.schema(REQUEST_SCHEMA).json(path)


def parse_requests(df: DataFrame, column: str = "value") -> DataFrame:
    """Scoring requests out of a text column that holds a JSON array of records, as a message body does."""
    records = F.from_json(column, T.ArrayType(REQUEST_SCHEMA))
    return df.select(F.explode(records).alias("r")).select("r.*")


def write_requests(df: DataFrame, path: str) -> None:
    conform(df, REQUEST_SCHEMA, "requests").write.mode("overwrite").json(path)


def save_model(model, path: str) -> None:
    """A model of `pyspark.ml`, or of another kind that has a text form (`to_json`); what is there before goes."""
    remove_folder(SparkSession.active(), path)
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(f"{path}/pipeline")
    else:
        write_text(SparkSession.active(), f"{path}/{type(model).__name__}", model.to_json())


def load_model(path: str, *kinds: type):
    """What `save_model` wrote: a pipeline, or a model of one of these kinds."""
    names = folder_names(SparkSession.active(), path)
    for kind in kinds:
        if kind.__name__ in names:
            return kind.from_json(read_text(SparkSession.active(), f"{path}/{kind.__name__}"))
    return PipelineModel.load(f"{path}/pipeline")
