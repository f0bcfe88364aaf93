"""From raw documents to packed training sequences, in five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import protected, table, written
from ledgerlens.llm.language import UNKNOWN, identify, train
from ledgerlens.llm.mixing import mix
from ledgerlens.llm.near_duplicates import near_duplicates
from ledgerlens.llm.packing import encode, place
from ledgerlens.llm.secrets import redact


#: least score at which the model's language counts more than the given one
SURE = 0.6


def keeping_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, on documents whose other columns may have any names."""

    @wraps(stage)
    def guarded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows, named = protected(docs, "doc_id", "text", "lang", "source", "n_chars")
        return named(stage(spark, rows, sf_dir))

    return guarded


@keeping_columns
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in the language that the model is sure of, else in the given one, or if there is none in
    the predicted one. Null texts and texts without letters go. Without a labelled document, lang stays as it is.

    Repeated rows stay for the next stage. No documents: no rows.
    """
    model = train(docs)
    if not model["families"][0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, model).where(F.col("lang_pred") != UNKNOWN)
    lang = F.when(F.col("score") >= SURE, F.col("lang_pred")).otherwise(F.coalesce("lang", "lang_pred"))
    return found.withColumn("lang", lang).select(*docs.columns)


@keeping_columns
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id. Documents without doc_id all stay.

    Different texts under one doc_id are documents of their own; of equal ones the first by the other columns stays.
    """
    counts = docs.where("doc_id is not null").groupBy("doc_id").count()
    repeated = written(counts.where("count > 1").select(F.col("doc_id").alias("again")), "repeated")
    if repeated.isEmpty():
        others = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone"))
        return docs.join(others, docs["doc_id"] == others["gone"], "left_anti")
    # rows that repeat a doc_id are few: only these meet, and take a number of their own
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    again = docs.join(repeated, docs["doc_id"] == repeated["again"], "left_semi").groupBy("doc_id", "text")
    least = again.agg(F.min(F.struct(*rest)).alias("first")) if rest else again.agg(F.lit(1))
    least = least.select(*[F.col(f"first.`{c}`") if c in rest else F.col(c) for c in docs.columns])
    single = docs.join(repeated, docs["doc_id"] == repeated["again"], "left_anti").withColumn("__row", F.col("doc_id"))
    rows = written(single.union(least.withColumn("__row", F.xxhash64(F.lit("row"), "doc_id", "text"))), "rows")
    named = rows.where("__row is not null").select(F.col("__row").alias("row"), F.col("doc_id").alias("named"))
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text")).where("doc_id is not null")
    groups = written(found.select(F.col("doc_id").alias("row"), "component_id").join(named, "row"), "groups")
    first = groups.groupBy("component_id").agg(F.min(F.struct("named", "row")).alias("f")).select(F.col("f.row").alias("row"))
    gone = groups.join(first, "row", "left_anti").select(F.col("row").alias("gone"))
    return rows.join(gone, rows["__row"] == gone["gone"], "left_anti").select(*docs.columns)


@keeping_columns
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return redact(docs)


@keeping_columns
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources draws it, shard by shard."""
    return mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their place in sequences of 2048."""
    pieces = encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return place(written(pieces, "pieces"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

# a fitted model, MinHash signatures and token ids are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
