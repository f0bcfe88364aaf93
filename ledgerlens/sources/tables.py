"""The thirteen lending tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import SOURCE_SCHEMAS, conform


@dataclass
class Sources:
    ledger: DataFrame
    payday: DataFrame
    applicant_mapping: DataFrame
    applicant: DataFrame
    renewal_log: DataFrame
    renewal_lead: DataFrame
    application_type: DataFrame
    sub_codes: DataFrame
    buy_apps_log: DataFrame
    affiliate: DataFrame
    bureau_response: DataFrame
    customer_restriction: DataFrame
    sms_preference: DataFrame

    @classmethod
    def of(cls, read) -> Sources:
        """Build from `read(name) -> DataFrame`; every table is checked against its declared columns."""
        return cls(**{f.name: conform(read(f.name), SOURCE_SCHEMAS[f.name], f.name) for f in fields(cls)})


def load_sources(spark: SparkSession, path: str, fmt: str = "parquet") -> Sources:
    """Read `<path>/<table>` for each table. Fails on a missing column."""
    return Sources.of(lambda name: spark.read.format(fmt).load(f"{path}/{name}"))


def load_catalog(spark: SparkSession, database: str) -> Sources:
    """The same from catalog tables `<database>.<table>`, for example ones bucketed by customer."""
    return Sources.of(lambda name: spark.table(f"{database}.{name}"))


#: key that each table is bucketed by, and what its buckets are sorted by; tables that are not listed are small codes
BUCKETS = {
    "ledger": ("ss", ["ss", "id"]),
    "payday": ("social", ["social"]),
    "applicant_mapping": ("paydayid", ["paydayid"]),
    "applicant": ("id", ["id"]),
    "renewal_log": ("custid", ["custid", "id"]),
    "buy_apps_log": ("applicantid", ["applicantid"]),
    "bureau_response": ("applicantid", ["applicantid"]),
    "customer_restriction": ("id", ["id"]),
    "sms_preference": ("applicantmappingid", ["applicantmappingid"]),
}


def write_catalog(src: Sources, database: str, buckets: int) -> None:
    """Catalog tables `<database>.<table>`, large ones bucketed by customer or person and sorted: whoever windows or
    groups the ledger by customer, or joins two tables of as many buckets, shuffles neither."""
    for f in fields(src):
        rows = getattr(src, f.name)
        if f.name in BUCKETS:
            key, order = BUCKETS[f.name]
            # one file a bucket: rows go to their bucket's task before they are written
            rows.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(*order).saveAsTable(f"{database}.{f.name}")
        else:
            rows.write.mode("overwrite").saveAsTable(f"{database}.{f.name}")


def _size(name: str, kind: T.DataType) -> Column:
    """A number that depends on a value: itself, a text's length, a date's day."""
    c = F.col(name)
    if isinstance(kind, T.StringType):
        return F.length(c).cast("decimal(38,4)")
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("decimal(38,4)")
    return c.cast("decimal(38,4)")


def contents(src: Sources) -> DataFrame:
    """(table, column, rows, present, total): what is in the tables, by column, one aggregation a table."""
    out = None
    for f in fields(src):
        rows = getattr(src, f.name)
        entries = [
            F.struct(F.lit(f.name).alias("table"), F.lit(c.name).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(c.name).alias("present"),
                     F.sum(_size(c.name, c.dataType)).cast("double").alias("total"))
            for c in rows.schema
        ]
        one = rows.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")
        out = one if out is None else out.unionByName(one)
    return out


def write_sources(src: Sources, path: str) -> None:
    for f in fields(src):
        getattr(src, f.name).write.mode("overwrite").parquet(f"{path}/{f.name}")
