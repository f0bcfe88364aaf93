"""The place of a value among sorted cuts that a row carries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# cuts that are looked through in one go
STEP = 256


def with_place(df: DataFrame, value: str, cuts: str, name: str) -> DataFrame:
    """Add how many of the sorted array `cuts` are `value` or less. Two steps, as there may be very many cuts."""
    coarse = F.sequence(F.lit(0), F.size(cuts) - 1, F.lit(STEP))
    passed = F.size(F.filter(coarse, lambda i: F.get(cuts, i) <= F.col(value)))
    start = (F.col("__passed") - 1) * STEP
    within = F.size(F.filter(F.slice(cuts, start + 1, F.lit(STEP)), lambda c: c <= F.col(value)))
    found = df.withColumn("__passed", F.when(F.size(cuts) > 0, passed).otherwise(0))
    return found.withColumn(name, F.when(F.col("__passed") == 0, 0).otherwise(start + within)).drop("__passed")
