"""Left joins whose left keys are mostly missing, or of few values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread_join(df: DataFrame, other: DataFrame, left: str, right: str, by: list[str], salts: int = 1) -> DataFrame:
    """`df` left join `other` on its column `left` = their column `right`; the columns of both, names all different.

    A row whose key is missing has no match; it is dealt out by a hash of its columns `by` in place of the key, so that
    missing keys do not meet in one task. With `salts`, every row of `other` is there that many times, and rows of `df`
    that share a key are dealt out over as many places: for an `other` that is small beside `df`, such as lists of codes
    and names. The join stays an equality on one expression for each side.
    """
    row = F.xxhash64(*by)
    text = isinstance(df.schema[left].dataType, T.StringType)
    key = F.coalesce(F.col(left), row.cast("string") if text else row)
    salted = salts > 1
    spread = df.withColumn("__left", key).withColumn("__salt", F.pmod(row, F.lit(salts)).cast("int") if salted else F.lit(0))
    known = other.where(F.col(right).isNotNull()).withColumn("__right", F.col(right))
    if salted:
        known = known.withColumn("__place", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    meets = (F.col("__left") == F.col("__right")) & F.col(left).isNotNull()
    if salted:
        meets &= F.col("__salt") == F.col("__place")
    return spread.join(known, meets, "left").drop("__left", "__salt", "__right", "__place")
