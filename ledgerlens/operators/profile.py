"""Column profiles: null rates, summary statistics, correlations."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.quantiles import exact_quantiles

# functions that tasks run travel with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def categorical_numerical(df: DataFrame) -> tuple[list[str], list[str]]:
    """Text columns, and all others."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return text, [c for c in df.columns if c not in text]


def _one_row_to_long(row: DataFrame, columns: list[str], fields: list[str]) -> DataFrame:
    """Columns `<field>__<i>` of a one-row frame to one row per column name."""
    entries = [
        F.struct(F.lit(c).alias("name"), *[F.col(f"{f}__{i}").alias(f) for f in fields])
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def null_rates(df: DataFrame) -> DataFrame:
    """(name, null_rate)"""
    row = df.agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"null_rate__{i}") for i, c in enumerate(df.columns)]
    )
    return _one_row_to_long(row, df.columns, ["null_rate"])


def describe_exact(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column."""
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    row = df.agg(
        *[
            e
            for i, c in enumerate(columns)
            for e in (
                F.count(c).alias(f"count__{i}"),
                F.avg(F.col(c).cast("double")).alias(f"mean__{i}"),
                F.stddev_samp(F.col(c).cast("double")).alias(f"std__{i}"),
                F.min(F.col(c).cast("double")).alias(f"min__{i}"),
                F.lit(quartiles[c][0]).cast("double").alias(f"q25__{i}"),
                F.lit(quartiles[c][1]).cast("double").alias(f"q50__{i}"),
                F.lit(quartiles[c][2]).cast("double").alias(f"q75__{i}"),
                F.max(F.col(c).cast("double")).alias(f"max__{i}"),
            )
        ]
    )
    return _one_row_to_long(row, columns, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"])


PAIR_SUMS = "i int, j int, n long, si double, sj double, sii double, sjj double, sij double"


def pair_sums(df: DataFrame, columns: list[str], centres: dict[str, float]) -> DataFrame:
    """(i, j, n, si, sj, sii, sjj, sij) for each pair of columns, i <= j: how many rows have both values, and their sums,
    squares and products, each value less its column's centre.

    Every task multiplies its rows as a matrix with itself, batch by batch, and gives a row for each pair; one group-by
    adds these up. Rows that lack a value count for the pairs of the others.
    """
    centre = np.array([centres[c] for c in columns])
    i, j = np.triu_indices(len(columns))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(i)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1) - centre
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            n, s, q, xy = m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x
            total += np.stack([n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], xy[i, j]])
        counts = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[0].astype(np.int64))]
        yield pa.RecordBatch.from_arrays([*counts, *map(pa.array, total[1:])], ["i", "j", "n", "si", "sj", "sii", "sjj", "sij"])

    rows = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]).mapInArrow(partial, PAIR_SUMS)
    return rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")])


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(a, b, r) for each pair of numeric columns, a row counting for a pair if both values are there.

    r is null where a column of the pair does not vary. Means come first, in one pass, and values are taken from them
    before they are multiplied, so large values lose no digits.
    """
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    number = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    seen = df.agg(*[F.struct(F.avg(v).alias("mean"), (F.max(v) > F.min(v)).alias("varies")).alias(f"c{k}") for k, v in enumerate(number.values())]).first()
    sums = pair_sums(df, columns, {c: seen[f"c{k}"]["mean"] or 0.0 for k, c in enumerate(columns)})
    names = df.sparkSession.createDataFrame(
        [(i, j, columns[i], columns[j], bool(seen[f"c{i}"]["varies"] and seen[f"c{j}"]["varies"])) for i, j in combinations_with_replacement(range(len(columns)), 2)],
        "i int, j int, a string, b string, varies boolean",
    )
    n = F.col("n").cast("double")
    across = n * F.col("sij") - F.col("si") * F.col("sj")
    spread = F.sqrt(n * F.col("sii") - F.col("si") * F.col("si")) * F.sqrt(n * F.col("sjj") - F.col("sj") * F.col("sj"))
    r = F.when(F.col("varies") & (F.col("n") > 1), F.try_divide(across, spread))
    return F.broadcast(names).join(sums, ["i", "j"], "left").select("a", "b", r.alias("r"))
