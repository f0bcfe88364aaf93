"""What the operators share: picking columns, tables written between steps, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.files import work_folder

#: words are runs of anything but space and the control characters 9 to 13
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns alone, by their exact names; whatever else the table has, differing in case only even, is left out."""
    numbered = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"__{df.columns.index(n)}").alias(n) for n in names])


def protected(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with all columns but these under names that nothing else has, and how to give them their names back."""
    seen: list[str] = []
    for i, c in enumerate(df.columns):
        seen.append(c if c in names and c not in seen else f"__other{i}")
    return df.toDF(*seen), lambda out: out.select(*seen).toDF(*df.columns)


def computed(
    df: DataFrame,
    columns: Sequence[str] | None,
    source: str,
    fields: T.StructType,
    start: Callable[[], Callable[[list], list[pa.Array]]],
) -> DataFrame:
    """These columns of the table (all of them, if none are named), and `fields`, computed from the column `source`.

    Each task calls `start` for a function from a batch of the source's values to the new columns. Input columns with
    the name of a new one give way; any other names may be there, differing in case alone even.
    """
    names = [c for c in (columns or df.columns) if c not in fields.names]
    numbered = df.toDF(*[f"__{i}" for i in range(len(df.columns))])
    rows = numbered.select(*[f"__{df.columns.index(c)}" for c in names], F.col(f"__{df.columns.index(source)}").alias("__source"))
    kept = rows.schema.fields[:-1]
    new = [T.StructField(f"__new{i}", f.dataType) for i, f in enumerate(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = start()
        for batch in batches:
            added = values(batch.columns[-1].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], [f.name for f in [*kept, *new]])

    return rows.mapInArrow(run, T.StructType([*kept, *new])).toDF(*names, *fields.names)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written under the shared folder: lineage ends there, and a lost executor costs no earlier step."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and, for each, the least node it is connected to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low != high
        if not apart.any():
            break
        x, y, low, high = x[apart], y[apart], low[apart], high[apart]
        np.minimum.at(label, high, low)
        while (jumped := label[label] != label).any():
            label[jumped] = label[label[jumped]]
    return nodes, nodes[label]


def _partial_forests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        nodes, roots = forest(frame["a"].to_numpy(), frame["b"].to_numpy())
        keep = nodes != roots
        yield pd.DataFrame({"a": nodes[keep], "b": roots[keep]})


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the least node it is connected to.

    Each batch of edges is first cut to a forest where it lies. Then large stars and small stars alternate: neighbours
    are moved to the least one they share a node with, until each component is one star around its least node. Every
    step is a minimum per node, summed up before the shuffle, and a join with it; nothing is gathered by component.
    """
    forests = edges.where("a <> b").select("a", "b").mapInPandas(_partial_forests, "a long, b long")
    now = written(forests.distinct(), "edges")
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        # a > b throughout. Large star: each node's larger neighbours go to the least of itself and its neighbours
        least = written(
            now.select(F.col("a").alias("u"), F.col("b").alias("v"))
            .union(now.select("b", "a"))
            .groupBy("u")
            .agg(F.least("u", F.min("v")).alias("m")),
            "least",
        )
        large = (
            now.join(least, now.b == least.u)
            .select("a", F.col("m").alias("b"))
            .where("a > b")
            .distinct()
        )
        large = written(large, "large")
        # small star: each node's smaller neighbours, and the node, go to the least of them
        least = written(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "least")
        joined = large.join(least, large.a == least.u)
        now = written(
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .union(least.select(F.col("u"), F.col("m")))
            .distinct(),
            "edges",
        )
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct()
    )


def let(values: dict[str, Column], then: Callable[[Column], Column]) -> Column:
    """`then` of a struct of these values, each computed once a row, also where `then` uses it within a lambda."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), then)[0]


def spread(key: Column, seed: str) -> Column:
    """128 random bits for a value, as 32 hexadecimal digits, the same in every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("-"))))
