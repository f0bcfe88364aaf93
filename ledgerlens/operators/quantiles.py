"""Exact quantiles and quantile bins.

The built-in exact percentile keeps every distinct value of a column in one buffer. Here a sketch brackets each
wanted rank, counts below and inside the brackets check and narrow them, and only the values inside are ranked. The
result is exact whatever the sketch's error: a bracket that misses its rank is moved to the side where the rank is.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the sketch is 1/ACCURACY; a bracket then holds about 4/ACCURACY of the rows.
ACCURACY = 10_000
# A bracket with more rows is narrowed by another sketch, until it has fewer or holds ties alone.
BRACKET_ROWS = 5_000_000


def _real(column: str) -> Column:
    """The column as double, without NaN (pandas and numpy skip it, Spark sorts it last)."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _brackets(df: DataFrame, columns: list[str], probs: tuple[float, ...], accuracy: int):
    """Rows, smallest and largest value per column, and per wanted quantile a value range that should hold it."""
    margin = 2.0 / accuracy
    fractions = [x for p in probs for x in (max(0.0, p - margin), min(1.0, p + margin))]
    stats = df.agg(
        *[
            e
            for i, c in enumerate(columns)
            for e in (
                F.count(_real(c)).alias(f"n{i}"),
                F.min(_real(c)).alias(f"lo{i}"),
                F.max(_real(c)).alias(f"hi{i}"),
                F.percentile_approx(_real(c), fractions, accuracy).alias(f"q{i}"),
            )
        ]
    ).first()
    for i, c in enumerate(columns):
        n = stats[f"n{i}"]
        if not n:
            continue
        for j, p in enumerate(probs):
            low, high = stats[f"q{i}"][2 * j], stats[f"q{i}"][2 * j + 1]
            yield (c, j), (n - 1) * p, (low, high), (stats[f"lo{i}"], stats[f"hi{i}"])


def _settled(df: DataFrame, plan: dict, accuracy: int, bracket_rows: int) -> dict:
    """Per quantile its rank, a bracket that holds it, and the number of rows below the bracket.

    Each round counts the rows below and inside the open brackets. One that lies to a side of its rank is moved to the
    other side; one with too many rows is narrowed by a sketch of what is inside, by a factor of about `accuracy` / 4,
    and left when that does not change it, as rows tied at its ends then fill it.
    """
    margin = 2.0 / accuracy
    done, open_ = {}, {key: (h, bracket, full) for key, (h, bracket, full) in plan.items()}
    while open_:
        keys = list(open_)
        counts = df.agg(
            *[
                e
                for i, key in enumerate(keys)
                for e in (
                    F.count_if(_real(key[0]) < open_[key][1][0]).alias(f"below{i}"),
                    F.count_if(_real(key[0]).between(*open_[key][1])).alias(f"inside{i}"),
                )
            ]
        ).first()
        aims = {}
        for i, key in enumerate(keys):
            h, (low, high), (least, most) = open_[key]
            below, n = counts[f"below{i}"], counts[f"inside{i}"]
            if below > floor(h):
                open_[key] = (h, (least, low), (least, most))
            elif ceil(h) >= below + n:
                open_[key] = (h, (high, most), (least, most))
            elif n > bracket_rows and low < high:
                aims[key] = (max(0.0, (floor(h) - below) / n - margin), min(1.0, (ceil(h) + 1 - below) / n + margin))
                done[key] = (h, (low, high), below)
            else:
                done[key] = (h, (low, high), below)
                del open_[key]
        if aims:
            ends = df.agg(
                *[
                    F.percentile_approx(F.when(_real(key[0]).between(*open_[key][1]), _real(key[0])), list(aim), accuracy).alias(f"q{i}")
                    for i, (key, aim) in enumerate(aims.items())
                ]
            ).first()
            for i, key in enumerate(aims):
                h, bracket, full = open_[key]
                if tuple(ends[f"q{i}"]) == bracket:
                    del open_[key]
                else:
                    open_[key] = (h, tuple(ends[f"q{i}"]), full)
    return done


def _ranked_values(df: DataFrame, settled: dict) -> dict:
    """For each (column, j): the values at the two ranks around the wanted position."""
    keys = list(settled)

    def hit(k: int) -> Column:
        value = _real(keys[k][0])
        return F.when(value.between(*settled[keys[k]][1]), F.struct(F.lit(k).alias("k"), value.alias("v")))

    # rows outside all brackets give nothing
    counts = (
        df.select(F.explode(F.array_compact(F.array(*[hit(k) for k in range(len(keys))]))).alias("h"))
        .groupBy(F.col("h.k").alias("k"), F.col("h.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def of_key(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("k") + 1)

    # distinct values of a bracket: few, unless rows tie
    upto = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("upto", F.sum("n").over(upto) + of_key([settled[key][2] for key in keys]))
    rows = (
        running.groupBy("k")
        .agg(
            F.min(F.when(F.col("upto") > of_key([floor(settled[key][0]) for key in keys]), F.col("v"))).alias("at"),
            F.min(F.when(F.col("upto") > of_key([ceil(settled[key][0]) for key in keys]), F.col("v"))).alias("next"),
        )
        .collect()
    )
    return {keys[r["k"]]: (r["at"], r["next"]) for r in rows}


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: tuple[float, ...],
    accuracy: int = ACCURACY,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; nulls and NaN are left out.

    Three passes over `df`, and two more per narrowing where brackets would be too large. Only a few numbers per
    quantile come to the driver.
    """
    plan = {key: (h, bracket, full) for key, h, bracket, full in _brackets(df, columns, probs, accuracy)}
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    if not plan:
        return result
    found = _ranked_values(df, _settled(df, plan, accuracy, bracket_rows))
    for (column, j), (h, _, _) in plan.items():
        low, high = found[(column, j)]
        result[column][j] = low + (high - low) * (h - floor(h))
    return result


def median_of(df: DataFrame, columns: list[str], approx: bool = False) -> dict[str, float | None]:
    """Median per column; `approx` gives a close data value from a sketch in one pass instead."""
    if approx:
        row = df.agg(*[F.percentile_approx(_real(c), 0.5, ACCURACY).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    return {c: q[0] for c, q in exact_quantiles(df, columns, (0.5,)).items()}


def quantile_bin(value: Column, edges: list[float]) -> Column:
    """Bin 1..n by right-closed edges; the first bin includes the smallest edge, values outside are null."""
    inside = value.between(edges[0], edges[-1])
    passed = sum((F.when(value > e, 1).otherwise(0) for e in edges[1:-1]), F.lit(1))
    return F.when(inside, passed)


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Edges of equal-count bins; two equal edges are an error."""
    edges = exact_quantiles(df, [column], tuple(i / bins for i in range(bins + 1)))[column]
    if any(a is None or a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"quantile edges of {column} are not unique: {edges}")
    return edges


def score_distribution(df: DataFrame, var: str, bins: int, target: str) -> DataFrame:
    """Per quantile bin of `var`: edges, non-null targets, their sum and mean, and the mean to two places."""
    edges = quantile_edges(df, var, bins)
    low = F.array(*[F.lit(e) for e in edges[:-1]])
    high = F.array(*[F.lit(e) for e in edges[1:]])
    mean = F.try_divide(F.col("total"), F.col("n").cast("double"))
    return (
        df.withColumn("bin", quantile_bin(_real(var), edges))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(target).alias("n"), F.sum(F.col(target).cast("double")).alias("total"))
        .select(
            "bin",
            F.element_at(low, F.col("bin")).alias("lower"),
            F.element_at(high, F.col("bin")).alias("upper"),
            "n",
            "total",
            mean.alias("mean"),
            # halves go to the even neighbour
            (F.rint(mean * 100) / 100).alias("mean_2"),
        )
    )
