"""Hard negatives for anchor vectors: scores bounded by means and deviations of segments, level by level, then in full."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pick, table, written

#: segments that a vector is cut into, level by level
LEVELS = (4, 16)
#: most vectors of a block, and blocks of rows that there are at least: a tile holds a block of anchors and one of rows
BLOCK, BLOCKS = 32768, 16
#: anchors looked at together within a tile
STRIP = 64
#: most that a vector's squares may sum up to: products with any other then fit a long, 100 times over
LARGEST = 1 << 56
#: sums of this size and below are whole numbers in doubles too
EXACT = 1 << 52


class Summary:
    """Vectors, and for each level the mean and deviation of their segments.

    A product over a segment is the product of the means by its length, give or take the product of the deviations, the
    norms of what the means leave. One more deviation, tiny, carries what rounding may add.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors, x = vectors, vectors.astype(float)
        norms = np.sqrt((x**2).sum(axis=1))
        self.means, self.deviations = [], []
        for level in LEVELS:
            cuts = np.unique(np.arange(level) * x.shape[1] // level)
            sizes = np.diff(np.append(cuts, x.shape[1]))
            sums = np.add.reduceat(x, cuts, axis=1)
            rest = x - np.repeat(sums / sizes, sizes, axis=1)
            self.means.append(sums / np.sqrt(sizes))
            self.deviations.append(np.c_[np.sqrt(np.add.reduceat(rest**2, cuts, axis=1)), 3e-5 * norms + 1e-5])
        self.doubles = x if (norms**2).max(initial=0) <= EXACT else None

    def __getitem__(self, at: slice) -> Summary:
        part = object.__new__(Summary)
        part.vectors, part.doubles = self.vectors[at], None if self.doubles is None else self.doubles[at]
        part.means, part.deviations = [m[at] for m in self.means], [d[at] for d in self.deviations]
        return part


def _products(a: np.ndarray, b: np.ndarray, keep: np.ndarray) -> Iterator[np.ndarray]:
    """For each row of `a` its products with the rows of `b` that `keep` marks: all at once while many are marked."""
    if 4 * np.count_nonzero(keep) > keep.size:
        whole = a @ b.T
        yield from (whole[i, k] for i, k in enumerate(keep))
    else:
        yield from (b[k] @ v for v, k in zip(a, keep))


def _reachable(low: np.ndarray, high: np.ndarray, bands: np.ndarray, k: int) -> np.ndarray:
    """Which rows, with scores between `low` and `high`, may be among the k highest within one of the bands."""
    found = np.zeros(len(low), bool)
    for least, most in bands:
        sure = low[(low >= least) & (high <= most)]
        if len(sure) > k:
            least = max(least, np.partition(sure, len(sure) - k)[len(sure) - k])
        found |= (high >= least) & (low <= most)
    return found


def highest(anchors: Summary, rows: Summary, keep: np.ndarray, bands: list[np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores): of the pairs that `keep` marks, all that may be among an anchor's k highest in a band."""
    for start in range(0, len(keep), STRIP):
        of, open_ = anchors[start : start + STRIP], keep[start : start + STRIP]
        for level in range(len(LEVELS)):
            middles = _products(of.means[level], rows.means[level], open_)
            spreads = _products(of.deviations[level], rows.deviations[level], open_)
            new = np.zeros_like(open_)
            for i, (m, s) in enumerate(zip(middles, spreads)):
                at = np.flatnonzero(open_[i])
                new[i, at[_reachable(m - s, m + s, bands[start + i], k)]] = True
            open_ = new
        if of.doubles is not None and rows.doubles is not None:
            scores = _products(of.doubles, rows.doubles, open_)
        else:
            scores = _products(of.vectors, rows.vectors, open_)
        for i, s in enumerate(scores):
            yield start + i, np.flatnonzero(open_[i]), s.astype(np.int64)


def _tile(data: pa.Table, same: bool, k: int) -> Iterator[pa.Table]:
    """Of a tile's rows, the k highest of each anchor and band by score, then vec_id."""
    query = data["query"].to_numpy()
    column = {c: data[c].to_numpy() for c in ("row", "vec_id", "label")}
    vectors = data["vector"].combine_chunks().flatten().to_numpy().reshape(len(query), -1)
    a, r = np.flatnonzero(query), np.flatnonzero(~query)
    if not len(a) or not len(r):
        return
    given = {i: [(b["least"], b["most"]) for b in data["bands"][i].as_py() or ()] for i in a.tolist()}
    bands = [np.array(given[i] or [(-np.inf, np.inf)], float) for i in a]
    anchors, rows = Summary(vectors[a]), Summary(vectors[r])
    label, row = column["label"], column["row"]
    for start in range(0, len(a), STRIP):
        at = a[start : start + STRIP]
        keep = (label[at][:, None] == label[r]) == same
        keep &= row[at][:, None] != row[r]
        found: list[tuple] = []
        for i, to, scores in highest(anchors[start : start + STRIP], rows, keep, bands[start : start + STRIP], k):
            exact = given[at[i]] or [(None, None)]
            for band, (least, most) in enumerate(exact):
                inside = slice(None) if least is None else (scores >= least) & (scores <= most)
                others, s = r[to[inside]], scores[inside]
                if len(s) > k:
                    near = s >= np.partition(s, len(s) - k)[len(s) - k]
                    others, s = others[near], s[near]
                first = np.lexsort((row[others], column["vec_id"][others], -s))[:k]
                n = len(first)
                found.append((np.full(n, row[at[i]]), np.full(n, band), row[others[first]], column["vec_id"][others[first]], s[first]))
        yield pa.table([np.concatenate(c).astype(np.int64) for c in zip(*found)], ["anchor", "band", "row", "vec_id", "score"])


def _best(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], same: bool, k: int) -> DataFrame:
    """(anchor, band, row, vec_id, score, rank): the k highest rows of each anchor and band, over all tiles."""
    left, right = counts
    side = [F.size("vector").alias("dims"), "row", "vec_id", "label", "vector"]
    of_row, of_anchor = (F.pmod(F.xxhash64("row"), F.lit(n)).cast("int") for n in (right, left))
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (left, right)]
    sent = rows.select(*side, F.lit(False).alias("query"), every[0].alias("a"), of_row.alias("r"), F.lit(None).cast(BANDS).alias("bands"))
    sent = sent.union(anchors.select(*side, F.lit(True).alias("query"), of_anchor.alias("a"), every[1].alias("r"), "bands"))

    def best(data: pa.Table) -> pa.Table:
        parts = list(_tile(data, same, k))
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], pa.int64())] * 5, ["anchor", "band", "row", "vec_id", "score"])

    tiles = sent.groupBy("dims", "a", "r").applyInArrow(best, "anchor long, band long, row long, vec_id long, score long")
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "vec_id", "row")
    return tiles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


BANDS = "array<struct<least: bigint, most: bigint>>"


def hard_negatives(
    vectors: DataFrame, anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    block: int = BLOCK, blocks: int = BLOCKS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as whole numbers, floor(scale * x), and a row's score is its product with the anchor. Anchors are the
    rows where `anchor`, a condition on vec_id and label, holds. An anchor's positives are its `positives` highest other
    rows of the same label; each has for negatives the `negatives` highest rows of other labels whose score is `low` to
    `high` hundredths of the positive's. Equal scores go by vec_id.

    Anchors and rows meet in tiles of a block each, whatever the labels. Within a tile most pairs are settled by bounds
    from segment means and deviations; a row is scored in full only if it may be among the highest. The work is the
    number of anchors by the number of rows; a tile gives `positives` rows an anchor, or `negatives` an anchor and band.

    Rows with null vec_id, label or vector, an empty vector, or a null or non-finite component take no part, nor do those
    whose whole numbers' squares sum up to more than 2^56, with which longs could overflow. Vectors of different length
    have no score. Equal rows and rows that share a vec_id are rows of their own. No rows, no anchors or no other label:
    no rows. Only vec_id, label and embedding are looked at.
    """
    given = pick(vectors, "vec_id", "label", "embedding").select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale <= LARGEST**0.5))
    given = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & fine)
    whole = given.select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", anchor.alias("query"),
        F.transform("embedding", lambda x: F.floor(x * scale)).alias("vector"),
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = written(whole.where(squares <= float(LARGEST)), "rows")
    n = rows.agg(F.count("*").alias("rows"), F.count_if("query").alias("anchors")).first()
    counts = max(1, -(-n["anchors"] // block)), max(1, blocks, -(-n["rows"] // block))

    anchors = rows.where("query")
    best = _best(rows, anchors.withColumn("bands", F.lit(None).cast(BANDS)), counts, True, positives)
    near = written(best.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("nth")), "positives")
    # an anchor's positives, `positives` of them at most, give a band each; equal scores have the same band
    scores = near.groupBy("anchor").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))
    bands = F.transform("scores", lambda p: F.struct(_down(p * low + 99, 100).alias("least"), _down(p * high, 100).alias("most")))
    asked = anchors.join(scores.withColumnRenamed("anchor", "row"), "row").withColumn("bands", bands)
    worst = _best(rows, asked.drop("scores"), counts, False, negatives)
    of_band = near.join(scores, "anchor").withColumn("band", F.array_position("scores", F.col("positive_score")) - 1)
    named = of_band.join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    found = worst.select("anchor", "band", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), F.col("rank").cast("int"))
    return named.join(found, ["anchor", "band"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _down(value: Column, by: int) -> Column:
    """The quotient of whole numbers, rounded down."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = pick(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label").withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)
