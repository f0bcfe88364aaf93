"""Near duplicates among vectors by PCA-ordered tiled comparison."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, Bucketizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import components, forest, let, pick, table, written

#: vectors of a block, and blocks that there are at least: a tile compares two blocks
BLOCK, BLOCKS = 8192, 16
#: leading dimensions after which pairs are dropped
STEPS = (8, 16, 32)
#: vectors compared at once within a tile
CORNER = 1024
#: places in which the name of a component is looked up
SALTS = 16
#: how far rounding may carry a bound
ROUNDING = 1e-9


def _suffix_norms(x: np.ndarray, dims: int) -> np.ndarray:
    return np.sqrt(np.maximum(0, (x[:, dims:] ** 2).sum(axis=1)))


def _tails(x: np.ndarray) -> dict[int, np.ndarray]:
    return {d: _suffix_norms(x, d) for d in STEPS if d < x.shape[1]}


def linked(a: np.ndarray, b: np.ndarray, tails_a: dict, tails_b: dict, raw_a: np.ndarray, raw_b: np.ndarray, least: float):
    """Positions (i, j) of all pairs of rows with a cosine of `least` or more.

    `a` and `b` are unit vectors in the principal basis, `raw_a` and `raw_b` the vectors as given. The product over the
    leading dimensions plus the product of the norms of what follows bounds the cosine; a pair that cannot reach `least`
    is dropped after the first few dimensions. While many pairs are left the next dimensions are added for all of them
    at once, later pair by pair. What remains is computed in full from the given vectors.
    """
    steps = sorted(tails_a)
    need = least - ROUNDING
    product, done = np.zeros((len(a), len(b))), 0
    i = j = None
    for d in steps:
        if i is None:
            product += a[:, done:d] @ b[:, done:d].T
            open_ = product + np.outer(tails_a[d], tails_b[d]) >= need
            if np.count_nonzero(open_) * 16 < open_.size:
                i, j = np.nonzero(open_)
                product = product[i, j]
        else:
            product = product + np.einsum("ij,ij->i", a[i, done:d], b[j, done:d])
            keep = product + tails_a[d][i] * tails_b[d][j] >= need
            i, j, product = i[keep], j[keep], product[keep]
        done = d
    if i is None:
        i, j = np.nonzero(product + a[:, done:] @ b[:, done:].T >= need)
    for start in range(0, len(i), 1 << 16):
        at, to = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
        x, y = raw_a[at], raw_b[to]
        lengths = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
        keep = np.einsum("ij,ij->i", x, y) / lengths >= least
        yield at[keep], to[keep]


def compare_tile(ids: np.ndarray, raw: np.ndarray, left: np.ndarray, right: np.ndarray, weights: np.ndarray, basis: np.ndarray, least: float):
    """For the rows of a tile: ids, links and the least id each is connected to within the tile.

    `left` and `right` mark which block a row belongs to; both, if a block meets itself. A link counts as often as the
    vector at its other end has copies. Links are summed up corner by corner; none is kept.
    """
    # by a power of two, so that squares neither overflow nor vanish and cosines stay as they are
    raw = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
    x = raw / np.sqrt((raw**2).sum(axis=1))[:, None] @ basis
    links = np.zeros(len(ids), np.int64)
    near_a, near_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows, columns = np.flatnonzero(left), np.flatnonzero(right)
    itself = bool((left & right).any())
    for r in range(0, len(rows), CORNER):
        p = rows[r : r + CORNER]
        tails_p = _tails(x[p])
        for c in range(r if itself else 0, len(columns), CORNER):
            q = columns[c : c + CORNER]
            found_a, found_b = [], []
            for i, j in linked(x[p], x[q], tails_p, _tails(x[q]), raw[p], raw[q], least):
                if itself and r == c:
                    i, j = i[i < j], j[i < j]
                np.add.at(links, p[i], weights[q[j]])
                np.add.at(links, q[j], weights[p[i]])
                found_a.append(p[i])
                found_b.append(q[j])
            if sum(map(len, found_a)):
                nodes, roots = forest(ids[np.concatenate(found_a)], ids[np.concatenate(found_b)])
                near_a.append(nodes)
                near_b.append(roots)
    nodes, roots = forest(np.concatenate(near_a), np.concatenate(near_b))
    order = np.argsort(ids)
    at = order[np.searchsorted(ids[order], nodes)]
    return nodes, links[at], roots


def near_vectors(vectors: DataFrame, least: float = 0.95, block: int = BLOCK, blocks: int = BLOCKS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector; links join vectors with a cosine of `least` or more.

    Equal vectors form a class, compared once and counted as often as it has copies. Classes are turned into the basis
    of their principal components and put in order of the first; blocks of about `block` classes along that order, at
    least `blocks` of them, meet in tiles, but for those too far apart in that coordinate. Within a tile `linked` looks
    at few leading dimensions of most pairs. A tile holds two blocks, whatever the data: a range of the order that has
    more classes, as many share its coordinate, is cut by a hash into blocks that all meet each other. Tiles give sums
    and forests, never pairs.

    The work grows with the square of the number of different vectors unless the first coordinate tells them apart;
    the method is exact, and each dropped pair costs eight of its dimensions.

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with nothing and are kept.
    Vectors of another length than theirs link with nothing either. Null vec_id: the vector links like any other but
    names no component, so one with such vectors alone has none; rows that share a vec_id are vectors of their own. No
    vectors: no rows. Only vec_id and embedding are looked at.
    """
    rows = pick(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = fine & F.exists("embedding", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # a class has a key of its own, as its vectors may lack ids or share one with another class
    distinct = rows.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = written(distinct.withColumn("id", F.monotonically_increasing_id()), "classes")
    found = [_tiles(classes.where(F.size("embedding") == r["d"]), r["d"], r["n"], least, block, blocks)
             for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()]
    tiles = classes.select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("root")).limit(0)
    for one in found:
        tiles = tiles.union(one)
    tiles = written(tiles, "tiles")
    labels = components(tiles.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    # the least vec_id of a component, looked up in SALTS places, as one component may hold most of the vectors
    named = written(labels.join(classes.select(F.col("id").alias("node"), "vec_id"), "node"), "labels")
    names = named.groupBy("component").agg(F.min("vec_id").alias("named"))
    names = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = named.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    roots = salted.join(names, ["component", "salt"]).select(F.col("node").alias("id"), "named", F.lit(True).alias("joined"))
    counts = tiles.groupBy("id").agg(F.sum("links").alias("links"))
    known = written(
        classes.join(counts, "id", "left")
        .join(roots, "id", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("joined"), F.col("named")).otherwise(F.col("vec_id")).alias("root"),
        ),
        "known",
    )
    usable_rows = rows.where("usable").join(known, "embedding", "left").select("vec_id", "n_links", "root")
    others = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("root"))
    return usable_rows.union(others).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("root").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("root")).alias("kept"),
    )


def _unit(vector: Column) -> Column:
    def divided(s: Column) -> Column:
        return F.transform(s["v"], lambda v: v / s["by"])

    def length(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))

    # by the largest component first, so that squares do not overflow
    largest = F.array_max(F.transform(vector, F.abs))
    scaled = let({"v": vector, "by": largest}, divided)
    return let({"scaled": scaled}, lambda s: let({"v": s["scaled"], "by": length(s["scaled"])}, divided))


def _tiles(classes: DataFrame, dims: int, n: int, least: float, block: int, blocks: int) -> DataFrame:
    """(id, links, root) from all tiles over classes of one length."""
    spark = classes.sparkSession
    unit = classes.withColumn("unit", _unit(F.col("embedding")))
    if n > 1:
        model = PCA(k=dims, inputCol="unit", outputCol="turned").fit(unit.select(array_to_vector("unit").alias("unit")))
        basis = model.pc.toArray()
    else:
        basis = np.eye(dims)
    first = [float(v) for v in basis[:, 0]]
    lead = F.aggregate(F.zip_with("unit", F.lit(first), lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)
    placed = unit.select("id", "copies", "embedding", lead.alias("lead"))

    # as many ranges as blocks are wanted; one number a block on the driver
    wanted = max(blocks, -(-n // block))
    cuts = placed.agg(F.percentile_approx("lead", [i / wanted for i in range(1, wanted)], 100 * wanted)).first()[0]
    edges = [float("-inf"), *sorted(set(cuts)), float("inf")]
    ranged = Bucketizer(splits=edges, inputCol="lead", outputCol="range").transform(placed).withColumn("range", F.col("range").cast("int"))
    ranged = written(ranged, "ranged")
    stats = {r["range"]: r for r in ranged.groupBy("range").agg(F.min("lead").alias("low"), F.max("lead").alias("high"), F.count("*").alias("n")).collect()}
    ranges = sorted(stats)
    parts = {b: -(-stats[b]["n"] // (2 * block)) for b in ranges}
    # the coordinate of two vectors with that cosine differs by this at most
    reach = (2 - 2 * least) ** 0.5 + ROUNDING
    lows = [stats[b]["low"] for b in ranges]
    last = {b: ranges[bisect_right(lows, stats[b]["high"] + reach) - 1] for b in ranges}
    # blocks are numbered on; a range of several blocks has several numbers
    start, count = {}, 0
    for b in ranges:
        start[b] = count
        count += parts[b]
    meets = [(b, start[b], parts[b], start[last[b]] + parts[last[b]] - 1) for b in ranges]
    numbered = ranged.join(F.broadcast(spark.createDataFrame(meets, "range int, start int, parts int, last int")), "range")
    numbered = numbered.withColumn("block", (F.col("start") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int"))
    # a block meets the later ones up to `last`, and is met by the earlier ones whose own `last` is as far
    reach_of = [m[3] for m in meets for _ in range(m[2])]
    earliest = [min(e for e in range(b + 1) if reach_of[e] >= b) for b in range(count)]
    bounds = spark.createDataFrame([(b, earliest[b], reach_of[b]) for b in range(count)], "block int, earliest int, latest int")
    sent = numbered.join(F.broadcast(bounds), "block").select(
        "id",
        "copies",
        "embedding",
        "block",
        F.explode(
            F.concat(
                F.transform(F.sequence("block", "latest"), lambda o: F.struct(F.col("block").alias("left"), o.alias("right"))),
                F.filter(
                    F.transform(F.sequence("earliest", "block"), lambda o: F.struct(o.alias("left"), F.col("block").alias("right"))),
                    lambda t: t["left"] < t["right"],
                ),
            )
        ).alias("tile"),
    )
    sent = sent.select("id", "copies", "embedding", "block", "tile.left", "tile.right")

    def compare(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        of = f["block"].to_numpy()
        raw = np.array(f["embedding"].tolist(), float)
        nodes, links, roots = compare_tile(f["id"].to_numpy(), raw, of == key[0], of == key[1], f["copies"].to_numpy(), basis, least)
        return pd.DataFrame({"id": nodes, "links": links, "root": roots})

    return sent.groupBy("left", "right").applyInPandas(compare, "id long, links long, root long")


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
