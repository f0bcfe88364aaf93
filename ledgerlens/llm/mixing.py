"""Mixing sources to target weights: exact block quotas split over output shards by hypergeometric draws."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, let, pick, spread, table, written

#: hexadecimal digits that name a block, and the finer blocks that the last block of a source is cut into
DIGITS = (2, 4, 6)
#: characters of `key` that each of these adds: eight random ones, and the block's own two digits
STEP = 10


def targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """`target` for each `(source, source_size)`: shares of all sizes by weight, none above `most` times its size.

    Sources are numbered by code point, null last; weights repeat in that order. Raising all shares together, sources
    reach their limit in the order of limit by weight, so the level follows from running sums: one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "number")
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * most).over(earlier), F.lit(0))
    share = rest / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    below = F.col("share") * F.col("weight") <= F.col("source_size") * most
    return (
        sizes.withColumn("number", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("share", share)
        .withColumn("level", F.min(F.when(below, F.struct(F.col("source_size") / F.col("weight"), "number", "share"))).over(every)["share"])
        .withColumn(
            "target",
            F.least(F.coalesce(F.col("level") * F.col("weight"), F.lit(0.0)), (F.col("source_size") * most).cast("double")),
        )
        .select("source", "source_size", "number", "target")
    )


def _uniform(seed: str, *parts: Column) -> Column:
    digits = F.substring(spread(F.concat_ws(":", *parts), seed), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(16**13)


def _steps(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of `marked` among `total` are in a random draw of `drawn`: the quantile `u` of that distribution.

    Weights relative to the most likely count follow from ratios of neighbours. Counts further than ten standard
    deviations and ten from it, whose chance is below 1e-20, are left out.
    """

    def bounds(s: Column) -> Column:
        n, k, d = s["n"], s["k"], s["d"]
        low, high = F.greatest(F.lit(0.0), d + k - n), F.least(d, k)
        likely = F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")
        variance = F.greatest(F.lit(0.0), d * k * (n - k) * (n - d)) / F.greatest(F.lit(1.0), n * n * (n - 1))
        values = {"n": n, "k": k, "d": d, "u": s["u"], "low": low, "high": high, "reach": F.ceil(F.sqrt(variance) * 10) + 10}
        return let(values | {"mode": F.least(high, F.greatest(low, likely))}, weigh)

    def weigh(s: Column) -> Column:
        n, k, d, mode = s["n"], s["k"], s["d"], s["mode"]

        def up(ws: Column, i: Column) -> Column:
            j = mode + i - 1
            return F.array_append(ws, F.element_at(ws, -1) * (k - j) * (d - j) / ((j + 1) * (n - k - d + j + 1)))

        def down(ws: Column, i: Column) -> Column:
            j = mode - i
            return F.array_append(ws, F.element_at(ws, -1) * (j + 1) * (n - k - d + j + 1) / ((k - j) * (d - j)))

        first, last = F.greatest(s["low"], mode - s["reach"]), F.least(s["high"], mode + s["reach"])
        above = F.aggregate(_steps(last - mode), F.array(F.lit(1.0)), up)
        below = F.aggregate(_steps(mode - first), F.array(F.lit(1.0)), down)
        weights = F.concat(F.reverse(below), F.slice(above, F.lit(2), F.size(above)))
        return let({"weights": weights, "first": first, "last": last, "u": s["u"]}, choose)

    def choose(s: Column) -> Column:
        goal = s["u"] * F.aggregate(s["weights"], F.lit(0.0), lambda a, w: a + w)
        return let({"weights": s["weights"], "first": s["first"], "last": s["last"], "goal": goal}, count)

    def count(s: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("passed"))

        def add(a: Column, w: Column) -> Column:
            passed = a["passed"] + (a["sum"] + w < s["goal"]).cast("int")
            return F.struct((a["sum"] + w).alias("sum"), passed.alias("passed"))

        return F.least(s["last"], s["first"] + F.aggregate(s["weights"], start, add)["passed"]).cast("long")

    given = {"n": total.cast("double"), "k": marked.cast("double"), "d": drawn.cast("double"), "u": u}
    return let(given, bounds)


def split_quotas(quotas: DataFrame, levels: int, seed: str) -> DataFrame:
    """(number, shard, blocks): the quotas (number, blocks) of sources dealt out over 2 ** levels shards.

    At each node of a binary tree half of the node's blocks go left; how many of each source is drawn source by source,
    given the draws before, which makes the draw multivariate hypergeometric. Rows are sources by nodes, never blocks.
    """
    nodes = quotas.select(F.lit(0).alias("shard"), "number", "blocks")
    for level in range(levels):
        name = F.concat_ws(":", F.lit(f"split{level}"), "shard")
        nodes = _split(nodes, lambda number, n=name: _uniform(seed, n, number.cast("string")))
    return nodes


def _split(nodes: DataFrame, chance: Callable[[Column], Column]) -> DataFrame:
    """The quotas of the two children of each node; `chance` gives the uniform number for a source."""
    grouped = nodes.groupBy("shard").agg(
        F.sort_array(F.collect_list(F.struct("number", "blocks"))).alias("items"), F.sum("blocks").alias("total")
    )

    def step(state: Column, item: Column) -> Column:
        def note(s: Column) -> Column:
            drawn = F.struct(item["number"].alias("number"), item["blocks"].alias("blocks"), s["left"].alias("left"))
            return F.struct(
                (state["rest"] - item["blocks"]).alias("rest"),
                (state["want"] - s["left"]).alias("want"),
                F.array_append(state["drawn"], drawn).alias("drawn"),
            )

        left = hypergeometric(state["rest"], item["blocks"], state["want"], chance(item["number"]))
        return let({"left": left}, note)

    start = F.struct(
        F.col("total").alias("rest"),
        F.expr("total div 2").alias("want"),
        F.array().cast("array<struct<number:int,blocks:bigint,left:bigint>>").alias("drawn"),
    )
    drawn = grouped.select("shard", F.inline(F.aggregate("items", start, step)["drawn"]))
    return drawn.select("number", F.expr("stack(2, shard * 2, left, shard * 2 + 1, blocks - left) as (shard, blocks)"))


def _keyed(rows: DataFrame, seed: str) -> DataFrame:
    """Adds `random`, 32 digits by doc_id, and `key`, the place in the random order of the source `number`.

    The order is one of blocks, within a block of finer blocks, and so on, then of documents; a block's name starts
    its key, so that a document's block is a prefix.
    """
    named = rows.withColumn("random", spread(F.col("doc_id"), seed))
    parts = []
    for digits in DIGITS:
        block = F.substring("random", 1, digits)
        place = spread(F.concat_ws(":", F.lit("block"), F.col("number").cast("string"), block), seed)
        parts += [F.substring(place, 1, STEP - 2), F.substring("random", digits - 1, 2)]
    return named.withColumn("key", F.concat(*parts, F.col("random")))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _sized(docs: DataFrame) -> DataFrame:
    rows = pick(docs, "doc_id", "text", "source")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return written(rows.select("doc_id", "source", size.alias("size")), "sized")


def _plan(sized: DataFrame, weights: tuple[int, ...], most: int, levels: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """What is drawn: a row for each source, and a row for each source and block with its tickets."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.col("source_size") > 0
    sources = written(
        targets(sums, weights, most)
        .withColumn("goal", F.round("target").cast("long"))
        .select(
            F.col("source").alias("of"),
            _source_key(F.col("source")).alias("source_key"),
            "number",
            "source_size",
            "target",
            F.when(full, F.expr("goal div source_size")).otherwise(0).cast("int").alias("passes"),
            F.when(full, F.expr("goal % source_size")).otherwise(0).alias("want"),
        ),
        "sources",
    )
    known = _keyed(_of_source(sized, sources.select("source_key", "number", "passes")), seed)
    units = written(known.groupBy("number", "key").agg(F.sum("size").alias("size")), "units")

    # the partial pass: find the cell that the target falls in, then the finer cell within, then the document
    cut = sources.where("want > 0").select("number", F.lit("").alias("cut"), F.lit(0).cast("long").alias("before"), "want")
    for level in range(1, len(DIGITS) + 1):
        cells = (
            units.join(cut, "number")
            .where(F.expr("startswith(key, cut)"))
            .groupBy("number", F.substring("key", 1, STEP * level).alias("cell"))
            .agg(F.sum("size").alias("size"), F.first("before").alias("before"), F.first("want").alias("want"))
        )
        order = Window.partitionBy("number").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cut = written(
            cells.withColumn("after", F.col("before") + F.sum("size").over(order))
            .where("after > want and after - size <= want")
            .select("number", F.col("cell").alias("cut"), (F.col("after") - F.col("size")).alias("before"), "want"),
            "cut",
        )
    order = Window.partitionBy("number").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    fitting = (
        units.join(cut, "number")
        .where(F.expr("startswith(key, cut)"))
        .withColumn("after", F.col("before") + F.sum("size").over(order))
        .where("after <= want")
        .groupBy("number")
        .agg(F.max("key").alias("last_key"), F.max("after").alias("end"))
    )
    ends = written(
        cut.join(fitting, "number", "left").select(
            "number",
            F.coalesce("last_key", "cut").alias("last_key"),
            (F.col("want") - F.coalesce("end", "before")).alias("gap"),
        ),
        "ends",
    )
    miss = F.abs(F.col("size") - F.col("gap"))
    closing = (
        units.join(ends, "number")
        .where((F.col("key") > F.col("last_key")) & (miss < F.col("gap")))
        .groupBy("number")
        .agg(F.min(F.struct(miss.alias("miss"), "key"))["key"].alias("closing_key"))
    )
    sources = written(sources.join(ends, "number", "left").join(closing, "number", "left"), "sources")

    # tickets: every pass over every block, in a random order per source
    drawn = units.join(sources.select("number", "passes", "last_key", "closing_key"), "number")
    blocks = (
        drawn.withColumn("partial", _partial())
        .groupBy("number", F.substring("key", 1, STEP).alias("block"))
        .agg((F.max("passes") + F.max(F.col("partial").cast("int"))).alias("count"))
        .where("count > 0")
    )
    place = spread(F.concat_ws(":", F.lit("ticket"), "number", "block", "epoch"), seed)
    tickets = (
        blocks.select("number", "block", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("epoch"))
        .withColumn("place", F.row_number().over(Window.partitionBy("number").orderBy(place, "block", "epoch")) - 1)
    )
    tickets = written(tickets, "tickets")
    shards = split_quotas(tickets.groupBy("number").agg(F.count("*").alias("blocks")), levels, seed)
    to = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    shards = shards.withColumn("to", F.sum("blocks").over(to)).withColumn("from", F.col("to") - F.col("blocks"))
    inside = (F.col("place") >= F.col("from")) & (F.col("place") < F.col("to"))
    dealt = (
        tickets.join(shards.withColumnRenamed("number", "n"), (F.col("number") == F.col("n")) & inside)
        .groupBy("number", "block")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("tickets"))
    )
    return sources, written(dealt, "dealt")


def _partial() -> Column:
    fits = F.coalesce(F.col("key") <= F.col("last_key"), F.lit(False))
    return fits | F.coalesce(F.col("key") == F.col("closing_key"), F.lit(False))


def _of_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return rows.join(sources, _source_key(rows["source"]) == sources["source_key"]).drop("source_key")


def _drawn(rows: DataFrame, sources: DataFrame, dealt: DataFrame, seed: str) -> DataFrame:
    """Rows with doc_id and source, and their draws: source_size, target, random, copies."""
    found = _keyed(_of_source(rows, sources), seed).withColumn("block", F.substring("key", 1, STEP))
    found = found.withColumn("partial", _partial())
    mine = F.filter("tickets", lambda t: (t["epoch"] < F.col("passes")) | F.col("partial"))
    return found.join(dealt, ["number", "block"], "left").withColumn(
        "copies", F.coalesce(mine, F.array().cast("array<struct<epoch:int,shard:int>>"))
    )


def draw(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, levels: int = 4, seed: str = "mix"
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, and copies, an array of (epoch, shard).

    Each source's target, a number of words, is met by whole passes over the source and one partial pass. For the
    partial pass the source's blocks, 256 of them by a hash of doc_id, come in a random order and are taken while they
    fit. The block that does not fit is cut into finer blocks, and those again, and its documents are taken while they
    fit; the gap left is closed by the document whose size comes nearest to it, if one helps. Every pass over a block
    is a ticket of its source: `split_quotas` says how many tickets each of 2 ** levels shards gets, and the source's
    tickets, in a random order, are dealt out so.

    Null source: a source of its own, last in order. Null or empty text: size 0. Null doc_id: one hash value for all.
    Rows that share doc_id and source are drawn together. No documents: no rows. Only the columns doc_id, text and
    source are looked at. A rerun gives the same rows.
    """
    sized = _sized(docs)
    sources, dealt = _plan(sized, weights, most, levels, seed)
    return _drawn(sized, sources, dealt, seed).select("doc_id", "source", "size", "source_size", "target", "copies")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, levels: int = 4, seed: str = "mix"
) -> DataFrame:
    """The mixed corpus: each document once for each of its draws, its columns as they were, `epoch` and `shard` added.

    Shards are laid out one after the other, each in a random order of its own. Input columns named epoch or shard are
    replaced by these. For odd input see `draw`.
    """
    sources, dealt = _plan(_sized(docs), weights, most, levels, seed)
    names = docs.columns
    numbered = docs.toDF(*[f"__{i}" for i in range(len(names))])
    rows = numbered.select(
        F.struct("*").alias("row"),
        F.col(f"__{names.index('doc_id')}").alias("doc_id"),
        F.col(f"__{names.index('source')}").alias("source"),
    )
    copies = _drawn(rows, sources, dealt, seed).select("row", "doc_id", F.explode("copies").alias("copy"))
    local = spread(F.concat_ws(":", F.lit("local"), "copy.shard", "copy.epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))), seed)
    kept = [(i, n) for i, n in enumerate(names) if n not in ("epoch", "shard")]
    return (
        copies.withColumn("local", local)
        .repartitionByRange("copy.shard", "local")
        .sortWithinPartitions("copy.shard", "local")
        .select(*[F.col(f"row.__{i}").alias(n) for i, n in kept], "copy.epoch", "copy.shard")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With `copies`, what the splitting tree made of a document: pass and shard of each time that it is taken."""
    drawn = draw(table(spark, sf_dir, "documents"))
    copies = F.array_join(F.transform("copies", lambda c: F.concat_ws(":", c["epoch"], c["shard"])), ",")
    return drawn.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("copies")).alias("taken"), copies.alias("copies")
    )
