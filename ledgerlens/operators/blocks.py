"""Cut large customers into blocks of ids, at ids sampled from their own rows.

A window over one customer runs in one task, and a single customer may hold a large part of the whole ledger. So rows are
sampled by a hash of customer and id; a customer with samples enough for two blocks is large, and is cut at every so
many of its sampled ids. Blocks thus have about the same number of rows however the ids are spread, and all other
customers stay whole. The sample is a function of the rows alone, so every use of it cuts alike, in reruns too; it is
never on the driver, and the plan is the same for any data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.ranges import with_place

# rows of a block, about: the most that one task sorts for one window is some two of them
BLOCK_ROWS = 4_000_000
# rows of a block that are sampled, at least one in BLOCK_ROWS: a block's size comes out within an eighth, mostly
SAMPLED = 64


def cuts(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(ss, cuts): the sorted ids at which a large customer's blocks start, but for the first.

    There are no more cuts than the ledger has blocks, 8 bytes each: a trillion rows have 2 MB of them.
    """
    each = min(SAMPLED, block_rows)
    sampled = ledger.where(F.col("ss").isNotNull() & (F.pmod(F.xxhash64("ss", "id"), F.lit(block_rows)) < each))
    ids = sampled.groupBy("ss").agg(F.sort_array(F.collect_list("id")).alias("ids")).where(F.size("ids") >= 2 * each)
    nth = F.sequence(F.lit(1), F.floor(F.size("ids") / each).cast("int") - 1)
    return ids.select("ss", F.transform(nth, lambda i: F.get("ids", i * each)).alias("cuts"))


def split(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary customers as they are, and those of large ones with a column `blk`, dealt out by it."""
    found = F.broadcast(cuts(ledger, block_rows))
    ordinary = ledger.join(found, "ss", "left_anti")
    large = with_place(ledger.join(found, "ss"), "id", "cuts", "blk").drop("cuts")
    # a ledger bucketed by customer would otherwise keep all blocks of a customer in one task
    return ordinary, large.repartition("ss", "blk")
