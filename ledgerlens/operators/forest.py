"""A forest for a 0/1 label: trees on bootstrapped rows that grow until leaves are pure, over quantile bins.

A tree takes each row as often as a Poisson draw says, hashed from tree and row. A node looks at some columns, drawn by a
hash of tree and node among those that vary there, and splits where the Gini impurity falls most. Nodes of more than
BLOCK_ROWS rows are split level by level: partial counts per node, column and bin meet in a group-by, and tasks pick the
splits. The rows of each smaller node are then brought together, and a task grows all that is below. So a group never
has more than a block, and trees do not depend on where the change is made.
"""

from __future__ import annotations

import base64
import json
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.boosting import binned, quantile_cuts
from ledgerlens.sources.files import remove_folder, work_folder

# functions that tasks run travel with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: most rows of a node that a task grows on its own
BLOCK_ROWS = 1 << 18
#: bins of a column, the one for missing values included
BINS = 256
#: nodes whose counts a task holds at once: about 50 MB for a dozen columns
HELD = 1000
#: chance of at most 0, 1, 2, ... in a Poisson draw of mean 1
_UPTO = np.cumsum([np.exp(-1.0)] + [np.exp(-1.0) / f for f in np.cumprod(np.arange(1.0, 16.0))])


@dataclass
class Tree:
    """Nodes from the root on; the right child follows the left one. A leaf has column -1."""

    column: np.ndarray
    bin: np.ndarray  # bins up to this one go left
    left: np.ndarray
    chance: np.ndarray
    gain: np.ndarray  # by column

    @staticmethod
    def leaf(chance: float, width: int) -> Tree:
        return Tree(np.array([-1], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32), np.array([chance]), np.zeros(width))

    def packed(self) -> bytes:
        return zlib.compress(b"".join([np.int64(len(self.column)).tobytes(), *[getattr(self, name).tobytes() for name in KINDS]]))

    @staticmethod
    def unpacked(data: bytes) -> Tree:
        data = zlib.decompress(data)
        n, at, parts = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
        for name, kind in KINDS.items():
            parts.append(np.frombuffer(data, kind, -1 if name == "gain" else n, at).copy())
            at += parts[-1].nbytes
        return Tree(*parts)

    def chances(self, bins: np.ndarray) -> np.ndarray:
        at, open_rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            open_rows = open_rows[self.column[at[open_rows]] >= 0]
            if not len(open_rows):
                return self.chance[at]
            node = at[open_rows]
            at[open_rows] = self.left[node] + (bins[open_rows, self.column[node]] > self.bin[node])


KINDS = {"column": np.int16, "bin": np.uint8, "left": np.int32, "chance": np.float64, "gain": np.float64}


@dataclass
class Forest:
    """Fitted trees over named columns; saved and loaded as text."""

    columns: list[str]
    cuts: list[list[float]]
    trees: list[Tree] = field(default_factory=list)

    def chance(self, inputs: Column | None = None) -> Column:
        """The chance that the label is 1, the mean of the trees' leaves, for rows with the model's columns or a struct of these."""
        cuts, trees = [np.array(c) for c in self.cuts], self.trees

        def chances(rows: pd.DataFrame) -> pd.Series:
            bins = binned([rows[c].to_numpy(float) for c in rows.columns], cuts)
            return pd.Series(sum((t.chances(bins) for t in trees), np.zeros(len(bins))) / max(1, len(trees)))

        values = F.struct(*[F.col(c).cast("double").alias(c) for c in self.columns]) if inputs is None else inputs
        return F.pandas_udf(chances, "double")(values)

    def importance(self) -> dict[str, float]:
        """A column's share of what a tree's splits gain, on average."""
        shares = sum((t.gain / (t.gain.sum() or 1) for t in self.trees), np.zeros(len(self.columns)))
        return dict(zip(self.columns, (shares / (shares.sum() or 1)).tolist()))

    def to_json(self) -> str:
        trees = [base64.b64encode(t.packed()).decode() for t in self.trees]
        return json.dumps({"columns": self.columns, "cuts": self.cuts, "trees": trees})

    @staticmethod
    def from_json(text: str) -> Forest:
        given = json.loads(text)
        return Forest(given["columns"], given["cuts"], [Tree.unpacked(base64.b64decode(t)) for t in given["trees"]])


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of whole numbers, element by element."""
    x = np.zeros(1, np.uint64)
    for part in parts:
        x = (x ^ np.asarray(part).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return x


def drawn(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the tree takes each row."""
    return np.searchsorted(_UPTO, (_mixed(seed, tree, rows) >> np.uint64(11)) / float(1 << 53), "right").astype(np.uint8)


def best_split(counts: np.ndarray, varying: np.ndarray, order: np.ndarray, tries: int) -> tuple[int, int, float] | None:
    """(column, bin, gain) from the (column, bin, 2) numbers of rows and of ones; None if no column varies.

    The first `tries` columns in the given order that vary are looked at. Equal gains go to the earliest, the lowest bin.
    """
    chosen = order[varying[order]][:tries]
    if not len(chosen):
        return None
    return _best_of(chosen, *np.moveaxis(counts[chosen], 2, 0).astype(float))


def _best_of(chosen: np.ndarray, rows: np.ndarray, ones: np.ndarray) -> tuple[int, int, float]:
    n, p = rows.cumsum(1), ones.cumsum(1)
    all_n, all_p = n[0, -1], p[0, -1]
    n, p = n[:, :-1], p[:, :-1]
    fine = (rows[:, :-1] > 0) & (n < all_n)
    n_left, n_right = np.where(fine, n, 1.0), np.where(fine, all_n - n, 1.0)
    p_right = all_p - p
    # rows times purity of both sides: (p^2 + (n - p)^2) / n = n - 2 p (n - p) / n
    mixed = p * (n_left - p) / n_left + p_right * (n_right - p_right) / n_right
    at = int(np.where(fine, mixed, np.inf).argmin())
    column, cut = divmod(at, n.shape[1])
    gain = all_p * (all_n - all_p) / all_n - mixed[column, cut]
    return int(chosen[column]), cut, float(max(0.0, gain))


def grown(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, node: int, depth: int, tries: int, tree: int, seed: int) -> Tree:
    """All that is below a node, from its rows."""
    width = bins.shape[1]
    weight = weight.astype(float)
    ones, step, columns = weight * label, np.arange(tries) * BINS, np.arange(width)
    column, cut, left, chance, gain = [-1], [0], [0], [0.0], np.zeros(width)
    todo = [(0, node, depth, np.arange(len(bins)))]
    while todo:
        slot, heap, levels, rows = todo.pop()
        w, p = weight[rows], ones[rows]
        n, positive = w.sum(), p.sum()
        chance[slot] = float(positive / n)
        if not levels or positive == 0 or positive == n:
            continue
        here = bins[rows]
        varying = (here != here[0]).any(axis=0)
        order = np.argsort(_mixed(seed, tree, heap, columns), kind="stable")
        chosen = order[varying[order]][:tries]
        if not len(chosen):
            continue
        k = len(chosen)
        cells = (here[:, chosen] + step[:k]).ravel()
        counts = [np.bincount(cells, np.repeat(v, k), k * BINS).reshape(k, BINS) for v in (w, p)]
        at, upto, won = _best_of(chosen, *counts)
        gain[at] += won
        column[slot], cut[slot], left[slot] = at, upto, len(column)
        goes_left = here[:, at] <= upto
        for child, side in ((1, goes_left), (2, ~goes_left)):
            todo.append((len(column), 2 * heap + child, levels - 1, rows[side]))
            column.append(-1), cut.append(0), left.append(0), chance.append(0.0)
    return Tree(np.array(column, np.int16), np.array(cut, np.uint8), np.array(left, np.int32), np.array(chance), gain)


@dataclass
class Top:
    """The nodes of a tree down to blocks, numbered as in a heap: their splits, and the leaves among them."""

    splits: dict[int, tuple[int, int, float]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def reached(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row comes to, a block or a leaf."""
        at = np.zeros(len(bins), np.int64)
        if not self.splits:
            return at
        nodes = np.array(sorted(self.splits))
        column, cut = (np.array([self.splits[n][i] for n in nodes]) for i in (0, 1))
        rows = np.arange(len(bins))
        while len(rows):
            found = np.minimum(np.searchsorted(nodes, at[rows]), len(nodes) - 1)
            known = nodes[found] == at[rows]
            rows, found = rows[known], found[known]
            at[rows] = 2 * at[rows] + 1 + (bins[rows, column[found]] > cut[found])
        return at

    def whole(self, below: dict[int, Tree], width: int) -> Tree:
        """The tree with what is below each node."""
        parts: dict[str, list] = {name: [np.zeros(1, kind)] for name, kind in KINDS.items() if name != "gain"}
        gain, size, todo, fixed = np.zeros(width), 1, [(0, 0)], []
        while todo:
            node, slot = todo.pop()
            if node in self.splits:
                column, cut, won = self.splits[node]
                gain[column] += won
                fixed.append((slot, column, cut, size, 0.0))
                todo += [(2 * node + 1, size), (2 * node + 2, size + 1)]
                for name in parts:
                    parts[name].append(np.zeros(2, KINDS[name]))
                size += 2
                continue
            # a node that no drawn row comes to cannot be: splits leave rows on both sides
            tree = below[node] if node in below else Tree.leaf(self.leaves[node], width)
            gain += tree.gain
            # its root takes the slot, the other nodes come at the end
            left = np.where(tree.column >= 0, tree.left + (size - 1), 0).astype(np.int32)
            fixed.append((slot, tree.column[0], tree.bin[0], left[0], tree.chance[0]))
            for name, values in (("column", tree.column), ("bin", tree.bin), ("left", left), ("chance", tree.chance)):
                parts[name].append(values[1:])
            size += len(tree.column) - 1
        out = Tree(*[np.concatenate(parts[name]) for name in parts], gain)
        for slot, column, cut, left, chance in fixed:
            out.column[slot], out.bin[slot], out.left[slot], out.chance[slot] = column, cut, left, chance
        return out


def _batch(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    return batch.column("id").to_numpy(), bins, batch.column("label").to_numpy()


def _by_node(at: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each node that drawn rows come to, and these rows in their order. One sort, however many nodes there are."""
    rows = np.flatnonzero(weight)
    rows = rows[np.argsort(at[rows], kind="stable")]
    nodes, first = np.unique(at[rows], return_index=True)
    return zip(nodes.tolist(), np.split(rows, first[1:]))


def _counts(
    batches: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], tops: list[Top], active: set[tuple[int, int]], width: int, seed: int
) -> Iterator[dict[tuple[int, int], np.ndarray]]:
    """Numbers of rows and of ones per column and bin of the active nodes, given whenever HELD nodes are counted."""
    trees, held = sorted({t for t, _ in active}), {}
    for ids, bins, label in batches:
        for t in trees:
            weight, at = drawn(ids, t, seed), tops[t].reached(bins)
            for node, here in _by_node(at, weight):
                if (t, node) not in active:
                    continue
                cells = (bins[here] + np.arange(width) * BINS).ravel()
                sums = [np.bincount(cells, np.repeat(w, width), width * BINS) for w in (weight[here].astype(float), weight[here] * label[here])]
                some = np.stack(sums, axis=1).astype(np.int64)
                held[t, node] = held[t, node] + some if (t, node) in held else some
                if len(held) >= HELD:
                    yield held
                    held = {}
    if held:
        yield held


def _splits(rows: DataFrame, tops: list[Top], active: set[tuple[int, int]], width: int, tries: int, seed: int) -> pa.Table:
    """(tree, node, column, bin, gain, and rows and ones of the whole and its left side) of the active nodes; column -1: none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _counts((_batch(b, width) for b in batches if len(b)), tops, active, width, seed):
            names = [pa.array([k[i] for k in held], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*names, pa.array([v.tobytes() for v in held.values()], pa.binary())], ["tree", "node", "counts"])

    def picked(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((width, BINS, 2), np.int64)
        for part in parts:
            for data in part.column("counts").to_pylist():
                counts += np.frombuffer(data, np.int64).reshape(counts.shape)
        tree, node = (k.as_py() for k in key)
        n, ones = counts[0].sum(axis=0).tolist()
        order = np.argsort(_mixed(seed, tree, node, np.arange(width)), kind="stable")
        found = best_split(counts, (counts[:, :, 0] > 0).sum(axis=1) > 1, order, tries)
        column, cut, gain = found or (-1, 0, 0.0)
        n_left, ones_left = counts[column, : cut + 1].sum(axis=0).tolist()
        line = dict(tree=tree, node=node, column=column, bin=cut, gain=gain, n=n, ones=ones, n_left=n_left, ones_left=ones_left)
        yield pa.RecordBatch.from_pylist([line])

    partial = rows.mapInArrow(counted, "tree long, node long, counts binary")
    schema = "tree long, node long, column long, bin long, gain double, n long, ones long, n_left long, ones_left long"
    return partial.groupBy("tree", "node").applyInArrow(picked, schema).toArrow()


def _below(rows: DataFrame, tops: list[Top], width: int, depth: int, tries: int, seed: int) -> pa.Table:
    """(tree, node, grown): what is below each node of at most a block."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            ids, bins, label = _batch(batch, width)
            for t, top in enumerate(tops):
                weight, at = drawn(ids, t, seed), top.reached(bins)
                lines = []
                for node, here in _by_node(at, weight):
                    if node not in top.leaves:
                        data = np.column_stack([bins[here], label[here].astype(np.uint8), weight[here]])
                        lines.append({"tree": t, "node": node, "data": data.tobytes()})
                if lines:
                    yield pa.RecordBatch.from_pylist(lines, pa.schema({"tree": pa.int64(), "node": pa.int64(), "data": pa.binary()}))

    def finished(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = b"".join(d for part in parts for d in part.column("data").to_pylist())
        here = np.frombuffer(data, np.uint8).reshape(-1, width + 2)
        tree, node = (k.as_py() for k in key)
        level = (node + 1).bit_length() - 1
        done = grown(here[:, :width], here[:, width], here[:, width + 1], node, depth - level, tries, tree, seed)
        yield pa.RecordBatch.from_pylist([{"tree": tree, "node": node, "grown": done.packed()}])

    parts = rows.mapInArrow(dealt, "tree long, node long, data binary")
    return parts.groupBy("tree", "node").applyInArrow(finished, "tree long, node long, grown binary").toArrow()


def fit(df: DataFrame, columns: list[str], label: str, trees: int = 100, depth: int = 30, seed: int = 0) -> Forest:
    """Trees on these columns; rows without a label are left out. A node looks at the square root of the columns, rounded up.

    No rows: no trees.
    """
    spark = df.sparkSession
    folder = work_folder(spark, "forest")
    width, tries = len(columns), int(np.ceil(np.sqrt(len(columns))))
    names = [f"c{i}" for i in range(width)]
    labelled = df.where(F.col(label).isNotNull()).select(
        F.monotonically_increasing_id().alias("id"), F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)]
    )
    cuts = quantile_cuts(labelled, names)
    arrays = [np.array(c) for c in cuts]

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], arrays)
            packed = pa.array([r.tobytes() for r in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed, batch.column("label")], ["id", "bins", "label"])

    # written once: a row keeps its id, and so its draws, through all passes
    schema = "id long, bins binary, label double"
    labelled.mapInArrow(to_bins, schema).write.option("maxRecordsPerFile", BLOCK_ROWS).parquet(folder)
    # groups are few and dear: they are not put together by the size of their rows
    session: SparkSession = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", str(2 * max(trees, spark.sparkContext.defaultParallelism)))
    # counts of a node, 4 kB a column, go out once for each batch at worst: batches of a block, not of the usual 10,000 rows
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    rows = session.read.schema(schema).parquet(folder)
    many = rows.count()
    if not many:
        return Forest(columns, cuts)
    tops = [Top() for _ in range(trees)]
    active = {(t, 0) for t in range(trees)} if many > BLOCK_ROWS else set()
    while active:
        found, active = _splits(rows, tops, active, width, tries, seed), set()
        for line in found.to_pylist():
            t, node, top = line["tree"], line["node"], tops[line["tree"]]
            level = (node + 1).bit_length() - 1
            if line["column"] < 0 or level == depth or line["ones"] in (0, line["n"]):
                top.leaves[node] = line["ones"] / line["n"]
                continue
            top.splits[node] = line["column"], line["bin"], line["gain"]
            if max(line["n_left"], line["n"] - line["n_left"]) > BLOCK_ROWS:
                active |= {(t, 2 * node + i) for i, n in ((1, line["n_left"]), (2, line["n"] - line["n_left"])) if n > BLOCK_ROWS}
    below: list[dict[int, Tree]] = [{} for _ in tops]
    for line in _below(rows, tops, width, depth, tries, seed).to_pylist():
        below[line["tree"]][line["node"]] = Tree.unpacked(line["grown"])
    # a tree that draws no row, as one of few rows may, has nothing to say
    done = [top.whole(under, width) for top, under in zip(tops, below) if top.splits or top.leaves or under]
    remove_folder(spark, folder)
    return Forest(columns, cuts, done)
