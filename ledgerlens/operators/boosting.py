"""Boosted trees for a 0/1 label, grown level by level from sums of gradients over quantile bins.

Each column is cut at quantiles; a row is its bins, bin 0 for a missing value. A level of a tree needs, for every
node, column and bin, how many rows there are and the sums of their gradients and curvatures: one group-by, whose
result has a size that the number of nodes, columns and bins sets, not the rows. From these the driver picks the splits;
for each, missing values go to the side that gains more.

Sums are taken in whole numbers of 2^-26, so they and the trees are the same however the rows are partitioned, and in
any rerun. The margins of all rows are written every few trees; jobs in between apply the trees since then.

A table of up to BLOCK_ROWS rows is a single block, as small as what a task of a larger table reads. Its levels take
a few milliseconds, much less than a job, so one job grows all its trees, from the same sums.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.files import folder_names, read_text, remove_folder, work_folder, write_text

# functions that tasks run travel with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: most bins of a column, the one for missing values aside
BINS = 254
#: gradients and curvatures are whole numbers of 1 / UNIT: sums over 10^11 rows fit a long
UNIT = 1 << 26
#: gains from here on count
LEAST_GAIN = 1e-6
#: most rows of a block; a table of more is summed up block by block, by as many tasks as it has blocks
BLOCK_ROWS = 1 << 18
#: bytes of the files that one task reads: about a block, at 16 bytes a row and those of its bins
BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class Settings:
    """How trees are grown.

    With `second_order`, splits maximise the gain in the second-order approximation of the loss, where a side needs
    curvature `least_weight`, and the first margin is 0. Without, they minimise the squared error of the gradients, and
    the first margin is that of the label's share. Leaves are one Newton step by `rate`; `penalty` is added to curvatures.
    """

    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    penalty: float = 1.0
    least_weight: float = 1.0
    second_order: bool = True


@dataclass
class Tree:
    """Nodes in the order of a heap: 0, its children 1 and 2, theirs 3 to 6. A node that is not split sends all rows left."""

    column: list[int]  # per inner node, -1 if not split
    bin: list[int]  # bins up to this one go left
    missing_left: list[bool]
    gain: list[float]
    leaf: list[float] = field(default_factory=list)


@dataclass
class Model:
    """Fitted trees over named columns; saved and loaded as text."""

    columns: list[str]
    cuts: list[list[float]]
    settings: Settings
    base: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def margin(self) -> Column:
        """The log odds that the label is 1, for rows with the model's columns."""
        cuts, trees, base = [np.array(c) for c in self.cuts], self.trees, self.base

        def margins(rows: pd.DataFrame) -> pd.Series:
            bins = binned([rows[c].to_numpy(float) for c in rows.columns], cuts)
            return pd.Series(base + applied(bins, trees))

        values = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(self.columns)]
        return F.pandas_udf(margins, "double")(F.struct(*values))

    def importance(self) -> dict[str, float]:
        """Mean gain of a column's splits, as a share of the sum over the columns."""
        sums, splits = np.zeros(len(self.columns)), np.zeros(len(self.columns))
        for tree in self.trees:
            for c, gain in zip(tree.column, tree.gain):
                if c >= 0:
                    sums[c] += gain
                    splits[c] += 1
        mean = sums / np.maximum(splits, 1)
        return dict(zip(self.columns, (mean / (mean.sum() or 1)).tolist()))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Model:
        given = json.loads(text)
        trees = [Tree(**t) for t in given.pop("trees")]
        return Model(settings=Settings(**given.pop("settings")), trees=trees, **given)

    def save(self, path: str) -> None:
        write_text(SparkSession.active(), path, self.to_json())

    @staticmethod
    def load(path: str) -> Model:
        return Model.from_json(read_text(SparkSession.active(), path))


def binned(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Bins of the rows, a column each: 0 if missing, else 1 and up, values up to and with a cut below it."""
    out = np.zeros((len(columns[0]), len(columns)), np.uint8)
    for i, (values, at) in enumerate(zip(columns, cuts)):
        out[:, i] = np.where(np.isnan(values), 0, 1 + np.searchsorted(at, values, "left"))
    return out


def reached(bins: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    """The node of each row after so many levels, counted from the left."""
    column, cut, left = np.array(tree.column), np.array(tree.bin), np.array(tree.missing_left)
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for level in range(levels):
        node = at + (1 << level) - 1
        value = bins[rows, column[node]]
        goes_left = np.where(value == 0, left[node], value <= cut[node]) | (column[node] < 0)
        at = 2 * at + ~goes_left
    return at


def applied(bins: np.ndarray, trees: list[Tree]) -> np.ndarray:
    out = np.zeros(len(bins))
    for tree in trees:
        out += np.array(tree.leaf)[reached(bins, tree, len(tree.leaf).bit_length() - 1)]
    return out


def _rows_of(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)
    return bins, batch.column("label").to_numpy(), batch.column("margin").to_numpy()


def _off(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and curvatures of the rows, in whole numbers."""
    chance = 1 / (1 + np.exp(-margin))
    return np.rint((chance - label) * UNIT), np.rint(chance * (1 - chance) * UNIT)


def _sums(rows: DataFrame, alone: bool, width: int, trees: list[Tree], tree: Tree, level: int) -> np.ndarray:
    """(node, column, bin, 3): rows, gradients and curvatures of the tree's nodes at this level.

    Rows that are read by one task `alone` are summed up there, without a shuffle.
    """
    shape = (1 << level, width, BINS + 2)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, math.prod(shape)), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            bins, label, margin = _rows_of(batch, width)
            gradients, curvatures = _off(margin + applied(bins, trees), label)
            node = reached(bins, tree, level)
            cells = (((node[:, None] * width + np.arange(width)) * shape[2]) + bins).ravel()
            for out, weights in zip(total, (None, gradients, curvatures)):
                spread = None if weights is None else np.repeat(weights, width)
                out += np.bincount(cells, spread, total.shape[1]).astype(np.int64)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(t[some]) for t in total]], ["cell", "n", "g", "h"])

    cells = rows.mapInArrow(partial, "cell long, n long, g long, h long")
    cells = cells.coalesce(1) if alone else cells
    summed = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h"))
    found = summed.toArrow()
    out = np.zeros((math.prod(shape), 3), np.int64)
    out[found["cell"].to_numpy()] = np.stack([found[c].to_numpy() for c in "ngh"], axis=1)
    return out.reshape(*shape, 3)


def _worth(sums: np.ndarray, settings: Settings) -> np.ndarray:
    """How much a side with these sums lowers the loss (times two), or the squared error."""
    n, g, h = sums[..., 0], sums[..., 1] / UNIT, sums[..., 2] / UNIT
    below = h + settings.penalty if settings.second_order else n
    return np.where(below > 0, g * g / np.where(below > 0, below, 1), 0.0)


def best_split(sums: np.ndarray, settings: Settings) -> tuple[int, int, bool, float] | None:
    """(column, bin, missing left, gain) of a node from its (column, bin) sums; None if nothing is gained.

    Equal gains go to the first column, the lowest bin, missing values to the right. Without missing values the side with
    more rows is theirs.
    """
    whole = sums[0].sum(axis=0)
    upto = np.cumsum(sums[:, 1:-1], axis=1)
    left = np.stack([upto, upto + sums[:, :1]], axis=2)  # missing right, missing left
    right = whole - left
    fine = (left[..., 0] > 0) & (right[..., 0] > 0)
    if settings.second_order:
        fine &= np.minimum(left[..., 2], right[..., 2]) >= settings.least_weight * UNIT
    gains = np.where(fine, _worth(left, settings) + _worth(right, settings) - _worth(whole, settings), -np.inf)
    at = int(gains.argmax())
    column, cut, missing_left = np.unravel_index(at, gains.shape)
    gain = float(gains.flat[at])
    if gain <= LEAST_GAIN:
        return None
    if not sums[column, 0, 0]:
        missing_left = left[column, cut, 0, 0] > right[column, cut, 0, 0]
    return int(column), int(cut) + 1, bool(missing_left), gain


def _leaf(sums: np.ndarray, settings: Settings) -> float:
    below = sums[2] / UNIT + (settings.penalty if settings.second_order else 0.0)
    return float(-sums[1] / UNIT / below * settings.rate) if below > 0 else 0.0


def grow(sums_of: Callable[[Tree, int], np.ndarray], settings: Settings) -> Tree:
    """One tree, from the sums of its nodes level by level."""
    inner = (1 << settings.depth) - 1
    tree = Tree([-1] * inner, [0] * inner, [False] * inner, [0.0] * inner, [0.0] * (inner + 1))
    for level in range(settings.depth):
        last = level + 1 == settings.depth
        for i, sums in enumerate(sums_of(tree, level)):
            if not sums[0, :, 0].any():
                continue
            node = (1 << level) - 1 + i
            found = best_split(sums, settings)
            whole = sums[0].sum(axis=0)
            if found is None:
                # all rows go left from here on
                tree.leaf[i << (settings.depth - level)] = _leaf(whole, settings)
                continue
            tree.column[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = found
            if last:
                column, cut, missing_left, _ = found
                left = sums[column, 1 : cut + 1].sum(axis=0) + (sums[column, 0] if missing_left else 0)
                tree.leaf[2 * i], tree.leaf[2 * i + 1] = _leaf(left, settings), _leaf(whole - left, settings)
    return tree


def _grown_in_block(rows: DataFrame, model: Model, every: int) -> list[Tree]:
    """All trees of a table of one block, by the task that reads it; margins move on every `every` trees, as when written."""
    width, settings = len(model.columns), model.settings

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [_rows_of(batch, width) for batch in batches if len(batch)]
        bins, label, margin = (np.concatenate(part) for part in zip(*read))
        cells = np.ascontiguousarray(bins.T).astype(np.int64)
        since = np.zeros(len(label))
        for done in range(settings.trees):
            if done and done % every == 0:
                margin, since = margin + since, np.zeros(len(label))
            weights = _off(margin + since, label)

            def sums_of(tree: Tree, level: int, weights: tuple[np.ndarray, ...] = weights) -> np.ndarray:
                first = reached(bins, tree, level) * (BINS + 2)
                size = (BINS + 2) << level
                out = np.empty((width, size, 3), np.int64)
                for column, bin in zip(out, cells):
                    at = first + bin
                    column[:, 0] = np.bincount(at, minlength=size)
                    for i, weight in enumerate(weights, 1):
                        column[:, i] = np.bincount(at, weight, size)
                return out.reshape(width, 1 << level, BINS + 2, 3).swapaxes(0, 1)

            tree = grow(sums_of, settings)
            since += applied(bins, [tree])
            yield pa.RecordBatch.from_pylist([{"number": done, "tree": json.dumps(asdict(tree))}])
            if not any(tree.leaf):
                # all further trees are this one
                return

    found = rows.coalesce(1).mapInArrow(grown, "number long, tree string").toArrow().sort_by("number")
    trees = [Tree(**json.loads(text)) for text in found["tree"].to_pylist()]
    return trees + trees[-1:] * (settings.trees - len(trees))


def quantile_cuts(df: DataFrame, columns: list[str], bins: int = BINS) -> list[list[float]]:
    """For each column the values up to which its bins go, all but the last bin's; by a sketch."""
    # one expression for all columns: a literal at a time takes seconds to make
    shares = F.expr(f"array({', '.join(f'{i / bins}D' for i in range(1, bins))})")
    values = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns]
    row = df.agg(
        *[F.percentile_approx(v, shares, 40 * bins).alias(f"q{i}") for i, v in enumerate(values)],
        *[F.max(v).alias(f"m{i}") for i, v in enumerate(values)],
    ).first()
    return [sorted({q for q in row[f"q{i}"] or [] if q < row[f"m{i}"]}) for i in range(len(columns))]


def fit(df: DataFrame, columns: list[str], label: str, settings: Settings, store: str | None = None, every: int = 20) -> Model:
    """Boosted trees on these columns, any of which may be missing; rows without a label are left out.

    With a folder `store`, the margins and the trees so far are kept there every `every` trees, and a call with the same
    folder goes on from the last ones kept, after a failure or for more trees. Without, a table of one block takes one job.
    No rows: no trees.
    """
    spark = df.sparkSession
    folder = store or work_folder(spark, "boosting")
    labelled = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("label"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    )
    names = [f"c{i}" for i in range(len(columns))]
    kept = sorted(int(n.removeprefix("trees-")) for n in folder_names(spark, folder) if n.startswith("trees-"))
    if kept:
        model = Model.load(f"{folder}/trees-{kept[-1]}")
        if model.columns != columns:
            raise ValueError(f"{folder} holds trees of other columns")
        model.settings = settings
    else:
        first, many = labelled.agg(F.avg("label"), F.count("label")).first()
        if first is None:
            return Model(columns, [[] for _ in columns], settings)
        base = 0.0 if settings.second_order or first in (0.0, 1.0) else math.log(first / (1 - first))
        cuts = quantile_cuts(labelled, names)
        model = Model(columns, cuts, settings, base)
        arrays = [np.array(c) for c in cuts]

        def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = binned([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], arrays)
                packed = pa.array([r.tobytes() for r in bins], pa.binary())
                yield pa.RecordBatch.from_arrays([packed, batch.column("label"), pa.array(np.full(len(bins), base))], ["bins", "label", "margin"])

        binned_rows = labelled.mapInArrow(to_bins, ROWS)
        if store is None and many <= BLOCK_ROWS:
            model.trees = _grown_in_block(binned_rows, model, every) if settings.trees else []
            return model
        _write(binned_rows, f"{folder}/rows-0")
        kept = [0]

    # the sums are small: one task adds them up, without planning anew as it goes
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "1")
    # small files share a task, however many cores there are
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.files.openCostInBytes", str(1 << 16))
    session.conf.set("spark.sql.files.maxPartitionBytes", str(BLOCK_BYTES))
    written = kept[-1]
    rows, alone = _read(session, f"{folder}/rows-{written}")
    width = len(columns)
    while len(model.trees) < settings.trees:
        since = model.trees[written:]
        tree = grow(lambda t, level: _sums(rows, alone, width, since, t, level), settings)
        model.trees.append(tree)
        if not any(tree.leaf):
            # nothing moves any more: all further trees are this one
            model.trees += [tree] * (settings.trees - len(model.trees))
        done = len(model.trees)
        if done - written >= every or done == settings.trees and store:
            new = model.trees[written:]

            def moved(batches: Iterator[pa.RecordBatch], new: list[Tree] = new) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if len(batch):
                        bins, _, margin = _rows_of(batch, width)
                        yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("label"), pa.array(margin + applied(bins, new))], ["bins", "label", "margin"])

            _write(rows.mapInArrow(moved, ROWS), f"{folder}/rows-{done}")
            if store:
                model.save(f"{folder}/trees-{done}")
            remove_folder(spark, f"{folder}/rows-{written}")
            written = done
            rows, alone = _read(session, f"{folder}/rows-{written}")
    if not store:
        remove_folder(spark, folder)
    return model


def _write(rows: DataFrame, path: str) -> None:
    """Files of at most a block, so that as many tasks can read them."""
    rows.write.mode("overwrite").option("maxRecordsPerFile", BLOCK_ROWS).parquet(path)


def _read(session: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """The rows, and whether one task reads them all."""
    rows = session.read.schema(ROWS).parquet(path)
    return rows, rows.rdd.getNumPartitions() == 1


ROWS = "bins binary, label double, margin double"
