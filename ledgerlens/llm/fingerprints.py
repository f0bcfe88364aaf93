"""Fingerprints by locally consistent parsing: names of phrases whose borders depend on nearby text only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import pick, table

#: levels of phrases whose names go into the fingerprint, and slots for each level
LEVELS, SLOTS = (2, 3), 32
#: code points parsed at once
TOGETHER = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tossed(names: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Labels below 6, different next to each other: deterministic coin tossing against the left neighbour, four times.

    A symbol's label is the lowest bit in which it differs from the one to its left, and that bit; the first symbol of
    a text is compared with a fixed one.
    """
    labels = names
    for _ in range(4):
        left = np.empty_like(labels)
        left[1:] = labels[:-1]
        left[apart] = ~labels[apart]  # differs in the lowest bit
        differ = labels ^ left
        low = differ & (~differ + np.uint64(1))
        bit = np.bitwise_count(low - np.uint64(1)).astype(np.uint64)  # 64 if nothing differs
        labels = (bit << np.uint64(1)) | ((labels & low) != 0)
    return labels


def phrases(names: np.ndarray, apart: np.ndarray, piece: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """One level up: names of the phrases, and which of them start a text, where `apart` marks starts of texts.

    A run of one symbol counts as one symbol, so that neighbours differ; phrases open at local maxima of the labels.
    Runs twice as long as `piece` are cut into pieces of that length.
    """
    first = np.ones(len(names), bool)
    first[1:] = (names[1:] != names[:-1]) | apart[1:]
    runs = np.flatnonzero(first)
    lengths = np.diff(np.append(runs, len(names)))
    symbols = np.where(lengths > 1, _mix(names[runs] + lengths.astype(np.uint64)), names[runs])
    starts_text = apart[runs]
    labels = _tossed(symbols, starts_text).astype(np.int64)
    left, right = np.full(len(labels), -1), np.full(len(labels), -1)
    left[1:], right[:-1] = labels[:-1], labels[1:]
    right[:-1][starts_text[1:]] = -1
    opens = np.zeros(len(names), bool)
    opens[runs] = starts_text | ((labels > left) & (labels >= right))
    if (lengths >= 2 * piece).any():
        inside = np.arange(len(names)) - np.repeat(runs, lengths)
        opens |= (inside % piece == 0) & np.repeat(lengths >= 2 * piece, lengths)
    starts = np.flatnonzero(opens)
    place = np.arange(len(names)) - np.repeat(starts, np.diff(np.append(starts, len(names))))
    spread = _mix(names + np.uint64(0x9E3779B97F4A7C15) * (place + 1).astype(np.uint64))
    return _mix(np.add.reduceat(spread, starts)), apart[starts]


def _counted(names: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Names in which the second, third and so on occurrence within a text differ, so that repeats weigh in."""
    order = np.lexsort((names, text))
    same = np.zeros(len(names), bool)
    same[1:] = (names[order][1:] == names[order][:-1]) & (text[order][1:] == text[order][:-1])
    if not same.any():
        return names
    place = np.arange(len(names))
    nth = np.empty(len(names), np.uint64)
    nth[order] = place - np.maximum.accumulate(np.where(same, 0, place))
    return np.where(nth > 0, _mix(names + nth * np.uint64(0x9E3779B97F4A7C15)), names)


def signatures(texts: list[str], levels: tuple[int, ...] = LEVELS, slots: int = SLOTS) -> np.ndarray:
    """A row of 16-bit slots for each text: for each level and slot the least of its phrase names under a hash.

    Texts are parsed side by side; none sees its neighbours. An empty text has zeros.
    """
    out = np.zeros((len(texts), len(levels) * slots), np.uint16)
    some = [i for i, t in enumerate(texts) if t]
    if not some:
        return out
    points = np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le", "surrogatepass"), np.uint32)
    apart = np.zeros(len(points), bool)
    apart[np.cumsum([0] + [len(texts[i]) for i in some[:-1]])] = True
    names = _mix(points.astype(np.uint64) + np.uint64(1))
    rng = np.random.default_rng(9)
    for level in range(1, max(levels) + 1):
        names, apart = phrases(names, apart)
        if level in levels:
            starts = np.flatnonzero(apart)
            counted = _counted(names, np.cumsum(apart))
            at = levels.index(level) * slots
            for slot in range(slots):
                odd, plus = (np.uint64(int(v)) for v in rng.integers(1, 1 << 63, 2))
                hashed = (counted ^ plus) * (odd | np.uint64(1))
                least = np.minimum.reduceat(hashed ^ (hashed >> np.uint64(32)), starts)
                out[some, at + slot] = (least >> np.uint64(40)).astype(np.uint16) | np.uint16(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all phrases of both, repeats counted, the share that both have: 2 s / (1 + s) for a share s of equal slots.

    Equal slots are as frequent as common phrases among different ones.
    """
    equal = (a == b).mean(axis=1)
    return 2 * equal / (1 + equal)


_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows for all texts but the last, which is there as the next one."""
    edited = []
    for text, following in zip(texts, texts[1:]):
        cut = len(text) // 4
        edited.append(text[: len(text) - cut] + following[:cut])
    own, new = signatures(texts), signatures(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[: len(edited)], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([row.astype(">u2").tobytes().hex() for row in own[:-1]], pa.string()),
            pa.array([row.astype(">u2").tobytes().hex() for row in new], pa.string()),
            pa.array(likeness(own[:-1], new)),
            pa.array(likeness(own[:-1], own[1:])),
        ],
        schema=_OUT,
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, own rows before the guest that follows them; a range's rows meet in pieces of bounded size."""
    ids: list = []
    texts: list[str] = []
    held, size, closed = None, 0, False
    for batch in batches:
        for in_range, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "text"))):
            if in_range != held:
                ids, texts, held, size, closed = [], [], in_range, 0, False
            if closed:  # other rows with the guest's doc_id
                continue
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            closed = guest == 1
            if len(texts) > 1 and (closed or size > TOGETHER):
                yield _compared(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(text)


def neighbour_fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter comes from the next document.

    Documents are dealt by doc_id into `ranges` (four times the shuffle partitions), sorted there, and read once in
    order, a piece at a time; the first document of a range is sent to the range before as well, that of the first to
    the last. Null text: empty, with a fingerprint of zeros, alike to other empty ones only. Null doc_id: in front.
    Rows with one doc_id go by their text. A single document is its own next one. No documents: no rows. Only doc_id
    and text are looked at.
    """
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] if ranges > 1 else []
    edges = [float("-inf"), *sorted({float(c) for c in cuts or []}), float("inf")]
    dealt = Bucketizer(splits=edges, inputCol="at", outputCol="range") if len(edges) > 2 else None
    rows = rows.withColumn("at", F.col("key").cast("double"))
    rows = (dealt.transform(rows) if dealt else rows.withColumn("range", F.lit(0.0))).withColumn("range", F.col("range").cast("int"))
    # one number a range
    firsts = sorted((r["range"], r["least"]) for r in rows.groupBy("range").agg(F.min("key").alias("least")).collect())
    before = [(least, firsts[i - 1][0]) for i, (_, least) in enumerate(firsts)]
    guests = spark.createDataFrame(before, "first long, to int")
    marked = rows.join(F.broadcast(guests), F.col("key") == F.col("first"), "left")
    places = F.array(F.struct(F.col("range"), F.lit(0).alias("guest")), F.struct(F.col("to").alias("range"), F.lit(1).alias("guest")))
    sent = marked.select("key", "doc_id", "text", F.explode(F.filter(places, lambda p: p["range"].isNotNull())).alias("p"))
    return (
        sent.select("p.range", "p.guest", "key", "doc_id", "text")
        .repartition("range")
        .sortWithinPartitions("range", "guest", "key", "text")
        .select("range", "guest", "doc_id", "text")
        .mapInArrow(_neighbours, _SCHEMA)
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))
