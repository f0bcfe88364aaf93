"""Drawing documents by how much likelier a target corpus makes their words: hashed runs of words, counted and scored."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pick, table, written

BUCKETS = 10_000
#: bytes of texts scanned at once; a longer text is scanned in pieces
TOGETHER = 1 << 22
#: The reversed polynomial of the usual CRC of 32 bits
POLYNOMIAL = 0xEDB88320

#: A-Z in lower case, every other ASCII byte but digits and letters a space; bytes of longer characters stay
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: between texts: no text holds it any more, so it is a word of its own
MARK = b"\x01"


def _byte_step() -> np.ndarray:
    """What a byte of zeros makes of a checksum, by its lowest byte."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, step >> 1 ^ np.uint32(POLYNOMIAL), step >> 1)
    return step


class Shifts:
    """What a number of bytes of zeros makes of a checksum: linear in its bits, so four tables by its bytes do.

    The checksum of two strings one after the other is that of the first, shifted by the length of the second, xor that
    of the second.
    """

    def __init__(self) -> None:
        step = _byte_step()
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self.powers = [(bits >> np.uint32(8)) ^ step[bits & np.uint32(255)]]  # images of the bits, by 1, 2, 4, ... bytes
        self.tables: dict[int, np.ndarray] = {}

    @staticmethod
    def _apply(images: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for i in range(32):
            out ^= np.where(x >> np.uint32(i) & np.uint32(1), images[i], np.uint32(0))
        return out

    def _table(self, n: int) -> np.ndarray:
        if n not in self.tables:
            if len(self.tables) > 4096:
                self.tables.clear()
            images, k, left = np.uint32(1) << np.arange(32, dtype=np.uint32), 0, n
            while left:
                if k == len(self.powers):
                    self.powers.append(self._apply(self.powers[-1], self.powers[-1]))
                if left & 1:
                    images = self._apply(self.powers[k], images)
                left, k = left >> 1, k + 1
            low = np.arange(256, dtype=np.uint32)
            self.tables[n] = np.stack([self._apply(images, low << np.uint32(8 * b)) for b in range(4)])
        return self.tables[n]

    def __call__(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The checksums, each shifted by so many bytes."""
        if not len(sums):
            return sums
        known, at = np.unique(lengths, return_inverse=True)
        tables = np.stack([self._table(int(n)) for n in known])
        out = tables[at, 0, sums & np.uint32(255)]
        for b in range(1, 4):
            out ^= tables[at, b, sums >> np.uint32(8 * b) & np.uint32(255)]
        return out


def _pieces(texts: list[str]) -> Iterator[bytes]:
    """The texts in plain bytes, the mark after each, in pieces of about `TOGETHER` bytes cut between words."""
    parts: list[bytes] = []
    size = 0
    for text in texts:
        plain = text.encode("utf-8", "replace").translate(PLAIN) + b" " + MARK + b" "
        start = 0
        while start < len(plain):
            end = len(plain)
            if size + end - start > TOGETHER:
                # at the last space that fits, or if a word is longer than that, after it
                end = plain.rfind(b" ", start, start + max(1, TOGETHER - size)) + 1 or plain.find(b" ", start + max(1, TOGETHER - size)) + 1
            parts.append(plain[start:end])
            size += end - start
            start = end
            if size >= TOGETHER or start < len(plain):
                yield b"".join(parts)
                parts, size = [], 0
    if parts:
        yield b"".join(parts)


def scan(texts: list[str], shifts: Shifts, runs: int = 2, modulus: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, buckets): of all runs of k words, 1 to `runs`, piece by piece; places say which text a run is in.

    Every word of a piece is summed up once, whichever text it is in; the checksums of neighbours make that of a run.
    Marks are words as well, and runs with a mark are left out. The last words of a piece are carried over to the next.
    """
    sums, lengths, text = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    for piece in _pieces(texts):
        # the last words before, for runs that go on
        held = min(len(sums), runs - 1)
        before = len(sums) - held
        words = piece.split()
        sums = np.concatenate([sums[before:], np.fromiter(map(zlib.crc32, words), np.uint32, len(words))])
        lengths = np.concatenate([lengths[before:], np.fromiter(map(len, words), np.int64, len(words))])
        # no other word of one byte has the mark's checksum
        marks = (lengths == len(MARK)) & (sums == _MARK_SUM)
        places = text + np.cumsum(marks) - np.count_nonzero(marks[:held])
        run, whole = sums, ~marks
        for k in range(1, runs + 1):
            if k > 1:
                # a run of one word less, a space and the word after it
                run = shifts(_space(run[:-1]), lengths[k - 1 :]) ^ sums[k - 1 :]
                whole = whole[:-1] & ~marks[k - 1 :]
            # those that end in this piece
            new = max(0, held - k + 1)
            some = whole[new:]
            yield k, places[k - 1 + new :][some], run[new:][some] % modulus
        text = int(places[-1]) if len(places) else text


def buckets(texts: list[str], shifts: Shifts, runs: int = 2, modulus: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, words, buckets): of every text's runs of 1 to `runs` words, piece by piece and a length of run at a time.

    Words are counted along with the runs of one word; a long text has several pieces.
    """
    for k, places, found in scan(texts, shifts, runs, modulus):
        starts = np.flatnonzero(np.diff(places, prepend=-1))
        for text, some in zip(places[starts].tolist(), np.split(found, starts[1:])):
            yield text, len(some) if k == 1 else 0, some


_STEP = _byte_step()
_SPACE = zlib.crc32(b" ")
_MARK_SUM = zlib.crc32(MARK)


def _space(sums: np.ndarray) -> np.ndarray:
    """Checksums after one more byte, a space."""
    return (sums >> np.uint32(8)) ^ _STEP[sums & np.uint32(255)] ^ np.uint32(_SPACE)


def _batches(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """Some rows at a time: the first one's place, and their texts."""
    texts: list[str] = []
    size = start = 0
    for i, text in enumerate(batch.column(column)):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER or i + 1 == len(batch):
            yield start, texts
            texts, size, start = [], 0, i + 1


def counts(docs: DataFrame, runs: int = 2, modulus: int = BUCKETS) -> DataFrame:
    """bucket and n: how many runs of 1 to `runs` words of all texts fall into each bucket; those with none have no row.

    Each task counts its own texts and gives a row a bucket. Null and empty texts have no words. Only text is looked at.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts, n = Shifts(), np.zeros(modulus, np.int64)
        for batch in batches:
            for _, texts in _batches(batch, "text"):
                for _, _, found in scan(texts, shifts, runs, modulus):
                    n += np.bincount(found, minlength=modulus)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], ["bucket", "n"])

    return pick(docs, "text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, modulus: int = BUCKETS) -> np.ndarray:
    """For each bucket 1000 times the logarithm of how much likelier the target is to fill it, one more in each; floored.

    `corpus` and `target` are counts; `modulus` rows at most come to the driver.
    """
    n = np.zeros((2, modulus), np.int64)
    for i, side in enumerate((corpus, target)):
        for r in side.collect():
            n[i, r["bucket"]] = r["n"]
    more_s, more_t = (float(total + modulus) for total in n.sum(axis=1).tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * more_s / ((s + 1.0) * more_t))) for s, t in n.T.tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, runs: int = 2) -> DataFrame:
    """doc_id, n_words, n_features, weight: the number of a text's words and runs, and its runs' mean gain, floored."""

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for batch in batches:
            for start, texts in _batches(batch, "text"):
                words, n, total = np.zeros((3, len(texts)), np.int64)
                for k, places, found in scan(texts, shifts, runs, len(gain)):
                    more = np.bincount(places, minlength=len(texts))
                    words += more if k == 1 else 0
                    n += more
                    # sums of whole numbers far below 2^53
                    total += np.bincount(places, gain[found], len(texts)).astype(np.int64)
                out = [batch.column("doc_id").slice(start, len(texts)), *map(pa.array, (words, n, total // np.maximum(n, 1)))]
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "n_features", "weight"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(weights, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A number from the extreme value distribution for a doc_id, by 1000 and floored: sorting by a logarithmic weight
    with it added draws without replacement in proportion to the weights."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, words: int = 20, runs: int = 2, modulus: int = BUCKETS, seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every document.

    The texts' runs of 1 to `runs` words are hashed into buckets. A bucket's gain is by how much likelier the texts of
    `target` fill it than those of `docs`; a document's weight is the mean gain of its runs, its score the weight with
    `noise` added. Of the documents with at least `words` words `percent` hundredths are drawn, the highest scores
    first, equal ones by doc_id; `rank` numbers them and is null for others.

    Scores are whole numbers between bounds that the hash and the logarithm of the corpus's size set, less than a hundred
    thousand of them, so the counts by score go to the driver and come back as the place at which each score starts.
    Within a score, documents are numbered by doc_id; rows that are equal in everything are counted first and numbered
    together.

    Null and empty texts have no words and weigh 0. Null doc_id: hashed as an empty one, last among equals. Rows that share a
    doc_id are documents of their own. No documents: no rows; no target: every bucket counts one. Of the documents
    only doc_id and text are looked at, of the target only text.
    """
    gain = gains(counts(docs, runs, modulus), counts(target, runs, modulus), modulus)
    scored = written(weigh(docs, gain, runs).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    spark = docs.sparkSession
    enough = scored.where(F.col("n_words") >= words)
    sizes = sorted(((r["score"], r["n"]) for r in enough.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    want = percent * sum(n for _, n in sizes) // 100
    places, before = [], 0
    for score, n in sizes:
        if before >= want:
            break
        places.append((score, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(places, "place long, before long"))
    placed = scored.join(starts, (F.col("n_words") >= words) & (F.col("score") == F.col("place")), "left")
    columns = ["doc_id", "n_features", "weight", "score"]
    equal = placed.where(F.col("before").isNotNull()).groupBy(*columns, "before").agg(F.count("*").alias("copies"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("before") + F.sum("copies").over(order)
    numbered = equal.withColumn("last", last).select(*columns, F.explode(F.sequence(F.col("last") - F.col("copies") + 1, "last")).alias("rank"))
    drawn = numbered.withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")))
    return drawn.union(placed.where(F.col("before").isNull()).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
