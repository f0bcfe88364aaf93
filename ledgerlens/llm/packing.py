"""Packing documents into token sequences of a fixed length: exact complements first, then best fit."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pick, table, written

LIMIT = 2048
PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"
#: words whose ids a task remembers, and the longest such word
REMEMBERED, REMEMBERED_LENGTH = 600_000, 60
END = "\0"


class WordTokens:
    """Ids of texts by a vocabulary of byte pairs with word ends, as the `tokenizers` library gives them.

    Such a vocabulary drops white space and joins nothing across it, so a text's ids are those of its words one after
    the other, looked up once a word. New words of plain Latin letters, a great many, go to `tiktoken` in one call a
    batch: cut by the pattern of the vocabulary, each part closed by a 0 byte that stands for its word end, which
    merges in the same order. Any other word goes to `tokenizers`.
    """

    # the vocabulary's pattern, for lower-case text of these characters
    PLAIN = re.compile("[!-~\xa1-\xff]*")
    LETTER, NUMBER = r"a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
    PART = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+")

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            model = json.load(f)["model"]
        if model.get("end_of_word_suffix") != "</w>" or len(model["vocab"]) > 1 << 16:
            raise ValueError("a vocabulary of byte pairs with word ends is needed, of 65,536 ids at most")
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {}
        self.ends = np.zeros(1 << 16, bool)
        for token, i in model["vocab"].items():
            if token not in special:
                last = token.endswith("</w>")
                ranks[bytes(byte_of[c] for c in token.removesuffix("</w>")) + b"\0" * last] = i
                self.ends[i] = last
        self.pairs = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        texts = b"\n".join(words).decode().split("\n")
        plain = [t for t in texts if self.PLAIN.fullmatch(t) and "<|" not in t]
        marked = self.PART.sub(r"\g<0>" + END, "\n".join(plain).lower())
        ids = np.array(self.pairs.encode_ordinary(marked.replace("\n", "")), "<u2")
        # a word ends with the last of its parts
        parts = np.cumsum([line.count(END) for line in marked.split("\n")])
        upto = (2 * np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])[parts]).tolist()
        buffer = ids.tobytes()
        found = dict(zip(plain, [buffer[i:j] for i, j in zip([0, *upto], upto)]))
        other = [t for t in texts if t not in found]
        for text, e in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False)):
            found[text] = np.array(e.ids, "<u2").tobytes()
        self.known.update(zip(words, [found[t] for t in texts]))

    def ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian 16-bit numbers."""
        known = self.known
        words_of = [t.encode().split() for t in texts]  # at space and the control characters 9 to 13
        new = set().union(*words_of).difference(known)
        if len(known) + len(new) > REMEMBERED and len(known) > REMEMBERED // 2:
            known.clear()
            new = set().union(*words_of)
        if new:
            self._learn(list(new))
        for words in words_of:
            yield b"".join([known[w] for w in words])
        for w in new:
            if len(w) > REMEMBERED_LENGTH:
                del known[w]


def encode(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids (unsigned little-endian 32-bit), part, nth.

    A document is its ids and a closing 0. One longer than `limit` is cut into pieces of `limit`, the last maybe
    shorter. `nth` numbers the pieces of one length within the partition `part`. Null text counts as empty: the piece
    (0). Null or repeated doc_id, repeated rows: pieces of their own. Only doc_id and text are looked at.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer)
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            part = batch.column("part")[0].as_py() if len(batch) else 0
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), _ids(tokens, batch.column("text"))):
                whole = np.frombuffer(ids + b"\0\0", "<u2").astype("<u4")
                for piece, start in enumerate(range(0, len(whole), limit)):
                    cut = whole[start : start + limit]
                    rows.append((doc_id, piece, start, len(cut), cut.tobytes(), part, int(seen[len(cut)])))
                    seen[len(cut)] += 1
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", F.spark_partition_id().alias("part"))
    return rows.mapInArrow(pieces, PIECES)


def _ids(tokens: WordTokens, texts: pa.Array, together: int = 500) -> Iterator[bytes]:
    for start in range(0, len(texts), together):
        yield from tokens.ids([t or "" for t in texts.slice(start, together).to_pylist()])


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, dict[int, int]]]:
    """Sequences to make: (how many, {length: pieces of that length in each}), for so many pieces of each length.

    From the longest down, a piece's gap to `limit` is filled exactly: by a piece of that length, else by two, else by
    three whose lengths sum up to it. Presence of lengths and of sums of two is indexed; a combination is used as
    often as the counts allow, which uses up one length at least. What no combination fits goes, longest first, to the
    open sequence with the smallest gap that takes it, else to new ones. Work and plan depend on `limit` alone, not on
    the number of pieces.
    """
    left = np.zeros(limit + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    here = (left > 0).astype(np.int64)
    sums = np.convolve(here, here)  # of two lengths that are there, in either order
    made: list[tuple[int, dict[int, int]]] = []

    def use(lengths: list[int]) -> None:
        of = {n: lengths.count(n) for n in lengths}
        times = min(int(left[n]) // k for n, k in of.items())
        made.append((times, of))
        for n, k in of.items():
            left[n] -= times * k
            if not left[n]:
                sums[n : n + limit + 1] -= 2 * here
                sums[2 * n] += 1
                here[n] = 0

    def two(total: int, free: np.ndarray) -> list[int] | None:
        x = np.arange(max(1, total - limit), total // 2 + 1)
        if not len(x):
            return None
        fits = np.where(total - x == x, free[x] // 2, np.minimum(free[x], free[total - x]))
        best = int(fits.argmax())
        return [int(x[best]), int(total - x[best])] if fits[best] > 0 else None

    def exact(longest: int) -> list[int] | None:
        gap = limit - longest
        if gap == 0:
            return []
        free = left.copy()
        free[longest] -= 1
        if free[gap] > 0:
            return [gap]
        if sums[gap] and (found := two(gap, free)):
            return found
        x = np.arange(1, gap - 1)
        for first in x[(free[x] > 0) & (sums[gap - x] > 0)][::-1]:
            free[first] -= 1
            if found := two(gap - int(first), free):
                return [int(first), *found]
            free[first] += 1
        return None

    for length in range(limit, 0, -1):
        while left[length] and (rest := exact(length)) is not None:
            use([length, *rest])

    opened: dict[int, list[tuple[int, dict[int, int]]]] = {}  # by gap
    for length in range(limit, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g in opened if g >= length), default=0)
            if not gap:
                each = limit // length
                for times, k in ((n // each, each), (min(1, n % each), n % each)):
                    if times:
                        opened.setdefault(limit - k * length, []).append((times, {length: k}))
                break
            times, of = opened[gap].pop()
            if times > n:
                opened[gap].append((times - n, of))
                times = n
            if not opened[gap]:
                del opened[gap]
            opened.setdefault(gap - length, []).append((times, of | {length: of.get(length, 0) + 1}))
            n -= times
    return made + [x for same in opened.values() for x in same]


def place(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The pieces of `encode`, written by now, with sequence_id and offset; part and nth are dropped, all else is kept.

    Pieces of one length are alike to the plan, so a piece needs its rank among them only: the pieces of that length in
    earlier partitions, plus `nth`. Counts by partition and length are all that is shuffled; the plan, whose size
    depends on `limit` alone, goes to every task. No pieces: no rows.
    """
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "lengths")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    slots, base = [], 0
    used = dict.fromkeys(totals, 0)
    for times, of in plan(totals, limit):
        offset = 0
        for length, k in of.items():
            slots.append((length, used[length], base, k, offset))
            used[length] += times * k
            offset += length * k
        base += times
    slots.sort()
    lengths, starts, bases, each, offsets = (np.array(c, np.int64) for c in (zip(*slots) if slots else [()] * 5))
    keys = (lengths << 48) + starts

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rank = f["nth"].to_numpy() + f.pop("before").to_numpy()
            at = np.searchsorted(keys, (f["length"].to_numpy() << 48) + rank, "right") - 1
            inside = rank - starts[at]
            f["sequence_id"] = bases[at] + inside // each[at]
            f["offset"] = offsets[at] + inside % each[at] * lengths[at]
            yield f.drop(columns=["part", "nth"])

    kept = [f for f in pieces.schema if f.name not in ("part", "nth")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    ranked = pieces.join(counts.select(F.col("part").alias("p"), F.col("length").alias("l"), "before"), (F.col("part") == F.col("p")) & (F.col("length") == F.col("l"))).drop("p", "l")
    return ranked.mapInPandas(put, schema)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return place(written(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"))
