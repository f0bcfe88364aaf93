"""Encoding and decoding by a byte-level vocabulary of byte pairs; long texts as a tree of halves, joined exactly."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import pick, table

#: code points of a leaf of the tree, and of a part that a task of its own encodes
LEAF, PART = 1 << 14, 1 << 20
#: code points of texts whose ids make a batch
TOGETHER = 1 << 20
#: tokens on each side of a join that are encoded anew at first
WINDOW = 64
#: texts with code points from here on are left to `tokenizers`
PLAIN = 0x250
#: bytes next to a cut in which the cut may have changed where the text is split: several times the longest special
#: token, contraction or look ahead
MARGIN = 64
#: bytes of a run that must follow a place for a split to go on alike from there
INSIDE = 16


@dataclass
class Node:
    """Ids of a text, the bytes up to the end of each, and whether each opens a part that the text is split into."""

    ids: np.ndarray
    ends: np.ndarray
    opens: np.ndarray

    def start(self, i: int) -> int:
        """The byte at which token i starts, or the text ends."""
        return int(self.ends[i - 1]) if i else 0


class Vocabulary:
    """The bytes of each id of a byte-level vocabulary file of the `tokenizers` library."""

    def __init__(self, path: str) -> None:
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}
        with open(path) as f:
            given = json.load(f)
        if given["decoder"]["type"] != "ByteLevel" or given["normalizer"]:
            raise ValueError("a byte-level vocabulary is needed, without normaliser")
        self.model = given["model"]
        ids = self.model["vocab"] | {t["content"]: t["id"] for t in given["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {}
        for token, i in ids.items():
            known = all(c in byte_of for c in token)
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if known else token.encode()

    def text(self, ids: list[int | None]) -> str:
        """Bytes of the ids, one after the other; ids that are not in the vocabulary have none."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


class BytePairs(Vocabulary):
    """A vocabulary file of the `tokenizers` library: byte-level, without normaliser or unknown token.

    Such a vocabulary splits a text by a pattern, from left to right, and merges bytes within each part. Two facts let
    texts be joined. Where two splits open a part at the same place, they agree from there on; and a row of tokens is
    what merging gives if each two neighbours are what merging gives for the two, so rows that share a token may be
    joined at it.

    Texts of Latin letters and signs without special tokens go to `tiktoken`, several times as fast: with the same
    merges, and the pattern in terms of the characters as `tokenizers` sorts them. Any other text goes to `tokenizers`.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if not isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            raise ValueError("a byte-level vocabulary is needed, split as such")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pattern = self._pattern()
        self.pattern = re.compile(pattern)
        self.above = re.compile(f"[{chr(PLAIN)}-\U0010ffff]")
        model = self.model
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or any(model.get(k) for k in ("unk_token", "dropout", "ignore_merges")):
            raise ValueError("a vocabulary is needed whose ids are in the order of its merges")
        special = {self.tokenizer.token_to_id(t) for t in self.special}
        ranks = {b: i for i, b in self.bytes_of.items() if i not in special}
        self.pairs = tiktoken.Encoding("byte pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.lengths[i] = len(b)
        del self.model

    def _pattern(self) -> str:
        """The pattern of the split, with the characters below `PLAIN` as the library sorts them."""

        def together(text: str) -> bool:
            return len(self.tokenizer.pre_tokenizer.pre_tokenize_str(text)) == 1

        if not together(" a") or not together("'re") or together("a b"):
            raise ValueError("a byte-level vocabulary is needed that splits by the usual pattern and adds no space")
        kinds: dict[str, str] = {"a": "", "1": "", "!": "", "\t": ""}
        for i in range(PLAIN):
            kinds[next(k for k in kinds if together(k + chr(i)))] += f"\\u{i:04x}"
        letter, number, sign, space = kinds.values()
        return f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[{sign}]+|[{space}]+(?![^{space}])|[{space}]+"

    def _opens(self, text: str, starts: np.ndarray) -> np.ndarray:
        """Which of the bytes open a part that the text is split into."""
        parts = self.pattern.findall(text)
        sizes = [len(p) for p in parts] if text.isascii() else [len(p.encode()) for p in parts]
        opens = np.zeros(int(sum(sizes)) + 1, bool)
        opens[np.cumsum([0, *sizes])] = True
        return opens[starts]

    def _nodes(self, texts: list[str], opening: bool = True) -> list[Node]:
        nodes = []
        for text in texts:
            if self.above.search(text) or any(s in text for s in self.special):
                e = self.tokenizer.encode(text, add_special_tokens=False)
                ids, words = np.array(e.ids, np.int32), np.array(e.word_ids, np.int64)
                nodes.append(Node(ids, self.lengths[ids].cumsum(), np.diff(words, prepend=-1) != 0))
            else:
                ids = np.array(self.pairs.encode_ordinary(text), np.int32)
                ends = self.lengths[ids].cumsum()
                nodes.append(Node(ids, ends, self._opens(text, ends - self.lengths[ids]) if opening else ids[:0]))
        return nodes

    def _bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def _from(self, a: Node, k: int) -> tuple[int, bool]:
        """A token about k before the end of `a` to start a window at, and whether it opens a part."""
        n = len(a.ids)
        if n <= k:
            return 0, True
        openings = np.flatnonzero(a.opens)
        before = int(openings[np.searchsorted(openings, n - k, "right") - 1])
        if n - k - before < k:
            return before, True
        # within a long part: the next part that opens well before the end, or a token of the part itself
        after = np.searchsorted(openings, n - k, "right")
        if after < len(openings) and a.ends[-1] - a.start(int(openings[after])) >= MARGIN:
            return int(openings[after]), True
        s = n - k
        while s > before and (self.bytes_of[int(a.ids[s])][0] & 0xC0) == 0x80:
            s -= 1
        return s, s == before

    def _to(self, b: Node, k: int) -> int:
        """A token about k after the start of `b` to end a window before."""
        e = min(k, len(b.ids))
        while e < len(b.ids) and (self.bytes_of[int(b.ids[e])][0] & 0xC0) == 0x80:
            e += 1
        return e

    def _meet(self, w: Node, before: int, b: Node, e: int) -> tuple[int, int] | None:
        """Tokens of the window and of `b` from which on both agree; `before` bytes of the window precede `b`."""
        if e == len(b.ids):
            return len(w.ids), e
        end = b.start(e)
        starts_w, starts_b = w.ends - self.lengths[w.ids] - before, b.ends[:e] - self.lengths[b.ids[:e]]
        _, i, j = np.intersect1d(starts_w, starts_b, return_indices=True)
        fine = starts_b[j] <= end - MARGIN
        i, j = i[fine], j[fine]
        both = w.opens[i] & b.opens[j]
        if both.any():
            at = int(both.argmax())
            return int(i[at]), int(j[at])
        # both within a part that goes on beyond the window: a token that they share
        last_w, last_b = np.flatnonzero(w.opens)[-1], np.flatnonzero(b.opens[:e])[-1]
        if not b.opens[e]:
            shared = (i > last_w) & (j > last_b) & (w.ids[i] == b.ids[j])
            if shared.any():
                at = int(shared.argmax())
                return int(i[at]), int(j[at])
        return None

    def join(self, a: Node, b: Node) -> Node:
        """The node of the two texts one after the other.

        A window around the join is encoded anew, and grows until its first tokens agree with those of `a` and its last
        ones with those of `b`, in the split and in the tokens.
        """
        if not len(a.ids) or not len(b.ids):
            return b if not len(a.ids) else a
        k = WINDOW
        while True:
            (s, opening), e = self._from(a, k), self._to(b, k)
            w = self._nodes([(self._bytes(a.ids[s:]) + self._bytes(b.ids[:e])).decode()])[0]
            agree = opening
            if not opening:
                following = np.flatnonzero(a.opens[s:])
                until = a.start(s + int(following[0])) if len(following) else int(a.ends[-1])
                agree = until - a.start(s) >= INSIDE and w.ids[0] == a.ids[s]
            met = self._meet(w, int(a.ends[-1]) - a.start(s), b, e) if agree else None
            if met is not None:
                i, j = met
                ids = np.concatenate([a.ids[:s], w.ids[:i], b.ids[j:]])
                opens = np.concatenate([a.opens[:s], w.opens[:i], b.opens[j:]])
                if not opening:
                    opens[s] = False
                return Node(ids, self.lengths[ids].cumsum(), opens)
            k *= 2

    def tree(self, nodes: list[Node]) -> Node:
        """One node from those of consecutive texts: neighbours are joined, then neighbouring pairs, and so on."""
        while len(nodes) > 1:
            nodes = [self.join(*nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0]

    def node(self, text: str, leaf: int = LEAF) -> Node:
        return self.tree(self._nodes([text[i : i + leaf] for i in range(0, max(1, len(text)), leaf)]))

    def ids(self, texts: list[str], leaf: int = LEAF) -> list[np.ndarray]:
        """For each text its ids."""
        out: list[np.ndarray] = [None] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= leaf]
        for i, node in zip(short, self._nodes([texts[i] for i in short], False)):
            out[i] = node.ids
        for i, text in enumerate(texts):
            if out[i] is None:
                out[i] = self.node(text, leaf).ids
        return out


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))


def encode(docs: DataFrame, tokenizer: str, leaf: int = LEAF, part: int = PART) -> DataFrame:
    """doc_id and ids, an array of int, for every document: what the `tokenizers` library gives for the whole text.

    Special tokens are added nowhere, and found where a text holds their strings. A text of more than `leaf` code points
    is cut into leaves, which are encoded each on its own and joined in pairs, up to the whole. The leaves of a text of
    more than `part` code points are dealt out to tasks, part by part, so that none holds up the rest; the parts of a
    text meet in one task, as its ids are one value of one row.

    Null text counts as empty, which has no ids. Null or repeated doc_id, repeated rows: each row has its own. No
    documents: no rows. Only doc_id and text are looked at.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(tokenizer)
        for batch in batches:
            texts, size, start = [], 0, 0
            for i, text in enumerate(batch.column("text")):
                texts.append(text.as_py())
                size += len(texts[-1])
                if size >= TOGETHER or i + 1 == len(batch):
                    ids = _lists(pairs.ids(texts, leaf))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)), ids], ["doc_id", "ids"])
                    texts, size, start = [], 0, i + 1

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(tokenizer)
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                node = pairs.node(text.as_py(), leaf)
                packed = [pa.array([node.ids.tobytes()], pa.binary()), pa.array([np.packbits(node.opens).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, 1) for c in ("key", "doc_id", "nth")] + packed, PARTS)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(tokenizer)
        last, nodes = None, []
        for batch in batches:
            for key, doc_id, packed, marks in zip(*[batch.column(c) for c in ("key", "doc_id", "ids", "opens")]):
                if last is not None and key != last[0]:
                    yield pa.RecordBatch.from_arrays([pa.array([last[1].as_py()], pa.int64()), _lists([pairs.tree(nodes).ids])], ["doc_id", "ids"])
                    nodes = []
                ids = np.frombuffer(packed.as_py(), np.int32)
                opens = np.unpackbits(np.frombuffer(marks.as_py(), np.uint8), count=len(ids)).astype(bool)
                nodes.append(Node(ids, pairs.lengths[ids].cumsum(), opens))
                last = key, doc_id
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last[1].as_py()], pa.int64()), _lists([pairs.tree(nodes).ids])], ["doc_id", "ids"])

    long_ = F.length("text") > part
    few = rows.where(~long_).mapInArrow(whole, "doc_id long, ids array<int>")
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / part).cast("int")), lambda i: F.substr("text", i * part + 1, F.lit(part)))
    keyed = rows.where(long_).select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    many = keyed.select("key", "doc_id", F.posexplode(cut).alias("nth", "text")).repartition("key", "nth")
    many = many.mapInArrow(parts, "key long, doc_id long, nth int, ids binary, opens binary")
    together = many.repartition("key").sortWithinPartitions("key", "nth")
    return few.union(together.mapInArrow(joined, "doc_id long, ids array<int>"))


PARTS = ["key", "doc_id", "nth", "ids", "opens"]


def decode(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids and text: what the ids stand for, special tokens included, as the `tokenizers` library gives it.

    Bytes that are no UTF-8 become U+FFFD; ids that the vocabulary lacks, or null, stand for nothing; null ids have null
    text. No rows: no rows. Only doc_id and ids are looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(tokenizer)
        for batch in batches:
            texts = [vocabulary.text(v.as_py()) if v.is_valid else None for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return pick(tokens, "doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    found = decode(encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
