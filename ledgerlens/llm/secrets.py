"""Secrets in texts: fixed patterns, and values in a credential's place that would take many guesses."""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import computed, protected, table

KINDS = ("assign", "access", "hex", "guess")
#: pattern, group that is measured, and its least length
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
#: a name for a credential, a sign or `is`, and a value up to white space or a quote
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|code|phrase)?|pwd|secret|token|api[_-]?key|(?:access|private|secret|auth)[_-]?(?:key|token)|credentials?)"""
    r"""["'`]?\x20{0,3}([:=]>?|=>|\x20is\x20)\x20{0,3}["'`]?([^\x00-\x20"'`<>]+)""",
    re.I | re.A,
)
HINTS = ("pass", "pwd", "secret", "token", "key", "credential")

#: Words that people guess first, the likeliest in front.
WORDS = """password secret token admin login welcome example changeme letmein qwerty dragon monkey master sunshine princess
football baseball shadow superman batman trustno hello freedom whatever michael jordan hunter ranger soccer hockey killer
george charlie andrew michelle love jessica pepper daniel access thunder summer winter spring autumn monday sunday january
february march april june july august september october november december root user guest test demo default null none true
false required optional string value number your here this that with from the and for not must should change enter key api
pass word name file path http https www com org net server client service system config value environment variable home""".split()
RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
LEET = str.maketrans("@4301$57!|", "aaeoisstii")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
NEXT_KEYS = {frozenset(p) for row in ROWS for p in zip(row, row[1:])} | {
    frozenset(p) for a, b in zip(ROWS, ROWS[1:]) for i, c in enumerate(a) for p in ((c, d) for d in b[max(0, i - 1) : i + 1])
}
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
#: decimal digits a character from which on a value is no text of known words, and how much more a value of such must cost
WORDLESS, WORDY = 0.95, 4.0


def plain_words(path: str) -> dict[str, int]:
    """Words of running text and their ranks: those that people guess first, then the letters-only tokens of a vocabulary
    file of `tiktoken`, several languages' words and word ends with the commonest first."""
    words = ["redacted", *WORDS]
    with open(path, "rb") as f:
        for line in f:
            try:
                token = base64.b64decode(line.split()[0]).decode().strip().lower()
            except UnicodeDecodeError:
                continue
            if len(token) >= 3 and token.isalpha():
                words.append(token)
    ranks: dict[str, int] = {}
    for word in words:
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


#: longest token of a vocabulary that counts as a word
LONGEST = 20


def _brute(c: str) -> float:
    size = 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100
    return math.log10(size)


def guess_cost(value: str, ranks: dict[str, int] = RANK) -> float:
    """Decimal logarithm of the guesses that find the value: the cheapest way to cut it into known pieces.

    Pieces are words (by rank; twice for capitals, and for digits in place of letters), dates, repeats of a piece,
    walks over neighbouring keys or along the alphabet, and single characters tried out. Every piece doubles the number.
    Words are those of `ranks`, by default the ones that people guess first.
    Each kind of piece that may end at a place is tried there, so the work grows with the length times a constant.
    """
    low = value.lower() if len(value.lower()) == len(value) else value
    plain = low.translate(LEET)
    n = len(value)
    longest = max(map(len, ranks)) if ranks is RANK else LONGEST
    brute = [0.0]
    for c in value:
        brute.append(brute[-1] + _brute(c))
    dates: dict[int, list[tuple[int, float]]] = {}
    for start in range(n):
        if value[start].isdigit() and (m := DATE.match(value, start)):
            dates.setdefault(m.end(), []).append((start, math.log10(120 if m.end() - start == 4 else 120 * 365)))
    best = [0.0] + [math.inf] * n
    walk = along = 0
    same = [0] * 9  # of each period: how many characters up to here equal the one a period earlier
    double = math.log10(2)
    for end in range(1, n + 1):
        found = best[end - 1] + brute[end] - brute[end - 1]
        for length in range(3, min(longest, end) + 1):
            start = end - length
            rank, shift = ranks.get(low[start:end]), 0.0
            if rank is None:
                rank, shift = ranks.get(plain[start:end]), double
            if rank is not None:
                cost = math.log10(rank + 1) + shift + (double if low[start:end] != value[start:end] else 0.0)
                found = min(found, best[start] + cost + double)
        for start, cost in dates.get(end, ()):
            found = min(found, best[start] + cost + double)
        if end > 1:
            walk = walk + 1 if frozenset(low[end - 2 : end]) in NEXT_KEYS else 0
            along = along + 1 if abs(ord(low[end - 1]) - ord(low[end - 2])) == 1 else 0
            for run in (walk, along):
                if run >= 2:
                    found = min(found, best[end - 1 - run] + math.log10(47 * 4 * run) + double)
        for period in range(1, 9):
            same[period] = same[period] + 1 if end > period and value[end - 1] == value[end - 1 - period] else 0
            if same[period] >= max(2, period):
                start = end - period - same[period]
                once = brute[start + period] - brute[start]
                found = min(found, best[start] + once + math.log10(same[period] / period + 1) + double)
        best[end] = found
    return best[n]


def spans(text: str, least_cost: float, words: dict[str, int]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then in the order of KINDS; `words` as `plain_words` gives them."""
    found = []
    low = text.lower()
    hinted = any(h in low for h in HINTS)
    for kind, (pattern, group, least) in BASE.items():
        if kind == "hex" or (hinted if kind == "assign" else "AKIA" in text):
            found += [(kind, *m.span()) for m in pattern.finditer(text) if len(m[group]) >= least]
    if hinted:
        for m in CONTEXT.finditer(text):
            value = m[2].rstrip(".,;:!?)]}")
            sorts = [bool(re.search(p, value)) for p in ("[0-9]", "[a-z]", "[A-Z]", r"[^A-Za-z0-9\s]")]
            mixed = sum(sorts) >= (2 if sorts[0] else 3)
            if len(value) >= 8:
                cost = guess_cost(value, RANK if mixed else words)
                # a few words in a row are a compound or prose; more of them are a passphrase
                wordy = not mixed and any(map(str.isalpha, value)) and cost < WORDLESS * len(value)
                least = least_cost + WORDY if wordy else least_cost
                if cost >= least:
                    found.append(("guess", m.start(2), m.start(2) + len(value)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, columns: tuple[str, ...] | None = None, least_cost: float = 10.0, vocabulary: str | None = None) -> DataFrame:
    """`secrets`, an array of (kind, start, end), added to these columns of every document.

    Kinds assign, access and hex are fixed patterns over the whole text. Kind guess is a value named as a credential, by a
    sign or by "is", of eight or more characters, that takes 10 ** `least_cost` guesses or more; one that is made of known
    words takes four digits more, as compounds of two or three words are. Plain words of the languages of `vocabulary` (a
    file of `tiktoken`, by default the public one of many languages), dates and keyboard walks are left alone. Null text
    counts as empty: no spans. Spans may overlap; equal rows get equal spans. An input column named secrets is replaced.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def start() -> Callable[[list], list[pa.Array]]:
        words = plain_words(path)

        def scanned(texts: list[str | None]) -> list[pa.Array]:
            found = [spans(t, least_cost, words) if t else [] for t in texts]
            return [pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in one] for one in found], _SPANS)]

        return scanned

    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
    return computed(docs, columns, "text", T.StructType().add("secrets", T.ArrayType(span)), start)


def redact(docs: DataFrame, mark: str = "[redacted]", least_cost: float = 10.0) -> DataFrame:
    """The documents with every secret replaced by `mark`, n_chars counted anew where text changed; all rows are kept."""
    rows, named = protected(docs, "text", "n_chars")
    names = rows.columns
    found = scan(rows, tuple(names), least_cost)

    def place(state: Column, span: Column) -> Column:
        # spans come by start: what an earlier one covers is not cut again
        fresh = span["start"] >= state["upto"]
        kept = F.substr(F.col("text"), (state["upto"] + 1).cast("int"), F.greatest(F.lit(0), span["start"] - state["upto"]).cast("int"))
        return F.struct(
            F.concat(state["text"], F.when(fresh, F.concat(kept, F.lit(mark))).otherwise(F.lit(""))).alias("text"),
            F.greatest(state["upto"], span["end"]).alias("upto"),
        )

    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("upto"))
    clean = F.aggregate(
        "secrets", start, place, lambda s: F.concat(s["text"], F.substr(F.col("text"), (s["upto"] + 1).cast("int"), F.length("text")))
    )
    hit = F.size("secrets") > 0
    changed = found.withColumn("__clean", F.when(hit, clean).otherwise(F.col("text")))
    columns = {"text": F.col("__clean")}
    if "n_chars" in names:
        columns["n_chars"] = F.when(hit, F.length("__clean")).otherwise(F.col("n_chars")).cast(rows.schema["n_chars"].dataType)
    return named(changed.select(*[columns.get(n, F.col(f"`{n}`")).alias(n) for n in names]))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), ("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans")
    )
