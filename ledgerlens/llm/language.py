"""Language identification: the family first, then duels of linear support vector machines within the family."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import computed, pick, table

#: Families of languages by code. A language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nl no nb nn sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
#: features that runs of one to three letters are hashed to
FEATURES = 1 << 13
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point below 65536 its lower-case form if it is a letter, else 0."""
    return np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(1 << 16)], np.uint32)


def features(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Square roots of the counts of letter runs, of length one; None without letters.

    Anything but a letter is a gap; gaps next to each other are one. Runs of one, two and three of letters and gaps
    are counted, over the whole text.
    """
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    low = letters[np.minimum(points, 65535)]
    if (high := np.flatnonzero(points > 65535)).size:
        known, at = np.unique(points[high], return_inverse=True)
        low[high] = np.array([ord(chr(p).lower()) if chr(p).isalpha() else 0 for p in known], np.uint32)[at]
    if not low.any():
        return None
    low = np.concatenate([[0], low, [0]]).astype(np.uint32)
    gap = low == 0
    low = low[~gap | np.concatenate([[True], ~gap[:-1]])]
    h1 = low * np.uint32(0x9E3779B1)
    h2 = (h1[:-1] ^ np.uint32(0x5BD1E995)) + low[1:] * np.uint32(0x85EBCA6B)
    h3 = h2[:-1] * np.uint32(0xC2B2AE35) + low[2:] * np.uint32(0x27D4EB2F)
    hashes = np.concatenate([h1, h2 * np.uint32(0x165667B1), h3 * np.uint32(0x2C1B3C6D)])
    x = np.sqrt(np.bincount(hashes >> np.uint32(19), minlength=FEATURES).astype(np.float32))
    return x / np.linalg.norm(x)


def support_vector_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights, the last one the offset, of a linear machine for y = 1 or -1: squared hinge loss, accelerated descent."""
    w = ahead = np.zeros(x.shape[1] + 1, np.float32)
    # both classes weigh alike; rows are of length 1, with the offset sqrt(2), which bounds the curvature
    c = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())).astype(np.float32) * cost
    step, momentum = 1 / (1 + 4 * float(c.sum())), 1.0
    for _ in range(rounds):
        slack = c * y * np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        new = ahead - step * (ahead - 2 * np.append(slack @ x, slack.sum()).astype(np.float32))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, w, momentum = new + (momentum - 1) / following * (new - w), new, following
    return w


def fit_duel(rows: pd.DataFrame) -> np.ndarray:
    """Weights of one duel, from rows of `side` (1 or -1) and packed features `x`."""
    order = rows.sort_values(["lang", "x"], kind="stable")
    x = np.frombuffer(b"".join(order["x"]), np.float16).reshape(len(order), FEATURES).astype(np.float32)
    return support_vector_machine(x, order["side"].to_numpy(np.float32)).astype(np.float32)


def _winner(names: list[str], ws: np.ndarray, x: np.ndarray) -> tuple[str, float]:
    """Who wins most duels, summed margins deciding between equals; and the smallest of the winner's chances."""
    if len(names) == 1:
        return names[0], 1.0
    margins = ws[:, :-1] @ x + ws[:, -1]
    wins, sums, chances = np.zeros(len(names)), np.zeros(len(names)), np.ones(len(names))
    for (a, b), m in zip(combinations(range(len(names)), 2), margins):
        wins[a if m >= 0 else b] += 1
        sums[a] += m
        sums[b] -= m
        p = 1 / (1 + np.exp(-2 * float(m)))
        chances[a], chances[b] = min(chances[a], p), min(chances[b], 1 - p)
    best = max(range(len(names)), key=lambda i: (wins[i], sums[i]))
    return names[best], float(chances[best])


def predict(x: np.ndarray | None, model: dict) -> tuple[str, float]:
    if x is None or not model["families"][0]:
        return UNKNOWN, 0.0
    family, sure = _winner(*model["families"], x)
    lang, surer = _winner(*model["within"][family], x)
    return lang, sure * surer


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def duels_of(langs: list[str]) -> list[tuple[str | None, str, str]]:
    """(family or None, one, the other): None for duels of families, else one between two languages of the family."""
    members: dict[str, list[str]] = {}
    for lang in sorted(langs):
        members.setdefault(FAMILY_OF.get(lang, lang), []).append(lang)
    between = [(None, *pair) for pair in combinations(sorted(members), 2)]
    return between + [(f, *pair) for f in sorted(members) for pair in combinations(members[f], 2)]


def train(docs: DataFrame, sample: int = 500, languages: int = 64) -> dict:
    """The model, from about `sample` different labelled texts of each of the `languages` most frequent languages.

    Both bound what is fitted on; a language beyond them is never predicted. Texts are picked by a hash of the text, and
    equal ones count once, whatever their doc_id. Each duel is fitted in a task of its own, on `sample` rows of 16 kB from
    either side, two times that of a family; the driver gets 33 kB a duel. Held out documents, null lang and texts
    without letters are left out. Whole texts count. No labelled documents: a model without languages.
    """
    labelled = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.where(F.col("text").rlike(r"\p{L}"))
    different = labelled.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n"))
    counts = {r["lang"]: r["n"] for r in different.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    draw = F.pmod(F.xxhash64(F.lit("language"), "text"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (draw < int(min(1.0, sample / max(1, n)) * (1 << 30))))

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        for f in frames:
            xs = [features(t, letters) for t in f["text"]]
            keep = [x is not None for x in xs]
            yield pd.DataFrame({"lang": f["lang"][keep], "x": [x.astype(np.float16).tobytes() for x in xs if x is not None]})

    family = {lang: FAMILY_OF.get(lang, lang) for lang in counts}
    duels = duels_of(list(counts))
    # a family's languages share its places in a duel of families
    sides = [
        (lang, i, 1 if name == a else -1, 1000 if of else min(1000, 2000 // list(family.values()).count(name)))
        for i, (of, a, b) in enumerate(duels)
        for lang in counts
        if (name := lang if of else family[lang]) in (a, b) and (of is None or family[lang] == of)
    ]
    weights: dict[int, np.ndarray] = {}
    if duels:
        rows = labelled.where(chosen).select("text", "lang").mapInPandas(packed, "lang string, x binary").dropDuplicates()
        table_ = F.broadcast(docs.sparkSession.createDataFrame(sides, "lang string, duel int, side int, of_1000 int"))
        dealt = rows.join(table_, "lang").where(F.pmod(F.xxhash64("x"), F.lit(1000)) < F.col("of_1000"))

        def fitted(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"duel": [key[0]], "w": [fit_duel(f).tobytes()]})

        found = dealt.select("duel", "lang", "side", "x").groupBy("duel").applyInPandas(fitted, "duel int, w binary")
        weights = {r["duel"]: np.frombuffer(r["w"], np.float32) for r in found.collect()}
    none = np.zeros(FEATURES + 1, np.float32)

    def machines(of: str | None) -> np.ndarray:
        return np.array([weights.get(i, none) for i, d in enumerate(duels) if d[0] == of], np.float32).reshape(-1, FEATURES + 1)

    names = sorted(set(family.values()))
    within = {f: (sorted(c for c in counts if family[c] == f), machines(f)) for f in names}
    return {"families": (names, machines(None)), "within": within}


def identify(docs: DataFrame, model: dict, columns: tuple[str, ...] | None = None) -> DataFrame:
    """`lang_pred` and `score` added to these columns of every document, from its whole text alone.

    Null text, or text without letters: `und`, score 0. Rows may repeat, doc_id may be null. Columns that are not asked
    for are left out; input columns named lang_pred or score are replaced.
    """

    def start() -> Callable[[list], list[pa.Array]]:
        letters = letter_table()

        def predicted(texts: list[str | None]) -> list[pa.Array]:
            found = [predict(None if t is None else features(t, letters), model) for t in texts]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return predicted

    return computed(docs, columns, "text", T.StructType().add("lang_pred", "string").add("score", "double"), start)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs), ("doc_id", "text")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
