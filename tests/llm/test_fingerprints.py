import hashlib
import random

import numpy as np
import pytest

from ledgerlens.llm.fingerprints import likeness, neighbour_fingerprints, phrases, signatures
from tests.llm.rows import documents, no_documents, odd_documents, row


def brute(rows):
    """Rows by doc_id, null first, then by text."""
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, b, c = signatures([text]), signatures([edited]), signatures([following])
        out.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.astype(">u2").tobytes().hex(), b.astype(">u2").tobytes().hex())
            + (float(likeness(a, b)[0]), float(likeness(a, c)[0]))
        )
    return sorted(map(str, out))


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_odd_rows(spark, ranges):
    found = neighbour_fingerprints(documents(spark).repartition(4), ranges).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(odd_documents())


def test_one_and_none(spark):
    assert neighbour_fingerprints(no_documents(spark)).count() == 0
    one = [row(7, "a single document is followed by itself")]
    assert [str(tuple(r)) for r in neighbour_fingerprints(documents(spark, one)).collect()] == brute(one)


def test_many_documents(spark):
    rng = random.Random(1)
    rows = [row(rng.randrange(10**12), " ".join(rng.choices("ab cd efg hij klmno pq".split(), k=rng.randint(0, 60)))) for _ in range(300)]
    found = neighbour_fingerprints(documents(spark, rows).repartition(6), 16).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows)


def names(text):
    points = np.array([ord(c) for c in text], np.uint64)
    apart = np.zeros(len(points), bool)
    apart[0] = True
    out, apart = phrases(points * np.uint64(0x9E3779B97F4A7C15), apart)
    return [int(n) for n in phrases(out, apart)[0]]


def test_equal_substrings_share_their_interior():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=900))
    for _ in range(5):
        left, right = ("".join(rng.choices("abcxyz ", k=rng.randint(1, 50))) for _ in range(2))
        own, other = names(text), names(left + text + right)
        inner = own[5:-5]
        assert str(inner)[1:-1] in str(other)


def test_phrases_are_short_whatever_the_text():
    for text in ("a" * 5000, "ab" * 3000, "abc" * 2000, "".join(chr(97 + i % 26) for i in range(5000))):
        points = np.array([ord(c) for c in text], np.uint64)
        apart = np.zeros(len(points), bool)
        apart[0] = True
        assert len(phrases(points, apart)[0]) >= len(points) / 13


def test_likeness():
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 8))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(30)]
    edited = [t[: len(t) * 3 // 4] + u[: len(t) // 4] for t, u in zip(texts, texts[1:] + texts[:1])]
    own = signatures(texts)
    assert likeness(own, signatures(edited)).min() > 0.5
    assert likeness(own, np.roll(own, 1, axis=0)).max() < 0.3
    assert (likeness(own, signatures(texts[:15] + texts[15:])) == 1).all()
