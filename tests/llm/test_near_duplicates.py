import random
import re

import numpy as np

from ledgerlens.llm.common import components, forest
from ledgerlens.llm.near_duplicates import _Words, near_duplicates, shingles, signature
from tests.llm.rows import documents, no_documents, odd_documents, row

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """By document id, all of its texts together: the least id reached by links; and shingles by text."""
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted(
        ((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=str
    )


def result(spark, rows):
    found = near_duplicates(documents(spark, rows)).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found), key=str)


def test_odd_rows(spark):
    assert result(spark, odd_documents()) == brute(odd_documents())


def test_no_rows(spark):
    assert near_duplicates(no_documents(spark)).count() == 0


def test_chains_and_groups(spark):
    """Edited copies of edited copies, so that ends of a chain are linked by what lies between; many copies of one."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    rows, n = [], 100
    for _ in range(12):
        text = rng.choices(words, k=rng.choice([6, 30, 120, 400]))
        for _ in range(rng.choice([1, 2, 6, 15])):
            rows.append(row(n, " ".join(text)))
            n += 1
            for _ in range(max(1, len(text) // rng.choice([40, 80, 120]))):
                text[rng.randrange(len(text))] = rng.choice(words)
    rows += [row(n + i, "the very same words in each of these many copies of one text") for i in range(60)]
    rng.shuffle(rows)
    assert result(spark, rows) == brute(rows)


def test_borderline_similarity(spark):
    # 6 shingles of 8: exactly 75 of 100; then below
    base = [f"a{i}" for i in range(40)]
    texts = [base[:10], base[:12], [*base[:10], "z", "y"], base[20:30], [*base[20:29], "x"]]
    rows = [row(i, " ".join(t)) for i, t in enumerate(texts)]
    assert result(spark, rows) == brute(rows)


def test_a_large_group_with_stragglers(spark):
    """Copies with more and more words changed: some are linked by others, some by none though they share bands."""
    rng = random.Random(7)
    text = [f"t{i}" for i in range(150)]
    rows = []
    for n in range(120):
        words = list(text)
        for i in rng.sample(range(150), n // 6):
            words[i] = f"own{n}x{i}"
        rows.append(row(n, " ".join(words)))
    found = result(spark, rows)
    assert found == brute(rows) and 5 < sum(r[3] for r in found) < 100


def test_signature_does_not_depend_on_neighbours():
    sets = [shingles(" ".join(f"w{i * j % 9973}" for i in range(n)), _Words()) for j, n in enumerate((3, 700, 9000, 20), 1)]
    together = signature(sets)
    assert all((signature([s])[0] == t).all() for s, t in zip(sets, together))


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = a.copy()
    b[:100] = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    x, y = signature([np.unique(a), np.unique(b)], rows=1, bands=512)
    assert abs((x == y).mean() - 900 / 1100) < 0.07


def test_components_match_union_find(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 3000, 2500), rng.integers(0, 3000, 2500)
    # a path, whose ends take several rounds to meet, in a random order of names
    names = rng.permutation(1000) + 5000
    a, b = np.concatenate([a, names[:-1]]), np.concatenate([b, names[1:]])
    edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long").repartition(7)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    keep = a != b
    assert found == dict(zip(*(x.tolist() for x in forest(a[keep], b[keep]))))
    root = {int(x): int(x) for x in np.concatenate([a[keep], b[keep]])}
    for _ in range(1000):
        changed = False
        for x, y in zip(a[keep].tolist(), b[keep].tolist()):
            low = min(root[x], root[y])
            changed |= root[x] != low or root[y] != low
            root[x] = root[y] = low
        if not changed:
            break
    assert found == root


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_run_agrees(spark):
    docs = documents(spark)
    assert sorted(map(str, near_duplicates(docs).collect())) == sorted(map(str, near_duplicates(docs.repartition(5)).collect()))
