import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.mixing import draw, hypergeometric, mix, split_quotas, targets
from tests.llm.rows import documents, no_documents, odd_documents, row


def shares(sizes, most=3):
    """Shares by weight; what is above a limit is shared out again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    got, free, rest = dict.fromkeys(sizes, 0.0), set(sizes), float(sum(sizes.values()))
    while rest > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            got[s] += rest * weight[s] / total
        over = {s for s in free if got[s] > most * sizes[s]}
        rest = sum(got[s] - most * sizes[s] for s in over)
        for s in over:
            got[s] = float(most * sizes[s])
        free -= over
    return got


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, "c": 1000, None: 5}, {"a": 1}, {"a": 0, "b": 7}, {c: 5 for c in "zyxwvu"}, {"B": 900, "a": 1, "é": 2, None: 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in targets(df, (1, 2, 3), 3).collect()}
    want = shares(sizes)
    assert found.keys() == want.keys() and all(abs(found[s] - want[s]) < 1e-6 for s in want)


def test_hypergeometric(spark):
    n, k, d = 40, 15, 12
    steps = 4000
    df = spark.range(steps).select(hypergeometric(F.lit(n), F.lit(k), F.lit(d), (F.col("id") + 0.5) / steps).alias("x"))
    counts = Counter(r["x"] for r in df.collect())
    for x in range(d + 1):
        want = comb(k, x) * comb(n - k, d - x) / comb(n, d)
        assert abs(counts[x] / steps - want) < 2 / steps
    edge = spark.range(1).select(
        hypergeometric(F.lit(0), F.lit(0), F.lit(0), F.lit(0.5)), hypergeometric(F.lit(9), F.lit(9), F.lit(4), F.lit(0.9)),
        hypergeometric(F.lit(10**9), F.lit(3 * 10**8), F.lit(5 * 10**8), F.lit(0.5)),
    ).first()
    assert edge[0] == 0 and edge[1] == 4 and abs(edge[2] - 15 * 10**7) < 10


def test_quotas_are_dealt_out_whole(spark):
    quotas = {0: 100, 1: 1, 2: 37, 3: 862}
    found = split_quotas(spark.createDataFrame(list(quotas.items()), "number int, blocks long"), 3, "x").collect()
    by_source, by_shard = Counter(), Counter()
    for r in found:
        assert r["blocks"] >= 0
        by_source[r["number"]] += r["blocks"]
        by_shard[r["shard"]] += r["blocks"]
    assert by_source == quotas
    assert set(by_shard.values()) <= {1000 // 8, 1000 // 8 + 1}


def corpus():
    rows, n = [], 0
    for source, count, length in (("a", 300, 20), ("b", 40, 60), ("c", 5, 9), ("d", 30, 700), (None, 12, 3)):
        for i in range(count):
            rows.append(row(n, " ".join(["word"] * (length + i % 7)), "en", source))
            n += 1
    return rows


def test_words_taken(spark):
    rows = corpus()
    found = draw(documents(spark, rows)).collect()
    sizes = {r[0]: len(r[1].split()) for r in rows}
    of = {r[0]: r[3] for r in rows}
    sums = Counter()
    for i, n in sizes.items():
        sums[of[i]] += n
    want = shares(dict(sums))
    taken = Counter()
    for r in found:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == sums[r["source"]] and len(r["copies"]) <= 3
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["size"] * len(r["copies"])
    for s in sums:
        assert abs(taken[s] - want[s]) <= max(2, 0.01 * want[s]), (s, taken[s], want[s])
    again = draw(documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixed_rows(spark):
    rows = corpus()
    docs = documents(spark, rows)
    want = Counter()
    for r in draw(docs, levels=2).collect():
        for c in r["copies"]:
            want[r["doc_id"], str(c["epoch"]), str(c["shard"])] += 1
    out = mix(docs, levels=2)
    assert out.columns == [c for c in docs.columns if c not in ("epoch", "shard")] + ["epoch", "shard"]
    got = out.collect()
    assert Counter((r["doc_id"], str(r["epoch"]), str(r["shard"])) for r in got) == want
    texts = {r[0]: r[1] for r in rows}
    assert all(r["text"] == texts[r["doc_id"]] and r["TEXT"] == "other" for r in got)
    # shards differ by little, and each is in an order of its own
    blocks = Counter(r["shard"] for r in got)
    assert set(blocks) == {0, 1, 2, 3}
    ids = [r["doc_id"] for r in got if r["shard"] == 0]
    assert ids != sorted(ids)


def test_odd_rows(spark):
    found = draw(documents(spark)).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in odd_documents()]
    assert sorted(r["size"] for r in found) == sorted(words)
    by_id = {}
    for r in found:  # rows that repeat a document and source are drawn alike
        assert by_id.setdefault((r["doc_id"], r["source"]), r["copies"]) == r["copies"]
    assert mix(documents(spark)).count() == sum(len(r["copies"]) for r in found)


def test_no_rows(spark):
    assert draw(no_documents(spark)).count() == 0 and mix(no_documents(spark)).count() == 0
