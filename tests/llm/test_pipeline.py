from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from checks.compare import compare, sql_engine
from ledgerlens.llm import queries as registered
from ledgerlens.llm.common import pick, written
from ledgerlens.llm.near_duplicates import near_duplicates
from ledgerlens.llm.secrets import plain_words, spans
from tests.llm.rows import ENGLISH, FRENCH, GERMAN, SPANISH, TEXTS, documents, no_documents, odd_documents, row

WORDS = plain_words(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))

SMALLEST = "/root/testdata/sf0.001"


def test_names():
    names = list(entry_points.queries())
    numbered = [n for n in names if n.startswith("op")]
    assert [f"op{i}" for i in range(1, 11)] == [n.split("_")[0] for n in numbered if n.split("_")[0][2:].isdigit()]
    assert "pipeline" in names and set(registered.oracle_sql()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    outcome, _, _ = compare(spark, sql_engine(SMALLEST), SMALLEST, name)
    assert outcome.startswith("equal"), outcome


@pytest.mark.parametrize("name", sorted(set(registered.queries()) - set(registered.oracle_sql())))
def test_a_row_for_each_input(spark, name):
    table = "pages" if name.startswith("op4") else "documents"
    column = "page_id" if table == "pages" else "doc_id"
    want = spark.read.parquet(f"{SMALLEST}/{table}.parquet").select(column)
    got = registered.queries()[name](spark, SMALLEST).select(column)
    assert sorted(r[0] for r in got.distinct().collect()) == sorted(r[0] for r in want.collect())


def test_stages(spark):
    """Each stage on all that the one before has kept."""
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "secrets", "mixing", "packing"]
    rows = [tuple(r) for r in docs.collect()]

    known = written(stages["language"](spark, docs, SMALLEST), "t")
    assert known.columns == docs.columns
    assert sorted(tuple(r) for r in known.collect()) == sorted(r for r in rows if any(c.isalpha() for c in r[1] or ""))

    single = written(stages["near_duplicates"](spark, known, SMALLEST), "t")
    kept = {r["doc_id"] for r in near_duplicates(known).where("kept").collect()}
    rows = [tuple(r) for r in single.collect()]
    assert single.columns == docs.columns and {r[0] for r in rows} == kept and len(rows) == len(kept) < known.count()

    clean = written(stages["secrets"](spark, single, SMALLEST), "t")
    texts = {r[0]: r[1] for r in rows}
    for r in clean.collect():
        assert not spans(r["text"], 10.0, WORDS) and r["n_chars"] == len(r["text"])
        assert (r["text"] == texts[r["doc_id"]]) == (not spans(texts[r["doc_id"]], 10.0, WORDS))
    assert clean.count() == len(rows)

    mixed = written(stages["mixing"](spark, clean, SMALLEST), "t")
    texts = {r["doc_id"]: tuple(r) for r in clean.collect()}
    times = Counter()
    for r in mixed.collect():
        assert tuple(r) == texts[r["doc_id"]]
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 3 and mixed.columns == docs.columns

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    lengths = Counter()
    for r in stages["packing"](spark, mixed, SMALLEST).collect():
        pieces[r["doc_id"]].append((r["piece"], np.frombuffer(r["ids"], "<u4").tolist()))
        lengths[r["sequence_id"]] += r["length"]
    assert max(lengths.values()) <= 2048 and set(pieces) == set(times)
    for doc_id, found in pieces.items():
        ids = [*tokenizer.encode(texts[doc_id][1], add_special_tokens=False).ids, 0]
        want = sorted((i, ids[s : s + 2048]) for i, s in enumerate(range(0, len(ids), 2048)))
        assert sorted(found) == sorted(want * times[doc_id])


def run(spark, docs):
    # stages are written to files, which cannot hold two columns whose names differ in case alone
    docs = pick(docs, *[c for c in docs.columns if c != "TEXT"])
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "/nowhere")
        if name != "packing":
            assert out.columns == docs.columns and out.schema == docs.schema
        docs = written(out, name)
        counts.append(docs.count())
    return counts, docs


def test_odd_rows(spark):
    rows = odd_documents() + [row(100 + i, f"{TEXTS[k]} {i}", k, "d") for i, k in enumerate(TEXTS)]
    counts, _ = run(spark, documents(spark, rows))
    # five rows without a letter go, then near copies, of equal rows with one doc_id all but one
    assert counts[0] == sum(any(c.isalpha() for c in r[1] or "") for r in rows)
    left = near_duplicates(documents(spark, rows)).where("kept and (doc_id is null or n_shingles > 0)").count()
    assert counts[1] <= left and counts[2] == counts[1] and counts[4] >= counts[3] > 0


def test_no_rows(spark):
    counts, out = run(spark, no_documents(spark))
    assert counts == [0] * 5 and "sequence_id" in out.columns


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SMALLEST)
    assert out.count() > 0 and {"doc_id", "ids", "sequence_id", "offset"} <= set(out.columns)


def test_predicted_language_counts_where_it_is_sure(spark):
    rows = [row(i, f"{TEXTS[k]} {' '.join(TEXTS[k].split()[i % 7 :])}", k, "d") for i, k in enumerate(list(TEXTS) * 20)]
    rows += [row(1000, f"{TEXTS['de']} {TEXTS['de'][30:]}", "en", "d"), row(1001, f"{TEXTS['fr']} {TEXTS['fr'][20:]}", None, "d"), row(1002, "x9", "zz", "d")]
    found = {r["doc_id"]: r["lang"] for r in dict(corpus_pipeline.STAGES)["language"](spark, documents(spark, rows), "/nowhere").collect()}
    assert found == {r[0]: r[2] for r in rows} | {1000: "de", 1001: "fr"}


def test_no_labelled_documents(spark):
    rows = [(*r[:2], None, *r[3:]) for r in odd_documents()]
    found = dict(corpus_pipeline.STAGES)["language"](spark, documents(spark, rows), "/nowhere").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(r) for r in rows if any(c.isalpha() for c in r[1] or ""))


def test_rows_that_share_a_doc_id_go_one_by_one(spark):
    rows = [row(3, ENGLISH), row(5, ENGLISH), row(5, GERMAN), row(6, FRENCH), row(6, SPANISH), row(9, SPANISH), row(2, FRENCH), row(7, GERMAN + " x"), row(None, ENGLISH)]
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, documents(spark, rows), "/nowhere")
    assert found.columns == documents(spark).columns
    got = sorted((r["doc_id"] or 0, r["text"]) for r in found.collect())
    assert got == sorted([(3, ENGLISH), (5, GERMAN), (6, SPANISH), (2, FRENCH), (0, ENGLISH)])
