import random
import zlib

from pyspark.sql import functions as F

from ledgerlens.llm.language import features, held_out, identify, letter_table, train
from tests.llm.rows import TEXTS, documents, no_documents, odd_documents, row


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(TEXTS))
        words = rng.choices(TEXTS[lang].split(), k=rng.randint(3, 40))
        rows.append(row(i, " ".join(words), lang if i % 11 else None))
    return rows


def test_held_out_accuracy(spark):
    rows = labelled()
    docs = documents(spark, rows)
    model = train(docs, sample=60)
    # a family is told first: two families, two languages each
    assert model["families"][0] == ["germanic", "romance"] and set(model["within"]) == {"germanic", "romance"}
    found = identify(docs, model, ("doc_id", "text")).withColumn("out", held_out(F.col("doc_id"))).collect()
    truth = {r[0]: r[2] for r in rows}
    out = [r for r in found if r["out"] and truth[r["doc_id"]]]
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert len(out) > 50 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_labels_of_held_out_documents_are_not_learnt(spark):
    rows = labelled()
    swapped = [r if zlib.crc32(str(r[0]).encode()) % 4 != 2 else (*r[:2], "en", "zzz", *r[4:]) for r in rows]
    a, b = (train(documents(spark, x), sample=40) for x in (rows, swapped))
    assert str(a["families"]) == str(b["families"]) and str(a["within"]) == str(b["within"])


def test_odd_rows(spark):
    docs = documents(spark, odd_documents() + [(1000 + r[0], *r[1:]) for r in labelled(200)])
    found = identify(docs, train(docs)).where("doc_id < 1000 or doc_id is null").collect()
    assert len(found) == len(odd_documents())
    for r in found:
        unknown = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == unknown and (r["score"] == 0) == unknown
        assert r["TEXT"] in ("other", None)


def test_no_rows_and_no_labels(spark):
    none = no_documents(spark)
    assert identify(none, train(none)).count() == 0
    unlabelled = documents(spark, [row(1, "some text", None), row(2, None, None)])
    assert {r["lang_pred"] for r in identify(unlabelled, train(unlabelled)).collect()} == {"und"}


def test_one_language(spark):
    docs = documents(spark, [row(i, "some words here", "xx") for i in range(8)])
    assert {(r["lang_pred"], r["score"]) for r in identify(docs, train(docs)).collect()} == {("xx", 1.0)}


def test_features_ignore_case_and_signs():
    letters = letter_table()
    assert (features("Der Hund!", letters) == features("  der... HUND", letters)).all()
    assert features("12 !?", letters) is None and features("𝔘", letters) is not None


def test_doc_ids_do_not_matter(spark):
    """Documents without doc_id, or with one for all, are learnt from like any others."""
    rows = labelled(300)
    for doc_id in (None, next(i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2)):
        docs = documents(spark, [(doc_id, *r[1:]) for r in rows])
        model = train(docs, sample=50)
        assert model["families"][0] == ["germanic", "romance"]
        found = identify(docs, model, ("text", "lang")).where("lang is not null").collect()
        assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.97 * len(found)


def test_very_common_rows_and_very_many_languages(spark):
    """The sample holds different texts, and no more languages than asked for."""
    rows = [row(i, TEXTS["de"], "de") for i in range(500)] + labelled(200)
    rows += [row(1000 + i, f"wort{chr(97 + i % 26)} nummer{chr(97 + i // 26)}", f"junk{i}") for i in range(100)]
    model = train(documents(spark, rows), sample=30, languages=6)
    assert sum(len(names) for names, _ in model["within"].values()) == 6
    assert {"de", "en", "es", "fr"} <= {n for names, _ in model["within"].values() for n in names}
