import random
import re

from ledgerlens.llm.licences import LEAST, REPEATS, TEMPLATES, anchors, bigrams_of, licences, op6_licences
from tests.llm.rows import ENGLISH, documents, no_documents, odd_documents, row


def brute(text, templates=TEMPLATES, least=LEAST):
    best, names = 0.0, set()
    for unit in {*(text or "").split("\n"), *re.split(r"\n[ \t\r]*\n", text or ""), text or ""}:
        a = set(bigrams_of(unit))
        for name, template in templates:
            b = set(bigrams_of(template))
            if a and b and 200 * len(a & b) >= least * (len(a) + len(b)):
                best = max(best, 2 * len(a & b) / (len(a) + len(b)))
                names.add(name)
    return ",".join(sorted(names)), round(best, 9)


def check(spark, rows, **options):
    found = licences(documents(spark, rows), ("doc_id", "text"), **options).collect()
    want = sorted(str((r[0], *brute(r[1], options.get("templates", TEMPLATES), options.get("least", LEAST)))) for r in rows)
    assert sorted(str((r["doc_id"], r["licences"], round(r["best_dice"], 9))) for r in found) == want


def noisy(text, step):
    return " ".join(w for i, w in enumerate(text.split()) if i % step)


def test_templates_and_near_ones(spark):
    rows, n = [], 0
    for _, text in TEMPLATES:
        for step in (3, 5, 9, 14, 10**6):
            for form in ("{}", "{}\n" + ENGLISH, ENGLISH + "\n\n{}\n\n" + ENGLISH, "// {} and more words here"):
                rows.append(row(n, form.format(noisy("x " + text.upper(), step))))
                n += 1
    rows.append(row(n, TEMPLATES[1][1].replace(". ", ".\n")))
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, odd_documents())
    assert licences(no_documents(spark)).count() == 0
    assert licences(documents(spark)).columns == [*documents(spark).columns, "licences", "best_dice"]


def test_own_templates(spark):
    check(spark, [row(1, "a b c d e f"), row(2, "a b c d"), row(3, "x")], templates=[("one", "a b c d e"), ("two", "d"), ("none", "")], least=50)
    check(spark, [row(1, "a b")], templates=[])


def test_no_match_without_an_anchor():
    known = [bigrams_of(t) for _, t in TEMPLATES]
    needed = anchors(known, LEAST)
    for one in known:
        without = [b for b in one if not set(b.split()) & set(needed)]
        assert 200 * len(without) < LEAST * (len(without) + len(one))


def template(name, i=-1):
    return [t for n, t in TEMPLATES if n == name][i]


def in_paragraphs(text, parts):
    words = text.split()
    size = len(words) // parts + 1
    return "\n\n".join("\n".join("# " + " ".join(words[j : j + 11]) for j in range(i, min(i + size, len(words)), 11)) for i in range(0, len(words), size))


def test_passages_anywhere(spark):
    """Notices across paragraphs, within lines, and whole licence texts; of overlapping passages the best alone."""
    mit, apache, gpl, agpl = template("MIT"), template("Apache-2.0"), template("GPL-3.0"), template("AGPL-3.0")
    bsd3, bsd2 = [t for n, t in TEMPLATES if n.startswith("BSD") and len(t) > 900]
    texts = [
        ("MIT", f"The MIT License\n\nCopyright (c) 2020 Some Body\n\n{in_paragraphs(mit, 3)}"),
        ("GPL-3.0", ENGLISH + "\n" + in_paragraphs(gpl, 3) + "\n" + ENGLISH),
        ("Apache-2.0", in_paragraphs(apache, 3)),
        ("AGPL-3.0", in_paragraphs(agpl, 2)),
        ("BSD-3-Clause", ENGLISH + " " + in_paragraphs(bsd3, 4)),
        ("BSD-2-Clause", in_paragraphs(bsd2, 4)),
        ("MIT", f"{ENGLISH}. Released under the MIT License. {ENGLISH}."),
        ("GPL-3.0,MIT", f"{ENGLISH}. Released under the MIT License. {ENGLISH}. This work is licensed under the GNU General Public License, version 3. x"),
        ("", ENGLISH + " of this software under the terms of the license"),
        ("", ""),
    ]
    rows = [row(i, text) for i, (_, text) in enumerate(texts)]
    found = {r["doc_id"]: r["licences"] for r in licences(documents(spark, rows), ("doc_id",), anywhere=True).collect()}
    assert found == {i: name for i, (name, _) in enumerate(texts)}
    odd = licences(documents(spark, [*odd_documents(), row(99, None)]), ("doc_id",), anywhere=True).collect()
    assert {(r["licences"], r["best_dice"]) for r in odd} == {("", 0.0)}


def brute_passages(text, templates=TEMPLATES, least=LEAST):
    """Every pair of places, coefficients of plain sets; the best first, then those that meet none before."""
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    found = []
    for name, template in templates:
        known = set(bigrams_of(template))
        if len(known & set(pairs)) * (200 - least) < len(known) * least:
            continue
        longest = len(known) * (200 - least) // least
        for start, first in enumerate(pairs):
            best = None
            for end in range(start, min(len(pairs), start + REPEATS * longest)):
                held = set(pairs[start : end + 1])
                if len(held) > longest:
                    break
                if first in known and pairs[end] in known and pairs[end] not in pairs[start:end]:
                    dice = 2 * len(held & known) / (len(held) + len(known))
                    if best is None or dice >= best[0]:
                        best = (dice, end - start, start, end, name)
            if best and best[0] * 100 >= least:
                found.append(best)
    kept = []
    for one in sorted(found, reverse=True):
        if all(one[3] < k[2] or k[3] < one[2] for k in kept):
            kept.append(one)
    return ",".join(sorted({k[4] for k in kept})), round(max((k[0] for k in kept), default=0.0), 9)


def test_passages_are_those_of_brute_force(spark):
    rng = random.Random(4)
    short = [(f"t{i}", " ".join(rng.choices("abcdefgh", k=rng.randrange(3, 12)))) for i in range(6)]
    texts = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += rng.choices("abcdefghxy", k=rng.randrange(6))
            base = rng.choice(short)[1].split()
            words += [w for w in base for _ in range(rng.choice([1, 1, 1, 2, 7])) if rng.random() < 0.95]
        texts.append(" ".join(words))
    # one word of a template seven times over
    texts += ["a b c d d d d d d d e f g h", None, "", "a", "a b c d e f g h " * 40, "d " * 300]
    templates = [*short, ("eight", "a b c d e f g h")]
    for least in (85, 60):
        docs = documents(spark, [row(i, t) for i, t in enumerate(texts)])
        found = licences(docs, ("doc_id",), templates=templates, least=least, anywhere=True).collect()
        got = {r["doc_id"]: (r["licences"], round(r["best_dice"], 9)) for r in found}
        assert got == {i: brute_passages(t, templates, least) for i, t in enumerate(texts)}
    assert "eight" in brute_passages(texts[60], templates, 85)[0]


def test_registered_query_on_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["licences"], round(r["best_dice"], 9)) for r in op6_licences(spark, "/root/testdata/sf0.01").collect()}
    some = {r["doc_id"] for r in docs if got[r["doc_id"]][0]}
    assert some and got == {r["doc_id"]: brute_passages(r["text"]) for r in docs}
