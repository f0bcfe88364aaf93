import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import byte_pairs
from ledgerlens.llm.byte_pairs import BytePairs, decode, encode, op12_byte_pairs
from tests.llm.rows import documents, no_documents, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(PATH)


def odd_texts(seed, n):
    """Texts of pieces that a cut may change: contractions, white space, special tokens and parts of them, long runs."""
    rng = random.Random(seed)
    pieces = ["hello", " world", "'s", "'re", "'", "  ", "\n\n", "\t", " ", "é", "数据处理", "🙂🙂", "<|endoftext|>", "<|endof", "text|>", "12345", "x", "!!!", "ing", "İ", " ", "\x00", "ß"]
    for _ in range(n):
        text = ""
        for _ in range(rng.randrange(1, 60)):
            piece = rng.choice(pieces)
            text += piece * rng.choice([1, 1, 1, 2, 3, 40, 300])
            if rng.random() < 0.1:
                text += "".join(rng.choices("abcdefghij", k=rng.randrange(400)))
            if rng.random() < 0.05:
                text += "".join(rng.choices("!'.,;", k=rng.randrange(400)))
            if rng.random() < 0.05:
                text += "".join(rng.choices(" \t\n", k=rng.randrange(400)))
        yield text


@pytest.mark.parametrize("leaf", [37, 150, 1000])
def test_trees_give_what_the_library_gives(pairs, library, leaf):
    for text in odd_texts(leaf, 150):
        node = pairs.node(text, leaf)
        expected = library.encode(text, add_special_tokens=False)
        assert node.ids.tolist() == expected.ids
        assert node.opens.tolist() == (np.diff(expected.word_ids, prepend=-1) != 0).tolist()


@pytest.mark.parametrize("text", ["x" * 30001, "ab" * 9000 + "c", " " * 5000 + "x", "!" * 4000 + "'s", "é" * 7001, "数" * 3000, "<|endoftext|>" * 900, "0123456789" * 700])
def test_texts_that_are_not_split(pairs, library, text):
    for leaf in (500, 1024, 4099):
        assert pairs.node(text, leaf).ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_windows_stay_small(pairs, monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choices("etaoinshrdlu", k=60000))
    nodes = pairs._nodes([text[:30000], text[30000:]])
    sizes = []
    inner = pairs._nodes
    monkeypatch.setattr(pairs, "_nodes", lambda texts: (sizes.extend(map(len, texts)), inner(texts))[1])
    joined = pairs.join(*nodes)
    assert max(sizes) < 2000
    assert joined.ids.tolist() == pairs.tokenizer.encode(text, add_special_tokens=False).ids


def test_rows_of_tokens_hold_if_neighbours_do(library):
    # what joining rests on: each token stands for itself, and so does each two that follow each other
    tokens = library.get_vocab()
    kept = random.Random(1).sample(sorted(set(tokens.values())), 3000)
    for i in kept:
        text = library.decode([i], skip_special_tokens=False)
        if "�" not in text:
            words = library.pre_tokenizer.pre_tokenize_str(text)
            if len(words) == 1:
                assert library.encode(text, add_special_tokens=False).ids == [i]


def expected_rows(rows, library):
    out = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        out.append((r[0], ids, library.decode(ids, skip_special_tokens=False)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("leaf", "part"), [(byte_pairs.LEAF, byte_pairs.PART), (64, 256), (100, 1000)])
def test_odd_documents(spark, library, leaf, part):
    encoded = encode(documents(spark), PATH, leaf, part)
    got = [(r["doc_id"], list(r["ids"]), r["text"]) for r in decode(encoded, PATH).collect()]
    assert sorted(got, key=str) == expected_rows(odd_documents(), library)


def test_no_documents(spark):
    assert decode(encode(no_documents(spark), PATH), PATH).collect() == []


def test_decoding_any_ids(spark, library):
    rng = random.Random(3)
    rows = [(i, rng.choices(range(50257), k=rng.randrange(40))) for i in range(200)] + [(200, None), (201, []), (202, [1, 99999, 2])]
    got = {r["doc_id"]: r["text"] for r in decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    assert got == {i: None if ids is None else library.decode(ids, skip_special_tokens=False) for i, ids in rows}
    odd = decode(spark.createDataFrame([(1, [5, None, 6], "x")], "doc_id long, ids array<int>, TEXT string"), PATH).collect()
    assert odd[0]["text"] == library.decode([5, 6], skip_special_tokens=False)


def test_registered_query_on_the_sample(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        assert text == (r["text"] or "")
        expected[r["doc_id"]] = (len(ids), *digests)
    got = op12_byte_pairs(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs) and {r["doc_id"]: tuple(r)[1:] for r in got} == expected
