import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm.common import written
from ledgerlens.llm.packing import WordTokens, encode, place, plan
from tests.llm.rows import documents, no_documents, odd_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokens():
    return WordTokens(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def same(tokens, tokenizer, texts):
    for text, ids in zip(texts, tokens.ids(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_every_token_by_itself(tokens, tokenizer):
    """Both ways merge in the same order if they agree on the text of every entry of the vocabulary."""
    with open(PATH) as f:
        vocabulary = json.load(f)["model"]["vocab"]
    texts = []
    for ids in np.array_split(np.arange(len(vocabulary) - 2), 200):
        texts.append(" ".join("".join(c for c in w.removesuffix("</w>") if c.isalnum()) for w in map(tokenizer.id_to_token, ids.tolist())))
    same(tokens, tokenizer, texts)


def test_characters(tokens, tokenizer):
    same(tokens, tokenizer, [f"a{chr(i)}b {chr(i)} {chr(i)}{chr(i)} 'S{chr(i)}x 7{chr(i)}" for i in range(1, 1200)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(texts):
    same(WordTokens._shared, Tokenizer.from_file(PATH), texts)


WordTokens._shared = WordTokens(PATH)


def check_plan(counts, limit):
    used, made = Counter(), 0
    for times, of in plan(counts, limit):
        assert times > 0 and sum(n * k for n, k in of.items()) <= limit
        made += times
        for n, k in of.items():
            used[n] += times * k
    assert used == Counter({n: c for n, c in counts.items() if c})
    return made


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 60), max_size=12))
def test_plan_uses_every_piece_once(counts):
    made = check_plan(counts, 32)
    assert made >= -(-sum(n * c for n, c in counts.items()) // 32)


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(2)
    lengths = np.minimum(2048, rng.lognormal(5.8, 1.1, 200_000).astype(int) + 1)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    bound = -(-int(lengths.sum()) // 2048)
    assert check_plan(counts, 2048) <= bound * 1.001 + 1


def test_plan_finds_exact_complements():
    assert check_plan({20: 5, 12: 5}, 32) == 5
    assert check_plan({20: 5, 7: 5, 5: 5}, 32) == 5
    assert check_plan({20: 5, 6: 5, 4: 5, 2: 5}, 32) == 5
    assert check_plan({}, 32) == 0


def packed(spark, docs, limit=2048):
    return [r.asDict() for r in place(written(encode(docs, PATH, limit), "pieces"), limit).collect()]


@pytest.mark.parametrize("limit", [16, 2048])
def test_odd_rows(spark, tokenizer, limit):
    rows = packed(spark, documents(spark).repartition(3), limit)
    want = Counter()
    for r in odd_documents():
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), limit)):
            cut = np.array(ids[start : start + limit], "<u4").tobytes()
            want[r[0], piece, start, len(cut) // 4, zlib.crc32(cut)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= limit
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // limit) * 1.1 + 2


def test_no_rows(spark):
    assert packed(spark, no_documents(spark)) == []
