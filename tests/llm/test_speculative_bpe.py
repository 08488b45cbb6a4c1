import hashlib
import unicodedata

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hearthline.llm.common import words
from hearthline.llm.queries import WORD_BPE
from hearthline.llm.speculative_bpe import Encoder, Vocabulary, bpe_encode

LIBRARY = Tokenizer.from_file(WORD_BPE)
VOCABULARY = Vocabulary(open(WORD_BPE, encoding="utf-8").read())
ENCODER = Encoder(VOCABULARY)


def encode(text):
    return [t for ids in ENCODER.encode(words(text.encode())) for t in ids]


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aeioustnr'dl<|>!0é̀ΣİßÅ \x85 中\U0001f642", max_size=80))
def test_like_the_library(text):
    assert encode(text) == expected(text)


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 3000, "!" * 900, "<|endoftext|>x<|startoftext|><|endoftext|>y <|endoftext", "don'T 's'tx ΑΣ.", "the " * 50])
def test_edges(text):
    assert encode(text) == expected(text)


def test_newer_letters():
    """Characters that Python's tables don't hold: letters, numbers and capitals as the library has them."""
    unassigned = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn"]
    texts = [f":{c}a" for c in unassigned if regex.match(r"[\p{L}\p{N}]", c)] + [":\U00013460", "A\ua7ceb", "\U00010d50x:", "\u1c89", "1\U00016130"]
    for text, ids in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == ids.ids, ascii(text)


def test_speculation_is_verified():
    """Among real words some greedy proposals are wrong, and all of these are caught."""
    pieces = ["unbelievable", "internationalisation", "nstththan", "ereading", "ththtion", "hello", "onouering"]
    exact = [VOCABULARY.merged(VOCABULARY.symbols(p)) for p in pieces]
    assert VOCABULARY.encode_pieces(pieces) == exact
    assert VOCABULARY.merged([1] * 100) == VOCABULARY._merged_by_heap([1] * 100)
    assert any(VOCABULARY.greedy(p) != e for p, e in zip(pieces, exact))


def test_documents(spark, small):
    texts = {r.doc_id: r.text for r in small("documents").collect()}
    for r in bpe_encode(small("documents"), WORD_BPE).collect():
        ids = expected(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_documents(spark, odd):
    from tests.llm.conftest import odd_rows

    got = sorted((r.doc_id or -1, r.ids) for r in bpe_encode(odd, WORD_BPE).collect())
    assert got == sorted((d[0] or -1, expected(d[1] or "")) for d in odd_rows())


def test_empty(spark, empty):
    assert bpe_encode(empty, WORD_BPE, ids=False).collect() == []
