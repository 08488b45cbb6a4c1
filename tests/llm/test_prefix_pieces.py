import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.llm.prefix_pieces import Encoder, Pieces, piece_encode
from tests.llm.conftest import odd_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PIECES = Pieces(open(MODEL, "rb").read())
ENCODER = Encoder(PIECES)


def encode(text):
    return [i for row in ENCODER.encode(text) for i in row[3]] + [PIECES.end]


def expected(text):
    return LIBRARY.encode(text, add_eos=True)


FRAGMENTS = st.lists(st.sampled_from(["the", "in", "tion", " ", "  ", "   ", "\n", "▁", "é", "中", "http", "://", "1", "0", "\U0001f642", "er", "s", "'", "St", "\t", "\x00", "́"]), max_size=30).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.text(max_size=60) | FRAGMENTS | st.text(alphabet="aeiourstnlhd ", max_size=60))
def test_like_the_library(text):
    ids = encode(text)
    assert ids == expected(text)
    assert PIECES.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 500) | st.integers(0, 31_999), max_size=20))
def test_decoding_of_any_ids(ids):
    assert PIECES.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("n", [*range(36), 63, 64, 65, 100])
def test_runs_of_spaces(n):
    for text in (" " * n, " " * n + "the", "a" + " " * n + "b", "\n" + " " * n):
        assert encode(text) == expected(text)


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 3000, "the" * 4000, "中文字" * 3000, "\U0001f642" * 500, "<s></s><unk><0x0A>", "﻿​�", "x\r\ny\x0b\x0c"])
def test_edges(text):
    assert encode(text) == expected(text)
    assert PIECES.decode(encode(text)) == LIBRARY.decode(expected(text))


def test_every_prefix_has_one_last_token():
    """The table holds the last token of what the library makes of each prefix, and no other match would do."""
    word = "▁internationalisation"
    last = PIECES._last_tokens(word)
    for n in range(1, len(word) + 1):
        assert last[n] == LIBRARY.encode(word[1:n])[-1] if n > 1 else PIECES.id_of["▁"]
        ending = [i for t, i in PIECES.id_of.items() if word[:n].endswith(t)]
        fits = [i for i in ending if len(PIECES.text_of[i]) == n or PIECES.compatible(last[n - len(PIECES.text_of[i])], i)]
        assert fits == [last[n]]


def test_documents(spark, small):
    texts = {r.doc_id: r.text for r in small("documents").collect()}
    rows = piece_encode(small("documents"), MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_odd_documents(odd):
    got = sorted((r.doc_id or -1, r.ids) for r in piece_encode(odd, MODEL).collect())
    assert got == sorted((d[0] or -1, expected(d[1] or "")) for d in odd_rows())


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(MODEL, "rb").read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        Pieces(proto.SerializeToString())


def test_empty(empty):
    assert piece_encode(empty, MODEL, ids=False).collect() == []
