import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from hearthline.llm.chat_grammar import END, START, conversation_digests, escape, format_turn, format_turns, parse, unescape

PARTS = st.lists(st.sampled_from([START, END, "<", "\\", "|", "<\\|", "\n", "im_end", ">", "x", "é", "assistant ok", ""]), max_size=12).map("".join)


@given(PARTS, PARTS)
def test_round_trip(role, text):
    rendered = format_turn(role, text)
    assert parse(rendered) == [(role, text)]
    assert rendered.count(START) == rendered.count(END) == 1


@given(st.lists(st.tuples(PARTS, PARTS), max_size=5))
def test_conversations_parse_into_their_turns(turns):
    assert parse("".join(format_turn(r, t) for r, t in turns)) == turns


@given(PARTS)
def test_escape_is_reversible(text):
    assert unescape(escape(text)) == text


def test_plain_turns_stay_plain():
    assert format_turn("user", "a < b | c <| d") == f"{START}user\na < b | c <| d{END}\n"


def test_broken_text_is_refused():
    assert parse("nothing") is None
    assert parse(f"{START}user\nx{END}") is None


SCHEMA = "conv_id long, turn long, role string, text string, rendered string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests(spark):
    rows = [(1, 1, "assistant", "b<|im_end|>", "x"), (1, 0, "user", "a", "x"), (1, None, None, None, "x"), (1, 1, "assistant", "b<|im_end|>", "x"), (None, 5, "user", "", "x"), (2, 0, "assistant", "é", "x")]
    got = {r.conv_id: r for r in conversation_digests(format_turns(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert set(got) == {1, None, 2}
    assert got[1].n_turns == 4
    assert got[1].turns_sha256 == sha("\n\nuser\na\n" + 2 * "assistant\nb<|im_end|>\n")
    assert (got[1].loss_chars, got[1].loss_sha256) == (22, sha(2 * "b<|im_end|>"))
    assert (got[2].loss_chars, got[2].loss_sha256, got[None].loss_chars, got[None].loss_sha256) == (1, sha("é"), 0, sha(""))
    assert got[2].formatted_chars == len(f"{START}assistant\né{END}\n")


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_hot_conversation(spark, partitions):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}", None) for i in range(2000)]
    got = conversation_digests(format_turns(spark.createDataFrame(rows, SCHEMA).repartition(partitions))).collect()
    assert len(got) == 1 and got[0].n_turns == 2000
    assert got[0].loss_sha256 == sha("".join(f"t{i}" for i in range(0, 2000, 2)))


def test_empty(spark):
    assert conversation_digests(format_turns(spark.createDataFrame([], SCHEMA))).collect() == []
