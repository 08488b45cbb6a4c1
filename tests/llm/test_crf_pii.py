import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from hearthline.llm.crf_pii import _MAYBE, _TRIGGER, KINDS, decode, chains, find_personal_data, find_spans, labelled_table, luhn, pattern_spans, plausible, redacted, train_pii_model, written

MODEL = train_pii_model(labelled_table())


def plain(text):
    """The four patterns as they are stated."""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind != 2 or luhn(digits)):
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


TEXT = st.lists(st.sampled_from(["a", "b.c", "@", ".", "x@y.z", "_", "1", "25", "255", "256", ".", "4111 1111 1111 1111", "-", " ", "+1 (555) 010-9999", "+", "(", "\n", "é"]), max_size=25).map("".join)


@given(TEXT)
def test_patterns(text):
    assert pattern_spans(text) == plain(text)


def test_patterns_of_documents(small):
    for r in small("documents").collect():
        assert pattern_spans(r.text) == plain(r.text)


def test_long_runs_take_linear_time():
    assert pattern_spans("a" * 300_000 + " @ " + "1" * 300_000 + " +" + "(" * 300_000) == []


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_field_finds_other_spellings():
    """Held-out sentences of the rule that makes the labelled table."""
    found = missed = wrong = 0
    for text, spans in labelled_table(200, seed=99):
        got = {s for sequence in decode(MODEL, chains(text)) for s in sequence}
        found, missed, wrong = found + len(got & set(spans)), missed + len(set(spans) - got), wrong + len(got - set(spans))
    assert found > 9 * missed and found > 9 * wrong


def test_added_spans():
    def added(text):
        return [(KINDS[k], text[a:b]) for a, k, b in find_spans(MODEL, [text])[0][1]]

    assert added("please call 555-123-4567 now") == [("phone", "555-123-4567")]
    assert added("mail bob [at] mail [dot] org") == [("email", "bob [at] mail [dot] org")]
    assert added("Licensed under the Apache License, Version 2.0.") == []
    assert added('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"') == []
    assert added("x.y@mail.example.com and +1 (555) 123-4567") == []


SPELLINGS = ["bob at example dot com", "bob [at] example [dot] com", "bob (at) example (dot) com", "bob[at]example[dot]com", "bob(at)example(dot)com", "bob at example.com", "bob@example.com"]
PROSE = "Anyone who has lost the key of the garden house and wants another one should not wait any longer"


def test_trained_spellings_in_prose_without_digits(spark):
    texts = [f"{PROSE}. Please write to {mail}{end} {PROSE}." for mail in SPELLINGS for end in (" and say so.", ".")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find_personal_data(docs, with_text=True).collect():
        text, mail = texts[r.doc_id], SPELLINGS[r.doc_id // 2]
        assert r.spans == f"email:{text.index(mail)}:{text.index(mail) + len(mail)}", text
        assert r.redacted_text == text.replace(mail, "[EMAIL]")


def test_prose_with_at_gets_nothing():
    for text in ("We met at home. The rest had gone.", "We met at home. Then 30 went.", "He stayed at work. com", "She is good at chess; at night. Or not."):
        assert find_spans(MODEL, [f"{PROSE}. {text} {PROSE}."]) == [([], [])]


PART = st.sampled_from(["bob", "at", "AT", "dot", "é", "x-y", "-", ".", "[", "]", "(", ")", " ", "\t", "\u00a0", "\u2003", "com", "@", "+", "_"])


@given(st.lists(PART, max_size=12).map("".join), st.lists(PART, max_size=4).map("".join))
def test_what_can_be_an_address_holds_a_trigger(part, before):
    if plausible(part, (0, 0, len(part))):
        assert _TRIGGER.search(part)
    if _TRIGGER.search(before + part):
        assert _MAYBE.search((before + part).encode())


def test_triggers_take_linear_time():
    for text in ("at " * 200_000, "at-" * 200_000, "at\u00a0" * 200_000, "at " + "a" * 500_000, "até" * 200_000, "at" + " " * 500_000):
        _MAYBE.search(text.encode())
        assert len(list(_TRIGGER.finditer(text))) <= 200_000


def test_clean_documents_get_nothing_more(spark, small):
    rows = find_personal_data(small("documents")).collect()
    assert sum(r.n_added > 0 for r in rows) <= 0.01 * len(rows)


def test_query_columns(spark, odd):
    from tests.llm.conftest import odd_rows

    rows = find_personal_data(odd, carry=["doc_id", "text"], with_text=True).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        base = plain(r.text or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert set(written(base).split(",")) <= set(r.spans.split(","))
        if not r.spans:
            assert r.redacted_text == (r.text or "")
    eight = next(r for r in rows if r.doc_id == 8)
    assert eight.redacted_text.startswith("mail [EMAIL], [IP], [PHONE], [CARD]\nWort0")


def test_redaction_of_overlapping_spans():
    assert redacted("0123456789", [(2, 2, 5), (4, 3, 8)]) == "01[CARD]89"


def test_empty(spark, empty):
    assert find_personal_data(empty).collect() == []
