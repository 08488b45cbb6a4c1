import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearthline.llm.common import DOCUMENT_COLUMNS
from hearthline.llm.line_rules import line_rules
from hearthline.llm.queries import WORD_BPE
from hearthline.session import staged
from tests.llm.conftest import SMALL
from tests.llm.test_crf_pii import MODEL, plain
from tests.llm.test_signature_trees import brute, sets_of


@pytest.fixture(scope="module")
def stages(spark, small):
    """The documents before and after each stage."""
    out = {"documents": small("documents").select(DOCUMENT_COLUMNS)}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = staged(stage(spark, docs, SMALL), f"test-{name}")
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "personal_data", "mix", "encode"]
    assert all(stages[n].columns == DOCUMENT_COLUMNS for n in list(stages)[:-1])


def test_quality_keeps_just_what_the_rules_keep(stages, small):
    kept = {r.doc_id for r in line_rules(small("documents"), small("labels")).where("kept").collect()}
    assert {tuple(r) for r in stages["quality"].collect()} == {tuple(r) for r in stages["documents"].collect() if r.doc_id in kept}


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r for r in stages["quality"].collect()}
    heads = brute(sets_of([(i, r.text) for i, r in before.items()]))
    assert {tuple(r) for r in stages["near_copies"].collect()} == {tuple(before[i]) for i in set(heads.values())}


def test_personal_data_is_replaced(stages):
    before = {r.doc_id: r for r in stages["near_copies"].collect()}
    after = {r.doc_id: r for r in stages["personal_data"].collect()}
    assert set(before) == set(after)
    for i, r in after.items():
        assert plain(r.text) == [] and r.n_chars == len(r.text)
        assert r.text == before[i].text or plain(before[i].text) or "[" in r.text


def test_mix_takes_words_of_its_documents(stages):
    before = {r.doc_id: r.text.split() for r in stages["personal_data"].collect()}
    taken = {}
    for r in stages["mix"].collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.split())
    assert all(n <= 2 * len(before[i]) for i, n in taken.items())
    total = sum(map(len, before.values()))
    assert abs(sum(taken.values()) - 1.5 * total) < 0.05 * total


def test_tokens(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    ids = sorted(library.encode(r.text, add_special_tokens=False).ids for r in stages["mix"].collect())
    assert sorted(r.ids for r in stages["encode"].collect()) == ids


def test_run_gives_the_rows_of_the_stages(spark, stages):
    columns = ["doc_id", "n_tokens", "ids_sha256"]
    assert sorted(corpus_pipeline.run(spark, SMALL).select(columns).collect()) == sorted(stages["encode"].select(columns).collect())


def test_stages_take_odd_documents(spark, odd):
    """Documents at the edges, and none at all, pass through every stage."""
    for docs in (odd.select(DOCUMENT_COLUMNS), odd.select(DOCUMENT_COLUMNS).where(F.lit(False))):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SMALL).collect() is not None


def test_wordless_and_unnamed_documents_in_the_copies_stage(spark, odd):
    rows = corpus_pipeline.near_copies(spark, odd.select(DOCUMENT_COLUMNS), SMALL).collect()
    ids = [r.doc_id for r in rows]
    assert {1, 2, 3, 4, 6, 9, 10, 11} <= set(ids) and not {5, 7, 8} & set(ids)
    assert ids.count(6) == 2  # the repeated row once, and another text of that id


def test_copies_go_whatever_their_ids(spark):
    """Null ids in several groups, and an id that is the head of one group and a copy in another."""

    def text(name, end):
        return " ".join([*(f"{name}{i}" for i in range(100)), end])

    rows = [(1, text("a", "x")), (2, text("a", "y")), (2, text("b", "x")), (3, text("b", "y"))]
    rows += [(None, text("c", "x")), (None, text("c", "y")), (None, text("d", "x")), (5, text("d", "y")), (None, text("e", "x"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text[0]) for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()]
    assert sorted(kept, key=str) == sorted([(1, "a"), (2, "b"), (None, "c"), (5, "d"), (None, "e")], key=str)


def test_model_is_trained_once():
    assert MODEL.emission.shape[1] == 5
