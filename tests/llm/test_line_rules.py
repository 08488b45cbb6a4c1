import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from hearthline.llm.common import buffers, labelled_sample
from hearthline.llm.crf import LinearChainCRF
from hearthline.llm.line_rules import BOILERPLATE, line_rules, train_line_model
from hearthline.llm.text_stats import TextStats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The base figures, the plain way."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def figures(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_against_brute_force(spark, small):
    docs = small("documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = line_rules(docs, small("labels")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert figures(r) == base(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.content_share >= 0.5)


def test_verdict_agrees_with_held_labels(spark, small):
    """Learnt from the even ids, judged on the odd ones."""
    docs, labels = small("documents"), small("labels")
    kept = {r.doc_id: r.kept for r in line_rules(docs, labels.where("doc_id % 2 = 0")).collect() if not r.base_failed}
    odd = [(kept[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect() if r.doc_id in kept]
    assert sum(k == bool(q) for k, q in odd) >= 0.97 * len(odd)
    assert all(k for k, q in odd if q)


def test_learns_from_all_lines_of_long_documents(spark):
    """Junk that stands behind 200 lines of prose only; copies of an id don't reach the driver."""
    good = "\n".join(f"The river runs past house number {i} and on to the quiet sea." for i in range(200))
    junk = "\n".join(f"$$ BUY ### {i} && >>> *** |||" for i in range(200))
    docs = [(i, good.replace("river", f"river{i}")) for i in range(6)] + [(i, good.replace("sea", f"lake{i}") + "\n" + junk) for i in range(6, 12)] + [(3, good)] * 50
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < 6)) for i in range(12)], "doc_id long, quality int")
    model = train_line_model(docs, labels)
    stats = TextStats(*buffers(pa.array([junk, good], pa.large_string())))
    states = model.viterbi(model.scores(stats.line_features()), np.array([0, 200]))
    assert (states[:200] == BOILERPLATE).all()
    assert labelled_sample(docs, labels, "quality", 5).count() == 10


def test_odd_documents(spark, odd, small):
    from tests.llm.conftest import odd_rows

    labels = small("labels").selectExpr("*", "quality as kept")
    rows = line_rules(odd, labels, carry=["doc_id", "text"]).collect()
    assert sorted((r.doc_id or -1, r.text or "", *figures(r)) for r in rows) == sorted((d[0] or -1, d[1] or "", *base(d[1])) for d in odd_rows())


def test_without_labels_the_base_rules_decide(spark, odd):
    labels = spark.createDataFrame([(None, 1), (6, None), (7, 1)], "doc_id long, quality int")
    assert all(r.kept != r.base_failed for r in line_rules(odd, labels).collect())


def test_empty(spark, empty):
    assert line_rules(empty, spark.createDataFrame([], "doc_id long, quality int")).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_finds_the_best_path(seed):
    rng = np.random.default_rng(seed)
    k, lengths = 3, [1, 5, 2, 6, 1]
    model = LinearChainCRF(np.eye(k), rng.normal(size=(k, k)), rng.normal(size=k))
    scores = rng.normal(size=(sum(lengths), k))
    begins = np.cumsum([0, *lengths[:-1]])
    states = model.viterbi(scores, begins)
    for a, n in zip(begins, lengths):
        def total(path):
            return model.start[path[0]] + sum(scores[a + i, s] for i, s in enumerate(path)) + sum(model.transition[s, t] for s, t in zip(path, path[1:]))

        assert tuple(states[a : a + n]) == max(product(range(k), repeat=n), key=total)


def test_training_raises_the_likelihood_of_the_marks():
    rng = np.random.default_rng(1)
    y = (rng.random((40, 12)) < 0.5).astype(int)
    x = np.stack([y + rng.normal(0, 0.3, y.shape), np.ones(y.shape)], axis=2)
    lengths = rng.integers(1, 13, 40)
    model = LinearChainCRF.train(x, y, lengths, 2)
    flat = np.concatenate([x[i, :n] for i, n in enumerate(lengths)])
    found = model.viterbi(model.scores(flat), np.cumsum(lengths) - lengths)
    truth = np.concatenate([y[i, :n] for i, n in enumerate(lengths)])
    assert (found == truth).mean() > 0.9
