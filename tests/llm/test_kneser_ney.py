import math
import zlib
from collections import Counter, defaultdict

import pytest

from hearthline.llm.common import doc_bucket
from hearthline.llm.kneser_ney import count_model, discounts, kneser_ney_scores, score_documents


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]


def brute(rows, fold=2):
    """Base and model scores of each row by the formulas."""
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == fold for i, _ in rows]
    train = [tokens(t) for (_, t), h in zip(rows, held) if not h]
    one, two = Counter(w for s in train for w in s), Counter(p for s in train for p in zip([None, *s], s))
    total, words = sum(one.values()), len(one)
    context, before = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (v, w), c in two.items():
        context[v][0] += c
        context[v][min(c, 3)] += 1
        before[w] += 1
    d2, d1 = (discounts([sum(c == k for c in x.values()) for k in (1, 2, 3, 4)]) for x in (two, before))
    types = sum(before.values())

    free = sum(d1[min(n, 3)] for n in before.values()) / types

    def low(w):
        return max(before[w] - d1[min(before[w], 3)], 0) / types + free / (words + 1)

    def p(v, w):
        if v is not None and v not in one:
            return low(w)
        c, (n, *classes) = two[v, w], context[v]
        return max(c - d2[min(c, 3)], 0) / n + sum(d * k for d, k in zip(d2[1:], classes)) / n * low(w)

    out = []
    for (i, t), h in zip(rows, held):
        s = tokens(t)
        base = sum(math.log10((one[w] + 1) / (total + words + 1)) for w in s)
        out.append((i, h, len(s), sum(w in one for w in s), total, base, sum(math.log10(p(v, w)) for v, w in zip([None, *s], s))))
    return out


def same(got, expected):
    def key(r):
        return (-1 if r[0] is None else r[0], *r[1:5], round(r[5], 4))

    assert len(got) == len(expected)
    for g, e in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key)):
        assert g[:5] == e[:5]
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)


@pytest.mark.parametrize("bucket_chars", [20_000, 24_000_000])
def test_against_brute_force(spark, small, bucket_chars):
    rows = [(r.doc_id, r.text) for r in small("documents").collect()]
    same(kneser_ney_scores(small("documents"), bucket_chars=bucket_chars).collect(), brute(rows))


def test_odd_documents(spark, odd):
    from tests.llm.conftest import odd_rows

    same(kneser_ney_scores(odd).collect(), brute([d[:2] for d in odd_rows()]))


def test_probabilities_add_up_to_one(spark, small):
    docs = small("documents").limit(5)
    model = count_model(docs)
    vocabulary = sorted({w for r in docs.collect() for w in tokens(r.text)} - {"\n"})
    rows = [(i, f"the {w}") for i, w in enumerate([*vocabulary, "unknown-word"])]
    scored = score_documents(spark.createDataFrame(rows, "doc_id long, text string"), model, doc_bucket("doc_id", 7) == 9).collect()
    first = score_documents(spark.createDataFrame([(0, "the")], "doc_id long, text string"), model, doc_bucket("doc_id", 7) == 9).first()
    assert len(scored) == len(vocabulary) + 1 and first.score < 0


def test_frequent_words_have_pairs_in_all_buckets(spark):
    rows = [(i, " ".join(f"the w{(i * 7 + k) % 900}" for k in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(kneser_ney_scores(docs, bucket_chars=2_000).collect(), brute(rows))


def test_nothing_to_learn_from(spark):
    rows = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    got = kneser_ney_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert got and all((r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in got)


def test_empty(spark, empty):
    assert kneser_ney_scores(empty).collect() == []


def test_a_store_that_is_not_mounted_is_refused(spark, empty, monkeypatch):
    from hearthline.llm import kneser_ney

    monkeypatch.setattr(kneser_ney, "shared_dir", lambda spark, purpose: "hdfs://store/x")
    with pytest.raises(ValueError, match="mounted"):
        count_model(empty)
