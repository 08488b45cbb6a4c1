import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from hearthline.llm import signature_trees
from hearthline.llm.components import components
from hearthline.llm.signature_trees import enough, leaf_pairs, linked, marked_pairs, near_duplicates, overlap, packed_marks, prefix


def sets_of(texts):
    out = {}
    for i, text in texts:
        w = (text or "").encode().lower().split()
        out[i] = frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute(sets):
    """{key: smallest key reachable} by comparing all pairs with a common shingle."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for token in s:
            holders[token].append(i)
    for i, s in sets.items():
        for j, common in Counter(j for t in s for j in holders[t] if j < i).items():
            if 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def check(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in texts], "doc_id long, text string").repartition(5)
    sets = sets_of(texts)
    expected = brute(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == {i: (len(s), expected[i]) for i, s in sets.items()}


def copies(n, rng, most=0.25):
    """Texts around a few originals, from equal to below the threshold, in chains, with a common line."""
    vocabulary = [f"w{i}" for i in range(500)]
    originals = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 150))] for _ in range(max(1, n // 12))]
    line = [rng.choice(vocabulary) for _ in range(12)]
    out = []
    for i in range(n):
        words = list(rng.choice(originals))
        for _ in range(int(rng.random() * most * len(words) / 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append((i, " ".join(words + line * rng.randint(0, 1))))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    check(spark, copies(250, random.Random(seed)))


def test_crowded_groups_are_cut_into_several_trees(spark, monkeypatch):
    monkeypatch.setattr(signature_trees, "TREE_SIZE", 8)
    check(spark, copies(200, random.Random(9)))


def test_classes_without_ids_are_linked(spark):
    """Near copies whose ids are null, one of them as the bridge between two ids, and rows that repeat."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]

    def text(n=100):
        return [rng.choice(words) for _ in range(n)]

    def near(base, k):
        return [*base[:-k], *text(k)]

    def row(doc_id, words):
        return doc_id, " ".join(words)

    one, bridge, nameless = text(), text(), text()
    left, right = [*text(16), *bridge], [*bridge, *text(16)]
    rows = [row(7, one), row(None, near(one, 3)), row(None, near(one, 4))]
    rows += [row(20, left), row(None, bridge), row(30, right)]
    rows += [row(None, nameless), row(None, near(nameless, 2))]
    repeated = text()
    rows += [row(None, repeated)] * 5 + [row(50, near(repeated, 3)), row(51, near(repeated, 2))] * 2
    assert brute(sets_of([(20, rows[3][1]), (30, rows[5][1])])) == {20: 20, 30: 30}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(docs).collect())
    assert got == Counter({(7, 7): 1, (None, 7): 2, (20, 20): 1, (None, 20): 1, (30, 20): 1, (None, None): 2, (None, 50): 5, (50, 50): 2, (51, 50): 2})


def test_documents(spark, small):
    check(spark, [(r.doc_id, r.text) for r in small("documents").collect()])


def test_odd_documents(spark, odd):
    from tests.llm.conftest import odd_rows

    rows = near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows())
    by_id = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert by_id[1, 0] == 1 and by_id[2, 0] == 2 and by_id[3, 0] == 3 and by_id[None, 0] is None
    assert by_id[4, 1] == by_id[5, 1] == 4
    prose = len(sets_of(odd_rows_texts())[6])
    assert by_id[6, prose] == 6 and by_id[7, prose + 1] == 6 and by_id[6, 1] == 6
    assert by_id[11, 29_996] == 11


def odd_rows_texts():
    from tests.llm.conftest import odd_rows

    return [(d[0], d[1]) for d in odd_rows()[:7]]


def test_empty(spark, empty):
    assert near_duplicates(empty).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_trees_lose_no_pair(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = []
    for _ in range(60):
        keep = base[rng.random(400) < rng.choice([0.3, 0.85, 0.95, 1.0])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    truth = {(i, j) for j in range(60) for i in range(j) if enough(overlap(sets[i], sets[j]), sizes[i], sizes[j])}
    assert truth and truth <= set(map(tuple, leaf_pairs(sets, sizes).tolist()))
    marks = [packed_marks(s) for s in sets]
    assert truth <= set(map(tuple, marked_pairs(marks, sizes).tolist()))
    links = linked(np.arange(60), sets)
    assert set(links) <= truth and len(links) < 60


def test_similar_sets_share_a_prefix_token():
    rng = np.random.default_rng(3)
    frequent = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
    for n in range(1, 80):
        a = np.unique(np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64), frequent[: n % 50]]))
        b = a[rng.permutation(len(a))[: -(-4 * len(a) // 5)]]
        assert set(prefix(a, frequent)[0].tolist()) & set(prefix(np.sort(b), frequent)[0].tolist())


def test_longer_prefixes_share_more_tokens():
    rng = np.random.default_rng(5)
    frequent = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
    for n in range(1, 80):
        a = np.unique(np.concatenate([rng.integers(0, 2**63, n).astype(np.uint64), frequent[: n % 50]]))
        must = -(-4 * len(a) // 5)
        b = np.sort(a[rng.permutation(len(a))[:must]])
        for least in (2, 4, 9):
            both = set(prefix(a, frequent, least)[0].tolist()) & set(prefix(b, frequent, least)[0].tolist())
            assert len(both) >= min(least, must)


def test_texts_with_few_common_words_stay(spark, monkeypatch):
    """Two texts that share a passage of nine words out of a hundred are never fetched; near copies are."""
    rng, moved = random.Random(6), []

    def text(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    rows = []
    for i in range(200):
        passage = text(9)
        rows += [(4 * i, " ".join(passage + text(91))), (4 * i + 1, " ".join(text(91) + passage))]
    for i in range(5):
        body = text(100)
        rows += [(4 * i + 2, " ".join(body)), (4 * i + 3, " ".join(body[:-2] + text(2)))]
    fetch = signature_trees._texts

    def spy(docs, wanted, buckets):
        moved.append(wanted.count())
        return fetch(docs, wanted, buckets)

    monkeypatch.setattr(signature_trees, "_texts", spy)
    check(spark, rows)
    assert 10 <= moved[0] < 60


def test_a_class_is_in_one_tree_of_a_group(spark):
    """Ten tokens that parts of one group have: a class comes once, not once a token, and all pairs of a token meet."""
    rows = [(100 + t, c, 50, c) for t in range(10) for c in range(6) if c != 1 + t % 5]
    rows += [(200, 7, 50, 7), (200, 8, 50, 7), (300, 3, 50, 3), (300, 9, 60, 9)]
    cut = signature_trees._cut(spark.createDataFrame(rows, "token long, cls long, n long, label long"), 128).collect()
    assert sorted((r.token, r.cls, r.n, r.i, r.j) for r in cut) == [(0, c, 50, 0, 0) for c in range(6)] + [(3, 3, 50, 0, 0), (3, 9, 60, 0, 0)]
    trees = defaultdict(set)
    for r in signature_trees._cut(spark.createDataFrame(rows, "token long, cls long, n long, label long"), 2).collect():
        trees[r.token, r.i, r.j].add(r.cls)
    met = {(a, b) for t in trees.values() for a in t for b in t}
    own = defaultdict(set)
    for token, c, *_ in rows[:-4] + rows[-2:]:
        own[token].add(c)
    assert {(a, b) for t in own.values() for a in t for b in t} <= met


def test_bitmap_of_wanted_texts(spark):
    docs = spark.range(5000).selectExpr("xxhash64(id) as key", "cast(id as string) as text", "id")
    wanted = docs.where("id % 10 = 0").select("key")
    got = {r.text for r in signature_trees._maybe_wanted(docs, wanted).collect()}
    assert {str(i) for i in range(0, 5000, 10)} <= got and len(got) < 520
    assert signature_trees._maybe_wanted(docs, wanted.limit(0)).collect() == []


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, 400), (400, 450)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, 400: 400, 450: 400, 500: 400}
