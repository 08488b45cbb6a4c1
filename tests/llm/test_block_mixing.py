import numpy as np
import pytest

from hearthline.llm.block_mixing import draw_counts, mixed_documents, permuted, place_of, plan_mix, taken_words, target_sizes


def words(text):
    return (text or "").encode().split()


def test_targets():
    assert target_sizes([100, 100, 100]) == [200.0, pytest.approx(250 / 3), pytest.approx(500 / 3)]
    assert target_sizes([10, 1000, 10]) == [20.0, pytest.approx(1490.0), 20.0]
    assert target_sizes([0, 5]) == [0.0, 7.5]
    assert target_sizes([]) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    orders = [permuted(np.arange(n), n, key).tolist() for key in (1, 2)]
    assert all(sorted(o) == list(range(n)) for o in orders)
    assert n < 17 or orders[0] != orders[1] != list(range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_places_in_a_permutation(n):
    order = permuted(np.arange(n), n, 20240501 + 1_000_003).tolist()
    assert [place_of(v, n, 20240501 + 1_000_003) for v in order] == list(range(n))


@pytest.mark.parametrize("epochs", [0.3, 1.5, 1.9])
def test_sources_of_any_size_come_to_their_targets(spark, epochs):
    sizes = {"a": 1, "b": 50, "c": 150, "d": 1000, "e": 127, "f": 129, "g": 385, "h": 3000}
    rows = []
    for s, n in sizes.items():
        cuts = [0, n // 3, n // 2, n]
        rows += [(f"{s}{k}", s, " ".join(f"w{i}" for i in range(a, b))) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    docs = spark.createDataFrame([(i, t, s) for i, (_, s, t) in enumerate(rows)], "doc_id long, text string, source string")
    mix = plan_mix(docs, epochs_total=epochs)
    names = {i: s for i, (_, s, _) in enumerate(rows)}
    taken, target, slots = dict.fromkeys(sizes, 0), {}, dict.fromkeys(range(len(sizes)), 0)
    for r in taken_words(mix).collect():
        taken[names[r.doc_id]] += r.taken
        target[names[r.doc_id]] = r.target
        assert r.taken <= 2 * r["size"]
    assert {s: abs(taken[s] - target[s]) <= 0.5 for s in sizes} == dict.fromkeys(sizes, True)
    for r in mix.slots.collect():
        assert r.words > 0
        slots[r.s] += r.words
    assert list(slots.values()) == list(taken.values())


def test_counts_add_up_to_the_quotas():
    quotas = np.array([0, 5, 1000, 37])
    counts = draw_counts(quotas, 16, 3)
    assert counts.sum(axis=0).tolist() == quotas.tolist()
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1


def test_whole_mix(spark, small):
    docs = small("documents")
    mix = plan_mix(docs, block_words=64)
    rows = taken_words(mix).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    assert {r.doc_id: r["size"] for r in rows} == {i: len(words(t.text)) for i, t in texts.items()}
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    by_source = {}
    for r in rows:
        own = by_source.setdefault(texts[r.doc_id].source, [0, 0, r.target, r.source_size])
        own[0] += r["size"]
        own[1] += r.taken
    assert all(size == source_size for size, _, _, source_size in by_source.values())
    assert all(abs(taken - target) <= 3 * 64 for _, taken, target, _ in by_source.values())
    expected = target_sizes([by_source[s][0] for s in sorted(by_source)])
    assert [by_source[s][2] for s in sorted(by_source)] == pytest.approx(expected)
    assert sorted(map(tuple, taken_words(plan_mix(docs.repartition(7), block_words=64)).collect())) == sorted(map(tuple, rows))


def test_slots_use_each_block_once_per_epoch(spark, small):
    slots = plan_mix(small("documents"), block_words=64).slots.collect()
    keys = [(r.s, r.block, r.epoch) for r in slots]
    assert len(keys) == len(set(keys)) and max(r.epoch for r in slots) <= 1


def test_texts_hold_the_taken_words(spark, small):
    docs = small("documents")
    taken = {r.doc_id: r.taken for r in taken_words(plan_mix(docs)).collect()}
    texts = {r.doc_id: r for r in docs.collect()}
    got = {}
    for r in mixed_documents(docs).collect():
        own = words(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(own)
        assert (r.lang, r.source, r.n_chars) == (texts[r.doc_id].lang, texts[r.doc_id].source, len(r.text))
        rest = iter(words(texts[r.doc_id].text))
        assert all(w in rest for w in own)
    assert got == {i: n for i, n in taken.items() if n}


def test_odd_documents(spark, odd):
    from tests.llm.conftest import odd_rows

    rows = taken_words(plan_mix(odd, block_words=8)).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted((d[0] or -1, len(words(d[1]))) for d in odd_rows())
    assert all(r.taken <= 2 * r["size"] for r in rows)
    mixed = mixed_documents(odd, block_words=8).collect()
    assert sum(len(words(r.text)) for r in mixed) == sum(r.taken for r in rows)


def test_empty(spark, empty):
    assert taken_words(plan_mix(empty)).collect() == []
    assert mixed_documents(empty).collect() == []
