import numpy as np
import pytest

from hearthline.llm import learned_partitions
from hearthline.llm.learned_partitions import balanced_parts, nearest, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=20, k=20):
    fine = [(i, v) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    ids, x = np.array([i for i, _ in fine]), np.array([v for _, v in fine], float)
    out = {}
    for i, v in fine:
        if i % every == 0 and i not in out:
            score = (x * np.array(v, float)).sum(axis=1)
            others = np.flatnonzero(ids != i)
            top = others[np.lexsort((ids[others], -score[others]))[:k]]
            out[i] = [(int(ids[t]), score[t]) for t in top]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, truth):
    assert set(got) == set(truth)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in truth[q]}) / max(1, len(truth[q])) for q in truth])


def test_recall_and_exact_scores(spark, small):
    rows = [(r.vec_id, list(r.embedding)) for r in small("embeddings").collect()]
    got, truth = found(nearest(small("embeddings")).collect()), brute(rows)
    assert recall(got, truth) >= 0.9
    vectors = {i: np.array(v, float) for i, v in rows}
    for q, hits in got.items():
        assert len(hits) == 20 and q not in {i for i, _ in hits}
        assert all(s == (vectors[i] * vectors[q]).sum() for i, s in hits)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))


def clusters(n, rng, d=16):
    centres = rng.normal(size=(12, d)) * 3
    return [(i, (centres[rng.integers(12)] + rng.normal(size=d)).astype(np.float32).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def test_parts_of_clustered_vectors_suffice(spark):
    rows = clusters(1500, np.random.default_rng(2))
    assert recall(found(nearest(frame(spark, rows), sample=600).collect()), brute(rows)) >= 0.9


def test_few_vectors_give_all_candidates(spark):
    rows = clusters(15, np.random.default_rng(3))
    got = found(nearest(frame(spark, rows)).collect())
    assert recall(got, brute(rows)) == 1 and all(len(h) == 14 for h in got.values())


def test_copies_rank_by_id_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "BLOCK", 64)
    same = [0.5, 0.25, 1.0, 0.125]
    rows = [(i, same) for i in range(700)] + [(i, [float(i % 7), 1.0, 0.0, 0.5]) for i in range(700, 760)]
    got = found(nearest(frame(spark, rows)).collect())
    best = brute(rows)
    assert got[0] == best[0] and got[100] == best[100]


def test_odd_vectors(spark):
    rows = clusters(100, np.random.default_rng(4), d=4)
    odd = [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan"), 1.0, 0.0, 0.0]), (205, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0] * 4), (220, [1.0] * 5)]
    got = found(nearest(frame(spark, rows + odd + rows[:3])).collect())
    assert set(got) == {0, 20, 40, 60, 80}
    assert all(i < 100 for hits in got.values() for i, _ in hits)
    assert all(q != i for q, hits in got.items() for i, _ in hits)


def test_empty(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("parts", [2, 5, 16])
def test_parts_are_balanced_and_cut_few_edges(parts):
    rng = np.random.default_rng(0)
    x = np.array([v for _, v in clusters(400, rng)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = neighbours(x, np.arange(400), 8)
    edges = np.stack([np.repeat(np.arange(400), 8), near.ravel()], axis=1)
    label = balanced_parts(np.unique(np.vstack([edges, edges[:, ::-1]]), axis=0), 400, parts, rng)
    size = np.bincount(label, minlength=parts)
    assert size.max() - size.min() <= parts
    assert (label[edges[:, 0]] == label[edges[:, 1]]).mean() > 1.5 / parts
