import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hearthline.llm.suffix_dedup import LENGTH, common_prefixes, remove_repeats, repeated_starts, suffix_order


def brute(texts):
    """Per text (bytes, removed, runs, sha of the rest)."""
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + LENGTH] for b in raw for i in range(len(b) - LENGTH + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if times[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, **options).collect())
    assert got == sorted((i, *figures) for (i, _), figures in zip(rows, brute([t for _, t in rows])))


def passages(n, rng):
    """Texts with passages in common around the limit, copies, runs of one letter, foreign letters."""
    letters = "abcdé \n"
    shared = ["".join(rng.choice(letters) for _ in range(rng.randint(150, 600))) for _ in range(6)]
    out = []
    for i in range(n):
        parts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(3)]
        for k in range(3):
            if rng.random() < 0.5:
                p = rng.choice(shared)
                a = rng.randint(0, 60)
                parts.insert(rng.randint(0, len(parts)), p[a : len(p) - rng.randint(0, 60)])
        if rng.random() < 0.1:
            parts.append("z" * rng.randint(190, 420))
        out.append((i, "".join(parts)))
    return out + [(n + i, out[i % 5][1]) for i in range(10)]


@pytest.mark.parametrize("shard_bytes", [4_000, 4_000_000])
def test_against_brute_force(spark, shard_bytes):
    check(spark, passages(80, random.Random(shard_bytes)), shard_bytes=shard_bytes)


def test_documents(spark, small):
    check(spark, [(r.doc_id, r.text) for r in small("documents").collect()], shard_bytes=50_000)


def test_periodic_text(spark):
    check(spark, [(1, "ab" * 300), (2, "abc" * 100), (3, "x" * 199), (4, "x" * 200), (5, "x" * 201), (6, "y" * 200), (7, "y" * 200)])


def test_odd_documents(spark, odd):
    from tests.llm.conftest import odd_rows

    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(odd).collect())
    assert got == sorted((d[0] or -1, *f) for d, f in zip(odd_rows(), brute([d[1] for d in odd_rows()])))


def test_empty(spark, empty):
    assert remove_repeats(empty).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array(seed):
    rng = random.Random(seed)
    piece = bytes(rng.choice(b"ab") for _ in range(300))
    text = b"".join(piece[: rng.randint(100, 300)] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 200))) for _ in range(6))
    raw = np.frombuffer(text, np.uint8)
    order = suffix_order(raw)
    heads = [text[i : i + LENGTH] for i in order.tolist()]
    assert heads == sorted(heads) and sorted(order.tolist()) == list(range(len(text)))

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    prefixes = common_prefixes(raw, order).tolist()
    assert prefixes[1:] == [common(a, b) for a, b in zip(heads, heads[1:])]
    times = Counter(text[i : i + LENGTH] for i in range(len(text) - LENGTH + 1))
    assert repeated_starts(raw).tolist() == [i + LENGTH <= len(text) and times[text[i : i + LENGTH]] > 1 for i in range(len(text))]
