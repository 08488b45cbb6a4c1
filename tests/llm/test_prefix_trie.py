import hashlib
from zlib import crc32

import pytest

from hearthline.llm import prefix_trie
from hearthline.llm.prefix_trie import plain, sketch, trie, with_shared_starts

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a string, part string"


def by_turn(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(conv_id, []).append((turn is not None, turn or 0, digest, role, text))
    return {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h, base = crc32(str(c).encode()) % 6, c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    """Every node with its members, then each column from its definition."""
    nodes, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def subtree(node):
        waiting = [node]
        while waiting:
            now = waiting.pop()
            yield now
            waiting += children.get(now, [])

    out = []
    for node, members in nodes.items():
        below = list(subtree(node))
        leaves = sum(n not in children for n in below)
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(node))
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), len(children.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows, partitions=3):
    """The rows with further columns whose names clash with those of the operator."""
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(partitions)


def result(rows, **options):
    return sorted(map(tuple, trie(rows, **options).collect()), key=repr)


def talks(n, length=5, kinds=3):
    """Conversations that share starts of all lengths."""
    return [(c, t, "user" if t % 2 == 0 else "assistant", f"text {crc32(f'{c} {t}'.encode()) % kinds} at {t}") for c in range(n) for t in range(c % (length + 1))]


def test_small_table(spark):
    rows = [
        (7, 0, "user", "a"), (7, 1, "assistant", "bé"), (3, 0, "user", "a"), (3, 1, "assistant", "bé"), (3, 2, "user", "c"),
        (9, None, None, None), (9, 0, "user", "a"), (None, 0, "user", "a"), (11, 5, "user", "a"), (11, 5, "user", "a"), (11, 5, "b", None), (-4, 1, "user", ""),
    ]
    convs = by_turn(rows)
    assert result(plain(frame(spark, rows))) == brute(convs)
    assert result(with_shared_starts(frame(spark, rows))) == brute(rebuilt(convs))


@pytest.mark.parametrize("ids", [range(0, 320), range(150, 260), range(-230, 120, 3)])
def test_shared_starts(spark, ids):
    """Groups with and without a first conversation; conversations left without turns."""
    rows = [(c, t, "user", f"{c if t > 2 else c % 4} {t}") for c in ids for t in range(1 + abs(c) % 9)]
    convs = rebuilt(by_turn(rows))
    assert result(with_shared_starts(frame(spark, rows))) == brute(convs)


def test_turnless_only(spark):
    """Conversation 1 keeps nothing of its own, and its group has no first conversation."""
    rows = [(c, 0, "user", "x") for c in range(1, 100) if crc32(str(c).encode()) % 6]
    assert result(with_shared_starts(frame(spark, rows))) == brute(dict.fromkeys([r[0] for r in rows], []))


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_conversations_lie_in_many_ranges(spark, many_ranges):
    long = [(c, t, "user", f"{t} {c if t > at else ''}") for c, at in ((5, 100), (8, 100), (100, 50), (101, 0)) for t in range(140)]
    rows = long + [(c, t, "user", f"{t} ") for c in (2, 6, 300) for t in range(4)]
    convs = by_turn(rows)
    assert result(plain(frame(spark, rows))) == brute(convs)
    assert result(with_shared_starts(frame(spark, rows))) == brute(rebuilt(convs))


def test_later_steps_may_join_ranges(spark, many_ranges):
    convs = by_turn(talks(200))
    assert sorted(map(tuple, trie(plain(frame(spark, talks(200)))).coalesce(1).collect()), key=repr) == brute(convs)


def test_a_narrow_sketch_costs_no_result(spark, monkeypatch):
    """Thousands of prefixes in 4096 counters a line: estimates are far too large, the rows stay right."""
    monkeypatch.setattr(prefix_trie, "LEAST_BITS", 12)
    monkeypatch.setattr(prefix_trie, "PER_SALT", 3)
    monkeypatch.setattr(prefix_trie, "PER_BLOCK", 2)
    rows = talks(3000, 7, 40)
    assert result(plain(frame(spark, rows)), most_bits=12) == brute(by_turn(rows))


def test_sketch_never_counts_too_little(spark):
    rows = spark.createDataFrame([(i % 50, i % 7) for i in range(5000)], "a long, b long")
    counts = sketch(rows, 14)
    assert counts.sum() == 4 * 5000
    exact = {tuple(r)[:2]: r["count"] for r in rows.groupBy("a", "b").count().collect()}
    import numpy as np

    a, b = (np.array(x, np.int64) for x in zip(*exact))
    estimate = np.min([counts[line][at] for line, at in enumerate(prefix_trie._cells(a, b, 14))], axis=0)
    assert (estimate >= np.array(list(exact.values()))).all()
    assert np.mean(estimate == np.array(list(exact.values()))) > 0.99


def test_copies_end_at_one_node(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(4000) for t in range(3)]
    assert result(plain(frame(spark, rows, 7))) == brute(by_turn(rows))


def test_test_table(spark, small):
    turns = small("conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert result(with_shared_starts(turns)) == brute(rebuilt(by_turn(rows)))


def test_empty(spark):
    assert trie(plain(spark.createDataFrame([], SCHEMA))).collect() == []
    assert trie(with_shared_starts(spark.createDataFrame([(None, 0, "user", "x", "", "", "")], SCHEMA))).collect() == []
