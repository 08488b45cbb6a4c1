import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from hearthline.llm.importance_resampling import features, least_reaching, resampled
from hearthline.llm.ranges import numbered, range_sorted
from tests.llm.conftest import odd_rows

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    def bag(text):
        w = words(text)
        return [crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = (Counter(b for text in texts for b in bag(text)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    rows = []
    for doc_id, text in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, bag(text)))
        rows.append([doc_id, len(bag(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    can = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(can[: percent * len(can) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def result(docs, target, **options):
    return sorted(map(tuple, resampled(docs, target, **options).collect()), key=repr)


TARGET = ["the quick brown fox", None, "", "études 12 Übung", "wort0 wort1"]


def frames(spark, docs, target=TARGET, partitions=3):
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("score", "rank", "salt", "n", "bucket", "range_no")})
    return rows.repartition(partitions), spark.createDataFrame([(t,) for t in target], "text string")


def test_words():
    assert features("Ab-c É1\x7f{x\x00".encode(), 1) == (4, [crc32(w.encode()) for w in ("ab", "c", "É1", "x")])
    assert features(b"a b c", 3)[1] == [crc32(w) for w in (b"a", b"b", b"c", b"a b", b"b c", b"a b c")]


@pytest.mark.parametrize("options", [{}, {"percent": 50, "least_words": 0}, {"longest": 3, "buckets": 50, "percent": 33}, {"percent": 100, "least_words": 1}, {"seed": 7, "percent": 0}])
def test_odd_documents(spark, odd, options):
    docs = [(r[0], r[1]) for r in odd_rows()]
    _, target = frames(spark, docs)
    names = {"least_words": "least"}
    assert result(odd, target, **options) == brute(docs, TARGET, **{names.get(k, k): v for k, v in options.items()})


def test_ties_and_repeats(spark):
    """Most rows are one row many times; the cut falls among them, and none is drawn too many."""
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(1, text)] * 500 + [(2, text)] * 3 + [(None, text)] * 5 + [(1, text + " x")] * 4 + [(i, text) for i in range(3, 60)]
    for percent in (5, 50, 97):
        assert result(*frames(spark, docs, partitions=7), percent=percent) == brute(docs, TARGET, percent=percent)


def test_test_table(spark, small):
    docs = [(r.doc_id, r.text) for r in small("documents").collect()]
    target = [r.text for r in small("benchmark").collect()]
    assert result(small("documents"), small("benchmark")) == brute(docs, target)


def test_least_reaching(spark):
    rows = spark.createDataFrame([(v,) for v in [-(2**62), -5, -5, -5, 0, 3, 3, 2**62]], "v long")
    values = sorted(r.v for r in rows.collect())
    for wanted in range(1, 9):
        x = values[wanted - 1]
        assert least_reaching(rows, F.col("v"), wanted) == (x, sum(v < x for v in values))


def test_numbers_survive_joined_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = range_sorted(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")), F.col("v"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ordered.rdd.getNumPartitions() > 1
    for rows in (numbered(ordered, "i"), numbered(ordered, "i").coalesce(1)):
        assert all(r.i == r.v + 1 for r in rows.collect())


def test_empty(spark, empty):
    _, target = frames(spark, [])
    assert resampled(empty, target).collect() == []
    assert result(*frames(spark, [(1, "a b")], [])) == brute([(1, "a b")], [])
