"""Importance resampling towards a target set: hashed n-gram weights, Gumbel noise, an exact cut by bisection.

Words are runs of characters other than ASCII signs and blanks, A-Z in lower case. Features are runs of 1 to
`longest` words joined by a space; a feature's bucket is the crc32 of its bytes modulo `buckets`. Both tables
are counted into one array of buckets (a partial array per task, summed by bucket), and a bucket's gain is the
floored thousandfold log ratio of its smoothed shares in target and corpus. A second pass sums the gains of a
document by an array lookup and adds noise derived from its id; the scores are written once, as narrow rows.

The cut is found by bisection on numbers: jobs count exactly how many eligible rows lie at or before each of
some candidate values, first of the score, then, among rows tied there, of the id. Only the rows before the
cut are partitioned by range and numbered; nothing is sorted as a whole, and the driver sees counts alone.

Defined cases: a null text has no words; documents without words have weight 0; of tied scores the smaller id
comes first, a null id last, then fewer features; rows that agree in all of these are interchangeable, and
as many of them are drawn as fit. Repeated rows count each, in the corpus and in the draw. An empty corpus
gives no rows, an empty target equal gains by corpus count alone; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import buffers, slices, text_bytes
from hearthline.llm.ranges import numbered, range_sorted
from hearthline.session import staged

#: Every byte that ends a word becomes a space, A-Z become a-z.
LETTERS = bytes(ord(" ") if b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

#: Values that one counting job tries.
CANDIDATES = 31
#: Equal rows are spread over this many places of the order, so that no range task gets them all.
SALTS = 256


def features(text: bytes, longest: int) -> tuple[int, list[int]]:
    """Number of words, and the crc32 of every run of 1 to `longest` words."""
    words = text.translate(LETTERS).split()
    runs = list(map(crc32, words))
    found = list(runs)
    for n in range(1, longest):
        runs = [crc32(b" " + w, c) for c, w in zip(runs, words[n:])]
        found += runs
    return len(words), found


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Occurrences of each bucket over all texts: at most `buckets` numbers leave a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, text in slices(batches):
            found = np.array([c for t in text_bytes(*buffers(text)) for c in features(t, longest)[1]], np.int64)
            counts += np.bincount(found % buckets, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket the floored log ratio, in thousandths."""
    buckets, in_corpus, in_target = len(corpus), float(corpus.sum()), float(target.sum())
    pairs = zip(corpus.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (in_corpus + buckets) / ((s + 1.0) * (in_target + buckets)))) for s, t in pairs], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, from the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORES = "doc_id long, n_words long, n_features long, weight long, score long, salt int"


def scored(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch, text in slices(batches):
            found = [features(t, longest) for t in text_bytes(*buffers(text))]
            sizes = np.array([len(f) for _, f in found], np.int64)
            flat = gain[np.array([c for _, f in found for c in f], np.int64) % buckets]
            ends = np.concatenate([[0], np.cumsum(flat)])[np.concatenate([[0], np.cumsum(sizes)])]
            weight = np.diff(ends)
            ids = batch.column("doc_id")
            score = weight + np.array([noise(seed, i) for i in ids.to_pylist()], np.int64)
            salt = np.arange(seen, seen + len(found)) % SALTS
            seen += len(found)
            columns = [ids, pa.array([n for n, _ in found], pa.int64()), pa.array(sizes), pa.array(weight), pa.array(score), pa.array(salt.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight", "score", "salt"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORES)


def least_reaching(rows: DataFrame, column: Column, wanted: int) -> tuple[int, int]:
    """(x, below): the least value x with `wanted` rows or more at or under it, and how many lie under it."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        step = max(1, -(-(high - low) // (CANDIDATES + 1)))
        cuts = list(range(low, high, step))[: CANDIDATES + 1]
        inside = rows.where(column.between(F.lit(low), F.lit(high)))
        counts = inside.agg(*(F.count_if(column <= F.lit(c)).alias(f"c{i}") for i, c in enumerate(cuts))).first()
        reached = [i for i, n in enumerate(counts) if below + n >= wanted]
        i = reached[0] if reached else len(cuts)
        before = counts[i - 1] if i else 0
        low, high = (cuts[i - 1] + 1 if i else low), (cuts[i] if reached else high)
        below += before
    return low, below


def resampled(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null for those not drawn.

    Of the documents with at least `least_words` words, `percent` in a hundred are drawn, highest scores first.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scores = staged(scored(docs, gain, longest, seed), "scores")
    can = F.col("n_words") >= least_words
    tied = scores.where(can)
    draw = tied.count() * percent // 100
    null = F.lit(None).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    if not draw:
        return scores.select(*columns, null.alias("rank"))
    keys = [-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0).cast("long")), F.col("n_features")]
    before, same, left = F.lit(False), can, draw
    for key in keys:
        cut, below = least_reaching(tied, key, left)
        before |= same & (key < F.lit(cut))
        same &= key == F.lit(cut)
        tied, left = tied.where(key == F.lit(cut)), left - below
    drawn = before | same
    ordered = range_sorted(scores.where(drawn).select(*columns, "salt"), *keys, F.col("salt"))
    # Equal rows may reach beyond the draw; which of them stays out makes no difference.
    rank = F.when(F.col("rank") <= draw, F.col("rank"))
    ranked = numbered(ordered, "rank").select(*columns, rank.alias("rank"))
    return ranked.unionByName(scores.where(~drawn).select(*columns, null.alias("rank")))
