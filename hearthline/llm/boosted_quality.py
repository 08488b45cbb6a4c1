"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics come from the text alone, over the whole of it. The trees are grown on the driver from a
bounded sample of labelled documents (`per_class` of either label, weighted back to the shares of all labels):
every statistic is cut into BINS bins at its quantiles, and each level of a tree is chosen from histograms of
gradients. A tree is complete and flattened into arrays (statistic, threshold, leaf value), so that scoring a
batch walks all documents down a level at a time in numpy.

Defined cases: null and empty texts have all statistics 0 and get the score of these; without labels of both
classes every score is the share of label 1 (0.5 without labels); labels of held-out ids are not read; repeated
rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.llm.common import buffers, doc_bucket, labelled_sample, slices
from hearthline.llm.text_stats import BANG, COMMA, DIGIT, LEAD, LOWER, STOP, SYMBOL, UPPER, TextStats

BINS = 64


def statistics(stats: TextStats) -> np.ndarray:
    """[documents, statistics]"""
    words, lines = np.maximum(1, stats.n_words), np.maximum(1, stats.n_lines)
    chars = np.maximum(1, stats.per_doc(LEAD))
    upper, lower = stats.per_doc(UPPER), stats.per_doc(LOWER)
    ids, doc = stats.ids, stats.word_doc
    distinct = np.bincount((np.unique(doc * (ids.max() + 1) + ids) // (ids.max() + 1)), minlength=stats.n) if len(ids) else np.zeros(stats.n)
    again = np.zeros(len(ids))
    again[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    per_line = np.bincount(stats.word_line, minlength=len(stats.line_id)) if len(ids) else np.zeros(0)
    short = stats.sum_lines(per_line < 3) if len(per_line) else np.zeros(stats.n)
    longest = np.zeros(stats.n)
    np.maximum.at(longest, stats.line_doc, per_line)
    columns = [
        np.log1p(stats.n_words),
        stats.word_chars / words,
        stats.per_doc(SYMBOL) / words,
        upper / np.maximum(1, upper + lower),
        stats.per_doc(DIGIT) / chars,
        stats.per_doc(BANG) / words,
        stats.per_doc(STOP) / words,
        stats.per_doc(COMMA) / words,
        stats.sum_words(stats.repeated) / words,
        stats.sum_words(again) / words,
        distinct / words,
        stats.sum_lines(stats.line_is_copy) / lines,
        np.log1p(stats.n_words / lines),
        short / lines,
        np.log1p(longest),
        (upper + lower) / chars,
    ]
    return np.stack(columns, axis=1).astype(float)


@dataclass
class BoostedTrees:
    """Complete trees in arrays: node k has the children 2k + 1 and 2k + 2; leaves [trees, 2 ** depth]."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, penalty: float = 2.0) -> BoostedTrees:
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(n, start)
    inner = 2**depth - 1
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, 2**depth))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            for f in range(d):
                key = (node - first) * BINS + binned[:, f]
                gs = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
                gain[:, len(cuts[f]) :] = 0
                at = gain.argmax(axis=1)
                value = gain[np.arange(width), at]
                better = np.flatnonzero(value > best + 1e-9)
                best[better] = value[better]
                feature[t, first + better] = f
                threshold[t, first + better] = cuts[f][at[better]]
            cut = x[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + cut
        gs = np.bincount(node - inner, g, 2**depth)
        hs = np.bincount(node - inner, h, 2**depth)
        leaf[t] = rate * gs / (hs + penalty)
        total += leaf[t, node - inner]
    return BoostedTrees(start, feature, threshold, leaf)


def _model(docs: DataFrame, labels: DataFrame, per_class: int, folds: int) -> BoostedTrees:
    learn = doc_bucket("doc_id", folds) != 0

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            x = statistics(TextStats(*buffers(text)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    known = labels.where(learn & F.col("quality").isin(0, 1)).groupBy("quality").count().collect()
    size = {int(r.quality): r["count"] for r in known}
    rows = labelled_sample(docs, labels, "quality", per_class, learn).mapInArrow(measure, "label int, x array<double>").collect()
    rows.sort(key=lambda r: (r.label, r.x))
    got = {v: sum(r.label == v for r in rows) for v in (0, 1)}
    if not got[0] or not got[1]:
        share = size.get(1, 0) / max(1, sum(size.values())) if size else 0.5
        p = min(max(share, 1e-3), 1 - 1e-3)
        return BoostedTrees(float(np.log(p / (1 - p))), np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)))
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows], float)
    weight = np.array([size[r.label] / got[r.label] for r in rows])
    return train_trees(x, y, weight / weight.mean())


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 4_000, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; ids with crc32 mod `folds` 0 are held out of training."""
    labels = labels.select("doc_id", "quality")
    model = _model(docs, labels, per_class, folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            score = model.score(statistics(TextStats(*buffers(text))))
            predicted = pa.array((score >= threshold).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), predicted], ["doc_id", "held_out", "score", "predicted"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (doc_bucket("doc_id", folds) == 0).alias("held_out"), "text")
    return picked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
