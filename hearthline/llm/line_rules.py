"""Quality rules: a conditional random field marks each line as content or boilerplate.

Base rules reject texts under 50 words and texts of which more than half of the words lie in repeated
three-word windows. Of the others, the Viterbi path over the lines decides: a text stays if at least
`least_share` of its words lie in content lines. The field is trained on a bounded sample of labelled
documents (`per_class` of either label, all their lines), whose lines take the document's label. For training the
lines are cut into stretches of `stretch` lines; the stretches of a document count as one together, so that a
long document teaches no more than a short one.

Defined cases: null and empty texts have no words and fail the base rules; lines without a word belong to
no sequence; without labels of both classes every line is content, so the base rules alone decide; repeated
rows are judged one by one; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hearthline.llm.common import buffers, labelled_sample, slices
from hearthline.llm.crf import LinearChainCRF
from hearthline.llm.text_stats import N_LINE_FEATURES, SYMBOL, TextStats

CONTENT, BOILERPLATE = 0, 1
FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


def train_line_model(docs: DataFrame, labels: DataFrame, per_class: int = 600, stretch: int = 40) -> LinearChainCRF | None:
    """The field learnt from labelled documents; None without both labels."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            stats = TextStats(*buffers(text))
            x, label = stats.line_features(), batch.column("label").to_numpy(zero_copy_only=False)
            begin = np.cumsum(stats.n_lines) - stats.n_lines
            rows = [(int(y), x[a : a + n].ravel()) for y, a, n in zip(label, begin, stats.n_lines) if n]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["label", "x"])

    sample = labelled_sample(docs, labels, "quality", per_class).mapInArrow(features, "label int, x array<double>").collect()
    sample.sort(key=lambda r: (r.label, r.x))
    if len({r.label for r in sample}) < 2:
        return None
    sequences, label, weight = [], [], []
    for r in sample:
        lines = np.array(r.x).reshape(-1, N_LINE_FEATURES)
        cut = [lines[i : i + stretch] for i in range(0, len(lines), stretch)]
        sequences += cut
        label += [CONTENT if r.label else BOILERPLATE] * len(cut)
        weight += [1 / len(cut)] * len(cut)
    lengths = np.array([len(s) for s in sequences])
    x = np.zeros((len(sequences), lengths.max(), N_LINE_FEATURES))
    y = np.zeros(x.shape[:2], int)
    for i, s in enumerate(sequences):
        x[i, : len(s)] = s
        y[i, : len(s)] = label[i]
    return LinearChainCRF.train(x, y, lengths, 2, weight=np.array(weight))


def judge(stats: TextStats, model: LinearChainCRF | None, least_share: float) -> dict[str, np.ndarray]:
    n_words, n_repeat = stats.n_words, stats.sum_words(stats.repeated)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    if model is None:
        content = n_words.astype(float)
    else:
        begins = np.flatnonzero(np.append(True, stats.line_doc[1:] != stats.line_doc[:-1])) if len(stats.line_doc) else np.empty(0, int)
        state = model.viterbi(model.scores(stats.line_features()), begins)
        content = stats.sum_words(state[stats.word_line] == CONTENT) if len(state) else np.zeros(stats.n)
    share = content / np.maximum(1, n_words)
    return {
        "n_words": n_words,
        "word_chars": stats.word_chars,
        "n_symbols": stats.per_doc(SYMBOL),
        "n_dup_lines": stats.sum_lines(stats.line_is_copy),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "content_share": share,
        "kept": ~failed & (share >= least_share),
    }


def line_rules(docs: DataFrame, labels: DataFrame, carry: list[str] | None = None, least_share: float = 0.5, **training: int) -> DataFrame:
    """The `carry` columns of every document (default: doc_id) with the figures and the verdict `kept`."""
    carry = carry or ["doc_id"]
    model = train_line_model(docs, labels, **training)
    picked = docs.select(*dict.fromkeys([*carry, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.select(*carry).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches):
            figures = judge(TextStats(*buffers(text)), model, least_share)
            kept = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays(kept + [pa.array(v) for v in figures.values()], carry + list(figures))

    return picked.mapInArrow(run, f"{schema}, {FIGURES}")
